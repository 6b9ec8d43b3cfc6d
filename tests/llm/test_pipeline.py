"""The pipeline's stages: what they keep, in which columns, on awkward rows."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from fleetlens.llm import jaccard, language
from test_dedup import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def start(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("documents"))
    docs.select(COLUMNS).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def stages(spark, start, tmp_path_factory):
    """Every stage's rows, each stage over what the one before wrote."""
    out, docs = [start.collect()], start
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage"))
        stage(spark, docs, "").write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def phrases(word: str, sample: str) -> int:
    """Longest matches in the sample that the word falls into, by looking for every substring."""
    count = at = 0
    while at < len(word):
        size = 1
        while at + size < len(word) and word[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def decided(rows, samples) -> Counter:
    """Rows that one language parses with at least half of the weight."""
    bits = {name: math.log2(max(2, len(text))) for name, text in samples.items()}
    costs, kept = {}, Counter()
    for row in rows:
        words = re.findall(r"[^\W\d_]+", (row.text or "").lower())
        if words:
            for word in set(words):
                if word not in costs:
                    costs[word] = {name: phrases(f" {word} ", sample) for name, sample in samples.items()}
            total = {name: sum(costs[w][name] for w in words) * bits[name] for name in samples}
            least = min(total.values())
            weight = {name: 2.0 ** max(-1000.0, least - b) for name, b in total.items()}
            if max(weight.values()) / sum(weight.values()) >= pipeline.LEAST_SCORE:
                kept[tuple(row)] += 1
    return kept


def test_language_stage_keeps_what_is_decided(spark, start, stages):
    samples = language.labelled_sample(start, ~language.held_out())
    assert len(samples) == 3
    wanted = decided(stages[0], samples)
    assert Counter(map(tuple, stages[1])) == wanted
    assert sum(wanted.values()) > 0


def test_language_stage_drops_what_is_not_decided(spark):
    """Three languages with the same words cannot be told apart; of two that differ, each text has one."""
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 4 != 2]
    same = [(i, "alpha beta gamma", "xyz"[k % 3], "s", 1) for k, i in enumerate(ids[:9])]
    frame = spark.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long")
    assert pipeline.language_id(spark, frame, "").count() == 0
    apart = [(i, ("alpha beta gamma ", "rot und blau ")[k % 2] * 3, "xy"[k % 2], "s", 1) for k, i in enumerate(ids[:8])]
    assert pipeline.language_id(spark, spark.createDataFrame(apart, frame.schema), "").count() == 8


def test_language_stage_without_labels_drops_texts_without_letters_only(spark, start):
    blank = start.withColumn("lang", F.lit(None).cast("string"))
    kept = Counter(r.text for r in pipeline.language_id(spark, blank, "").collect())
    assert kept == Counter(r.text for r in start.collect() if r.text and any(map(str.isalpha, r.text)))


def test_exact_stage_keeps_one_of_each_text(stages):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    groups = {}
    for r in stages[1]:
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    assert Counter(norm(r.text) for r in stages[2]) == Counter(dict.fromkeys(groups, 1))
    for r in stages[2]:
        assert r.doc_id == min((i for i in groups[norm(r.text)] if i is not None), default=None)


def test_near_stage_keeps_the_smallest_of_each_component(stages):
    components = brute_components([tuple(r) for r in stages[2]], jaccard.SHINGLE, jaccard.PERCENT)
    assert {r.doc_id for r in stages[3]} == {c for (_, _, c) in components}


def test_mix_stage_repeats_up_to_twice(stages):
    before = Counter(map(tuple, stages[3]))
    after = Counter(map(tuple, stages[4]))
    assert set(after) <= set(before) and all(n <= 2 * before[r] for r, n in after.items())
    size = lambda rows: sum(len(r.text.split()) for r in rows)
    # Copies are whole, so a source may miss its target by its largest document; one here has 20 000 words.
    largest = {}
    for r in stages[3]:
        largest[r.source] = max(largest.get(r.source, 0), len(r.text.split()))
    assert abs(size(stages[4]) - 1.5 * size(stages[3])) <= sum(largest.values())


def test_packing_stage_packs_everything(stages):
    assert Counter(r.doc_id for r in stages[5]).keys() == {r.doc_id for r in stages[4]}


def test_stage_columns(spark, start):
    assert [name for name, _ in pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    empty = start.limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, empty, "")
        assert found.columns == COLUMNS and found.count() == 0
