"""Exact, substring and Jaccard deduplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpus_pipeline import near
from fleetlens.llm import exact_dedup, graph, jaccard, substrings
from fleetlens.llm.graph import components


def test_minimal_perfect_hash_is_a_permutation():
    digests = [hashlib.sha256(str(k).encode()).digest() for k in range(5000)]
    packed, slots = exact_dedup.build_function(digests)
    assert sorted(slots) == list(range(5000))
    assert (exact_dedup.apply_function(packed, digests) == slots).all()
    strangers = exact_dedup.apply_function(packed, [hashlib.sha256(f"x{k}".encode()).digest() for k in range(1000)])
    assert strangers.max() < 5000 and strangers.min() >= -1


def test_exact_dedup(docs, rows):
    norm = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[norm(text)].append(i)
    for history in (F.lit(False), F.col("doc_id") <= 9):
        found = exact_dedup.exact_dedup(docs, history).collect()
        assert Counter((r.doc_id, r.text_sha256) for r in found) == Counter((i, norm(t)) for i, t, *_ in rows)
        for r in found:
            ids = groups[r.text_sha256]
            assert r.group_size == len(ids)
            assert r.keep_id == min((i for i in ids if i is not None), default=None)
        assert Counter(r.text_sha256 for r in found if r.kept) == Counter(dict.fromkeys(groups, 1))


def test_the_slots_decide(spark, monkeypatch):
    """Members are settled by their slot alone: if no digest lands on its own, none is recognised."""
    digest = lambda k: hashlib.sha256(str(k).encode()).digest()
    place = lambda k: {"last": False, "doc_id": k, "row": k}
    schema = "digest binary, place struct<last: boolean, doc_id: long, row: long>"
    history = spark.createDataFrame([(digest(k % 50), place(k)) for k in range(100, 200)], schema)
    incoming = spark.createDataFrame([(digest(k % 80), place(k)) for k in range(90)], schema).repartition(3)
    wanted = {digest(d): (min(k for k in range(200) if k % (50 if k >= 100 else 80) == d and (k < 90 or k >= 100)),
                          sum(k % 80 == d for k in range(90)) + 2 * (d < 50)) for d in range(80)}
    found = exact_dedup.winners(history, incoming, bucket_keys=20).collect()
    assert {bytes(r.digest): (r.winner.doc_id, r.copies) for r in found} == wanted and len(found) == 80
    table = pa.table({"digest": [digest(k) for k in range(10)], "winner": [place(k) for k in range(10)], "copies": [1] * 10,
                      "bucket": [0] * 10})
    index = exact_dedup._build_bucket(table)
    assert all(exact_dedup._look_up(table, index).column("settled").to_pylist())
    monkeypatch.setattr(exact_dedup, "apply_function", lambda packed, digests: np.arange(len(digests))[::-1])
    assert exact_dedup._look_up(table, index).column("settled").to_pylist().count(False) >= 8


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup.middle_id(no_docs) is None
    assert exact_dedup.exact_dedup(no_docs, F.lit(True)).count() == 0


def brute_repeats(rows, depth):
    texts = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    starts = Counter(tuple(w[k:k + depth]) for _, w in texts for k in range(len(w) - depth + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - depth + 1):
            if starts[tuple(w[k:k + depth])] > 1:
                gone.update(range(k, k + depth))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return Counter(out)


def test_remove_repeats(docs, rows, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT_SHARE", 10)
    for depth, anchor, long in ((35, 12, 24), (3, 2, 3)):
        found = substrings.remove_repeats(docs, depth, anchor, long, group_bytes=50_000).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.text or "") for r in found) == brute_repeats(rows, depth)


def test_remove_repeats_of_nothing(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            same_id = sets[x][0] == sets[y][0]
            if (same_id and a and b) or (a and b and 100 * len(a & b) >= percent * len(a | b)):
                parent[find(x)] = find(y)
    members = defaultdict(list)
    for x in range(len(sets)):
        members[find(x)].append(sets[x][0])
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return Counter((sets[x][0], len(sets[x][1]), smallest[find(x)]) for x in range(len(sets)))


def test_jaccard_components(docs, rows):
    for k, percent in ((5, 80), (1, 60)):
        found = jaccard.jaccard_components(docs, k, percent).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, k, percent)


def test_jaccard_chains_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_DOCS", 10)
    rng = np.random.default_rng(3)
    rows = []
    for base in range(3):
        words = [f"w{x}" for x in rng.integers(0, 400, 120)]
        for k in range(40):
            copy = list(words)
            for at in rng.integers(0, len(copy), k // 4):
                copy[at] = f"v{rng.integers(0, 9999)}"
            rows.append((base * 1000 + k, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for percent in (85,):
        found = jaccard.jaccard_components(frame, 4, percent).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, 4, percent)


def test_leaders_that_share_too_little_lead_all_the_same(spark):
    """Every shingle of two near copies is also in one other document of smaller id, which links with nothing."""
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(f"u{k}x{j}" for j in range(30)) + " " + " ".join(words[k:k + 4])) for k in range(57)]
    rows += [(100, " ".join(words)), (101, " ".join(words[:-1] + ["other"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.jaccard_components(frame, 4, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, 4, 85)
    assert {r.component_id for r in found if r.doc_id >= 100} == {100}


def test_rows_without_an_id_stand_for_themselves(spark):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    copies = text(1) + " more"
    rows = [(3, text(1)), (None, copies), (None, text(2)), (None, text(4)), (None, text(4) + " more"), (5, text(5))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.jaccard_components(frame, 5, 80).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter([(3, 3), (5, 5), (None, 3)] + 3 * [(None, None)])
    kept = Counter(r.text for r in near(spark, frame, "").collect())
    assert kept in [Counter([text(1), text(2), text(5), one]) for one in (text(4), text(4) + " more")]


def test_jaccard_of_nothing(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_repeated_sets_are_shuffled_once(spark):
    texts = [f"the same words in document {k // 3} and its copies" for k in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = jaccard.stored(jaccard.shingle_sets(frame, F.col("doc_id")), "sets")
    found = jaccard.distinct_sets(sets)
    assert sorted(r.id for r in found.collect()) == list(range(0, 30, 3))
    # What is read again and again holds no shuffle of sets; the bit filter alone is sent around.
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_sets_survive_packing():
    values = np.array([1, 2, (1 << 48) - 1], dtype=np.uint64)
    back, ends = jaccard.unpack_sets([jaccard.pack_set(values), b"", jaccard.pack_set(values[:1])])
    assert back.tolist() == [1, 2, (1 << 48) - 1, 1] and ends.tolist() == [0, 3, 3, 4]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    keep = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: (written.append(name), keep(df, name))[1])
    found = {r.id: r.component for r in components(spark.range(300).selectExpr("id AS a", "id + 1 AS b")).collect()}
    assert found == dict.fromkeys(range(301), 0) and len(written) <= 20


def test_components_of_random_edges(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    root = list(range(400))
    for _ in range(400):
        before = list(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: root[x] for a, b in edges if a != b for x in (a, b)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, 200 + k) for k in range(1, 50)] + [(7, 7)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, **{200 + k: 200 for k in range(50)}}
