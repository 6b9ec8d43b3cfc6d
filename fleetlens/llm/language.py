"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text knows every substring of that text. A document is parsed greedily
into the longest phrases the automaton holds; a text of the same language needs few phrases. A phrase costs the bits of
a place in the labelled text, so a count is normalised by the logarithm of that text's length; the language with the
cheapest parse wins. A phrase does not run over the end of a word, so a word's phrases are worked out once per task and
looked up for its repetitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import WordTable, slices

UNKNOWN = "und"
# Bounds of the labelled sample, per language.
SAMPLE_DOCS = 120
SAMPLE_CHARS = 40_000
DOC_CHARS = 4_000

_LETTERS = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """Edges (state, character, next state) of the suffix automaton of one text; state 0 is the start."""

    def __init__(self, text: str):
        links, lengths, edges = [-1], [0], [{}]
        last = 0
        for char in text:
            state = len(edges)
            links.append(0)
            lengths.append(lengths[last] + 1)
            edges.append({})
            at = last
            while at >= 0 and char not in edges[at]:
                edges[at][char] = state
                at = links[at]
            if at >= 0:
                target = edges[at][char]
                if lengths[target] != lengths[at] + 1:
                    copy = len(edges)
                    links.append(links[target])
                    lengths.append(lengths[at] + 1)
                    edges.append(dict(edges[target]))
                    while at >= 0 and edges[at].get(char) == target:
                        edges[at][char] = copy
                        at = links[at]
                    links[target] = links[state] = copy
                else:
                    links[state] = target
            last = state
        self.edges = [(state, ord(char), to) for state, out in enumerate(edges) for char, to in out.items()]
        self.states = len(edges)
        self.bits = float(np.log2(max(2, len(text))))


class LanguageModel:
    """An automaton per language, kept as arrays of edges. ``texts`` maps each language to its labelled sample."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        automata = [SuffixAutomaton(texts[name]) for name in self.languages]
        self.alphabet = np.unique(np.array([c for a in automata for _, c, _ in a.edges], dtype=np.uint32))
        self.bits = np.array([a.bits for a in automata])
        self._edges = [(a.states, np.array(a.edges, dtype=np.int32).reshape(-1, 3)) for a in automata]
        self._steps = None

    def __getstate__(self):
        return {**self.__dict__, "_steps": None}

    def _tables(self) -> list[np.ndarray]:
        """Per language the next state by state and character code; 0 where there is none, also for code 0."""
        if self._steps is None:
            self._steps = []
            for states, edges in self._edges:
                steps = np.zeros((states, len(self.alphabet) + 1), dtype=np.int32)
                steps[edges[:, 0], np.searchsorted(self.alphabet, edges[:, 1].astype(np.uint32)) + 1] = edges[:, 2]
                self._steps.append(steps)
        return self._steps

    def forget(self) -> None:
        """Frees the tables; a worker keeps a broadcast model from task to task, and from run to run."""
        self._steps = None

    def _codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, 0)

    def costs(self, words: Sequence[str]) -> np.ndarray:
        """Phrases of each word, with a space on both sides, under each language; zeros for a run without a letter.

        All words take one step at a time together. A character that never occurred is a phrase of its own.
        """
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        codes = self._codes("".join(f" {words[k]} " for k in order))
        lengths = np.array([len(words[k]) + 2 for k in order])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        going = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        rows = np.zeros((len(words), len(self.languages)), dtype=np.int32)
        for language, steps in enumerate(self._tables()):
            state, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32)
            for step, n in enumerate(going):
                char, before = codes[starts[:n] + step], state[:n]
                to = steps[before, char]
                ended = to == 0
                to[ended] = steps[0, char[ended]]
                count[:n] += (ended & (before > 0)).astype(np.int32) + (to == 0)
                state[:n] = to
            rows[order, language] = count + (state > 0)
        lettered = np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in words), bool, len(words))
        rows[~lettered] = 0
        return rows

    def predict(self, texts: Sequence[str | None], table: WordTable) -> list[tuple[str, float]]:
        """(language, score) of each text; ``table`` keeps the costs of words from batch to batch."""
        words, offsets = [], [0]
        for text in texts:
            if text:
                words.extend(_LETTERS.findall(text.lower()))
            offsets.append(len(words))
        counts = table.lookup(words).astype(np.int64)
        sums = np.concatenate([np.zeros((1, len(self.languages)), np.int64), np.cumsum(counts, axis=0)])
        phrases = sums[offsets[1:]] - sums[offsets[:-1]]
        bits = phrases * self.bits
        best = bits.argmin(axis=1) if len(texts) else np.zeros(0, int)
        gap = np.clip(bits.min(axis=1, keepdims=True) - bits, -1000.0, 0.0) if len(texts) else bits
        score = 1.0 / np.exp2(gap).sum(axis=1)
        any_letter = phrases.any(axis=1)
        return [
            (self.languages[k], float(s)) if known else (UNKNOWN, 0.0) for k, s, known in zip(best, score, any_letter)
        ]


def labelled_sample(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang",
                    id_col: str = "doc_id") -> dict[str, str]:
    """At most SAMPLE_CHARS characters of words per language, from at most SAMPLE_DOCS documents each.

    A language with enough documents of at most DOC_CHARS characters is learned from those, any other from all of its
    own, of each the first DOC_CHARS characters. Which ones is decided by a hash of the id, so reruns and clusters
    agree. A few hundred documents per language pass the threshold on the hash and reach the driver, at any size.
    """
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        (F.length(text_col) <= DOC_CHARS).alias("short"),
        (F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / float(1 << 30)).alias("order"))
    counts = rows.groupBy("lang").agg(F.count(F.when(F.col("short"), 1)).alias("short"), F.count(F.lit(1)).alias("all"))
    wanted = F.lit(False)
    for row in counts.collect():
        few = row["short"] < SAMPLE_DOCS
        reach = 4.0 * SAMPLE_DOCS / row["all" if few else "short"]
        wanted = wanted | ((F.col("lang") == row["lang"]) & (F.lit(few) | F.col("short")) & (F.col("order") < reach))
    picked: dict[str, list] = {}
    for row in rows.where(wanted).select("lang", "order", F.substring("text", 1, DOC_CHARS).alias("text")).collect():
        picked.setdefault(row["lang"], []).append((row["order"], row["text"]))
    texts = {}
    for name, found in sorted(picked.items()):
        words = [w for _, text in sorted(found)[:SAMPLE_DOCS] for w in _LETTERS.findall(text.lower())]
        sample = " ".join(words)[:SAMPLE_CHARS]
        if sample:
            texts[name] = f" {sample} "
    return texts


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The columns ``keep`` of every row with the predicted language and a score from 0 to 1.

    The score weighs the cheapest parse against the others: two to the minus its bits, as a share of all. Null text
    and text without a letter give ``und`` and 0, as does everything under a model without languages. Repeated rows
    get equal results. The model is bounded by the sample and is sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text_col).alias("_text"))
    kept = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table = WordTable(known.costs, len(known.languages), np.int32)
        for batch in slices(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            found = known.predict(texts, table) if known.languages else [(UNKNOWN, 0.0)] * len(texts)
            columns = [batch.column(name) for name in keep]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, pred_col, score_col])
        known.forget()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return source.mapInArrow(run, f"{schema}, `{pred_col}` string, `{score_col}` double")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls into the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, usable: Column | None = None, **columns: str) -> LanguageModel:
    """A model from the labelled sample of the rows that ``usable`` allows."""
    return LanguageModel(labelled_sample(docs, F.lit(True) if usable is None else usable, **columns))
