"""SpotSigs: document fingerprints from chains of content words that follow common-word anchors.

An anchor is a common word. Its signature is the anchor and the next CHAIN content words, taken DISTANCE apart, where
common words do not count as content. A fingerprint is the set of a document's signatures. Two fingerprints are
compared by Jaccard; the sizes alone bound it from above, so sets whose lengths are too far apart need no comparison.

``near_duplicates`` joins a table with itself: fingerprints are partitioned by set length, so that a fingerprint meets
only its own partition and the next; within those it meets what shares one of its rarest signatures.
"""

from __future__ import annotations

import base64
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.text import WordTable, as_bytes, joined_words, mix, shuffle_parts, slices, stored

# Common words of the languages at hand.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with you not have has "
    "der die das und ist von mit den dem ein eine zu im auf nicht für als auch es sich "
    "de la le les et un une des du en que qui dans pour pas sur par au avec est "
    "el los las y del al se por con para una su lo mi no"
).split()
CHAIN = 2
DISTANCE = 1
THRESHOLD = 0.8
_STRIP = b".,;:!?\"'()[]{}<>*#$%&+=|/\\-_~`^@"


def _word_rows(anchors: Collection[str]):
    common = {a.encode() for a in anchors}

    def rows(words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), 2), dtype=np.uint64)
        for at, word in enumerate(words):
            bare = word.strip(_STRIP)
            if bare:
                out[at] = xxhash.xxh3_64_intdigest(bare), 2 if bare in common else 1
        return out

    return rows


class Signer:
    """Fingerprints of texts: sorted distinct 32-bit signature hashes."""

    def __init__(self, anchors: Collection[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE):
        self._table = WordTable(_word_rows(anchors), 2, np.uint64)
        self._reach = [1 + k * distance for k in range(chain)]

    def fingerprints(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """A text without a whole signature has the hash of all its words as its only one, and no words give none."""
        words, offsets = joined_words(texts, lower=True)
        rows = self._table.lookup(words)
        value, kind = rows[:, 0], rows[:, 1]
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        content = np.flatnonzero(kind == 1)
        anchor = np.flatnonzero(kind == 2)
        after = np.searchsorted(content, anchor)  # the next content word of each anchor
        last = after + self._reach[-1] - 1
        whole = last < len(content)
        anchor, after = anchor[whole], after[whole]
        if len(anchor):
            whole = owner[content[after + self._reach[-1] - 1]] == owner[anchor]
            anchor, after = anchor[whole], after[whole]
        signature = value[anchor]
        for reach in self._reach:
            with np.errstate(over="ignore"):
                signature = mix(signature * np.uint64(0x9E3779B97F4A7C15) + value[content[after + reach - 1]])
        ends = np.searchsorted(anchor, offsets)
        found = []
        for k, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
            own = np.unique((signature[lo:hi] >> np.uint64(32)).astype(np.uint32))
            if not len(own):
                all_words = b" ".join(words[offsets[k]:offsets[k + 1]])
                own = np.array([xxhash.xxh32_intdigest(all_words)] if all_words else [], dtype=np.uint32)
            found.append(own)
        return found


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two fingerprints, 1 for two empty ones; 0 without counting if their lengths rule out ``least``."""
    small, large = sorted((len(a), len(b)))
    if large == 0:
        return 1.0
    if small < least * large or small == 0:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def to_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u4")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, n_signatures) of every row; null text counts as empty."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for part in slices(stream):
            found = signer.fingerprints(as_bytes(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(to_text, found), pa.string()), pa.array(map(len, found), pa.int32())],
                names=["doc_id", "fingerprint", "n_signatures"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint string, n_signatures int")


def with_next(docs: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next_text): every row with the text of the next one, by falling id; the last has the first's.

    Ids are cut into ranges of about equal counts. Inside a range the next row is the window's; the last row of a
    range takes the first of the next range that has rows, of which there is one per range. Null text is empty, null
    ids come last, and rows with one id are in order of text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = rows.where("doc_id IS NOT NULL").select("doc_id").approxQuantile(
        "doc_id", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = sorted({int(c) for c in cuts})
    # falling ids: the range number is minus the number of cuts at or below the id; null ids go to the very last one
    below = F.array_position(F.transform(F.array(*map(F.lit, [*cuts[::-1], -(1 << 63)])), lambda c: c <= F.col("doc_id")), True)
    ranged = rows.withColumn("range", F.coalesce(below, F.lit(len(cuts) + 2)).cast("int"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), (-F.col("doc_id")).alias("order"), F.col("text").alias("text"))
    heads = ranged.groupBy("range").agg(F.min(place).alias("head"))
    around = W.orderBy("range")
    ranges = stored(heads.select("range", F.col("head.text").alias("head")), "heads")
    order = ranges.select("range").withColumn("successor", F.coalesce(
        F.lead("range").over(around), F.first("range").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    follow = order.join(ranges.select(F.col("range").alias("successor"), "head"), "successor").select("range", "head")
    inside = W.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    lead = ranged.withColumn("inside", F.lead("text").over(inside))
    return lead.join(follow, "range").select("doc_id", "text", F.coalesce("inside", "head").alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half of characters replaced by as many of the next text, or all of it."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def compare_texts(rows: DataFrame, pairs: dict[str, str], prints: dict[str, str], keep: list[str]) -> DataFrame:
    """Fingerprints of text columns, and likenesses between them.

    ``prints`` names the output column of each text column's fingerprint; ``pairs`` names the output column of the
    likeness to ``text`` of each other text column. Columns in ``keep`` are passed on.
    """
    texts = list(dict.fromkeys(["text", *prints, *pairs]))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for part in slices(stream, "text", 3 << 20):
            found = {name: signer.fingerprints(as_bytes(part, name)) for name in texts}
            columns = [part.column(name) for name in keep]
            columns += [pa.array(map(to_text, found[name]), pa.string()) for name in prints]
            columns += [pa.array(map(likeness, found["text"], found[name]), pa.float64()) for name in pairs]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *prints.values(), *pairs.values()])

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = [f"{n} {types[n]}" for n in keep] + [f"{n} string" for n in prints.values()] + [f"{n} double" for n in pairs.values()]
    return rows.select(*dict.fromkeys([*keep, *texts])).mapInArrow(run, ", ".join(schema))


def length_partition(n: Column, least: float) -> Column:
    """The partition of a set length; sets that may be alike are in the same partition or in neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.lit(-float(np.log(least))) + F.lit(1e-9)).cast("int")


def near_duplicates(docs: DataFrame, least: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs (a, b, likeness) of distinct fingerprints at or above ``least``, by representative, a < b.

    Equal fingerprints are one row, represented by the smallest id, so copies meet nothing twice. A fingerprint is
    looked up by the signatures that come first by rarity: of two that are alike, one of each is the same. Signatures
    are counted over all fingerprints. Fingerprints that nothing shares a first signature with never form a pair, and
    the lengths prune before anything is intersected. Empty fingerprints pair with nothing.
    """
    printed = fingerprint(docs, id_col, text_col).where("n_signatures > 0")
    distinct = stored(printed.groupBy("fingerprint", "n_signatures").agg(F.min("doc_id").alias("id")), "fingerprints")

    def unfold(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stream:
            found = list(map(from_text, part.column("fingerprint").to_pylist()))
            owner = np.repeat(np.arange(part.num_rows), list(map(len, found)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(owner)), part.column("n_signatures").take(pa.array(owner)),
                 pa.array(np.concatenate(found).astype(np.int64))], names=["id", "n", "signature"])

    signatures = distinct.mapInArrow(unfold, "id long, n int, signature long")
    counted = signatures.join(signatures.groupBy("signature").agg(F.count(F.lit(1)).alias("df")), "signature")
    first = F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1
    rarest = counted.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("df", "signature"))) \
        .where((F.col("rank") <= first) & (F.col("df") > 1)).withColumn("band", length_partition(F.col("n"), least))
    rarest = stored(rarest.select("id", "n", "signature", "band"), "first-signatures")
    left = rarest.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    pairs = left.alias("x").join(
        rarest.alias("y"), (F.col("x.signature") == F.col("y.signature")) & (F.col("x.band") == F.col("y.band"))
        & (F.col("x.id") != F.col("y.id")) & (F.col("x.n") >= F.lit(least) * F.col("y.n"))
        & (F.col("y.n") >= F.lit(least) * F.col("x.n")),
    ).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()

    def intersect(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stream:
            values = [
                likeness(from_text(x), from_text(y), least)
                for x, y in zip(part.column("fa").to_pylist(), part.column("fb").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(values, pa.float64())], names=["a", "b", "likeness"])

    both = pairs.join(distinct.select(F.col("id").alias("a"), F.col("fingerprint").alias("fa")), "a").join(
        distinct.select(F.col("id").alias("b"), F.col("fingerprint").alias("fb")), "b")
    return both.mapInArrow(intersect, "a long, b long, likeness double").where(F.col("likeness") >= least)


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text with its fingerprint, that of its edited text, and both likenesses.

    (doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next). An empty table gives an
    empty result; of equal rows each counts as the other's next.
    """
    paired = with_next(docs, shuffle_parts(docs.sparkSession), id_col, text_col)
    rows = paired.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "text", "next_text",
        edited(F.col("text"), F.col("next_text")).alias("edited_text"))
    return compare_texts(
        rows, {"edited_text": "near_edited", "next_text": "near_next"},
        {"text": "fingerprint", "edited_text": "edited_fingerprint"}, ["doc_id", "n_chars", "edited_text"])
