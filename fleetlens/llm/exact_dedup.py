"""Exact deduplication against a history: a minimal perfect hash over the history's distinct digests.

The history's digests are dealt into buckets by their leading bytes. Every bucket gets its own minimal perfect hash: a
ladder of bit arrays, in which a digest owns the first level where it falls alone; the rank of that bit is its slot.
A slot stores the full digest, where the winner is and how many copies there are. A digest that is looked up lands on
one slot; only if the bytes of the digest there are equal is it a member. Members are settled in their slot, which keeps
the winner and the number of copies; nonmembers are grouped by digest on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import SPACE, mix, stored

BUCKET_KEYS = 50_000
DIGEST = 32
_GAMMA = 2.0


def normalised(text: Column) -> Column:
    """The text with every run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), -1)
    return words[:, 1].copy(), words[:, 2].copy()


def _place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(first ^ mix(second, level), level) % np.uint64(size)


def build_function(digests: list[bytes]) -> tuple[bytes, np.ndarray]:
    """A minimal perfect hash over distinct digests of 32 bytes: its packed levels, and the slot of each digest."""
    first, second = _halves(digests)
    left = np.arange(len(digests))
    slots = np.zeros(len(digests), dtype=np.int64)
    packed, taken, level = [], 0, 0
    while len(left):
        size = max(8, int(_GAMMA * len(left)) + 7) // 8 * 8
        at = _place(first[left], second[left], level, size).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(alone) - 1 + taken
        own = alone[at]
        slots[left[own]] = rank[at[own]]
        packed.append(np.uint32(size).tobytes() + np.packbits(alone).tobytes())
        taken += int(alone.sum())
        left, level = left[~own], level + 1
    return b"".join(packed), slots


def apply_function(packed: bytes, digests: list[bytes]) -> np.ndarray:
    """The slot each digest lands on; -1 if no level has it, which only a nonmember meets."""
    first, second = _halves(digests)
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, taken, level, at_byte = np.arange(len(digests)), 0, 0, 0
    while at_byte < len(packed) and len(left):
        size = int(np.frombuffer(packed, "<u4", 1, at_byte)[0])
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, size // 8, at_byte + 4)).astype(bool)
        rank = np.cumsum(bits) - 1 + taken
        at = _place(first[left], second[left], level, size).astype(np.int64)
        slots[left[bits[at]]] = rank[at[bits[at]]]
        taken += int(bits.sum())
        left, level, at_byte = left[~bits[at]], level + 1, at_byte + 4 + size // 8
    return slots


def _key(place: dict) -> tuple:
    return place["last"], place["doc_id"], place["row"]


def _combined(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal digests of a batch as one row: the winner among them and their number."""
    for batch in stream:
        found: dict[bytes, list] = {}
        for digest, place in zip(batch.column("digest").to_pylist(), batch.column("place").to_pylist()):
            known = found.setdefault(digest, [place, 0])
            known[1] += 1
            if _key(place) < _key(known[0]):
                known[0] = place
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array([w for w, _ in found.values()], batch.schema.field("place").type),
                 pa.array([n for _, n in found.values()], pa.int64())], names=["digest", "winner", "copies"])


def _build_bucket(table: pa.Table) -> pa.Table:
    """The bucket's function, and its digests, winners and copies in the order of their slots."""
    packed, slots = build_function(table.column("digest").to_pylist())
    order = np.empty(len(slots), dtype=np.int64)
    order[slots] = np.arange(len(slots))
    ordered = table.take(pa.array(order)).combine_chunks()
    ends = pa.array([0, len(slots)], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays(ordered.column(c).chunks)) for c in ("winner", "copies")]
    return pa.table({
        "bucket": table.column("bucket").slice(0, 1), "function": pa.array([packed], pa.binary()),
        "digests": pa.array([b"".join(ordered.column("digest").to_pylist())], pa.binary()),
        "winners": lists[0], "copies": lists[1]})


def _look_up(asked: pa.Table, index: pa.Table) -> pa.Table:
    """Every slot with what the lookups add to it (settled), and the digests that no slot holds (not settled).

    A digest lands on one slot at most and is a member only if the bytes there are its own.
    """
    digests, winners, copies = [], [], []
    function = b""
    for row in index.to_pylist():
        function, stored_digests = row["function"], row["digests"]
        digests = [stored_digests[k:k + DIGEST] for k in range(0, len(stored_digests), DIGEST)]
        winners, copies = list(row["winners"]), list(row["copies"])
    outside = []
    wanted = asked.column("digest").to_pylist()
    slots = apply_function(function, wanted).tolist() if wanted else []
    asked_winners, asked_copies = asked.column("winner").to_pylist(), asked.column("copies").to_pylist()
    for k, slot in enumerate(slots):
        if slot >= 0 and digests[slot] == wanted[k]:
            copies[slot] += asked_copies[k]
            if _key(asked_winners[k]) < _key(winners[slot]):
                winners[slot] = asked_winners[k]
        else:
            outside.append(k)
    return pa.table({
        "digest": pa.array(digests + [wanted[k] for k in outside], pa.binary()),
        "winner": pa.array(winners + [asked_winners[k] for k in outside], asked.schema.field("winner").type),
        "copies": pa.array(copies + [asked_copies[k] for k in outside], pa.int64()),
        "settled": pa.array([True] * len(digests) + [False] * len(outside), pa.bool_())})


def _bucket(buckets: int) -> Column:
    """From bytes of the digest that the hash ladder does not use."""
    return (F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % buckets).cast("int").alias("bucket")


def build_index(distinct: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of distinct digests (digest, winner, copies): its packed function and its slots."""
    place = distinct.schema["winner"].dataType.simpleString()
    built = distinct.select(_bucket(buckets), "digest", "winner", "copies").groupBy("bucket").applyInArrow(
        _build_bucket, f"bucket int, function binary, digests binary, winners array<{place}>, copies array<long>")
    return stored(built, "mph-index")


def winners(history: DataFrame, incoming: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row (digest, winner, copies) per distinct digest of both inputs (digest, place).

    The history is one row per digest and fills the slots. Incoming rows are combined within their batch only, so a
    text with a third of all rows comes as few rows; members are settled by their slot, and nonmembers are grouped
    by digest on their own. The bucket count follows the larger number of rows, so a bucket fits a task at any size.
    """
    keys = stored(history.groupBy("digest").agg(
        F.min("place").alias("winner"), F.count(F.lit(1)).alias("copies")), "mph-keys")
    place = keys.schema["winner"].dataType.simpleString()
    asked = stored(incoming.select("digest", "place").mapInArrow(
        _combined, f"digest binary, winner {place}, copies long"), "mph-asked")
    buckets = max(1, -(-max(keys.count(), asked.count()) // bucket_keys))
    index = build_index(keys, buckets)
    found = stored(
        asked.select(_bucket(buckets), "digest", "winner", "copies").groupBy("bucket").cogroup(index.groupBy("bucket"))
        .applyInArrow(_look_up, f"digest binary, winner {place}, copies long, settled boolean"), "mph-found")
    outside = found.where("NOT settled").groupBy("digest").agg(
        F.min("winner").alias("winner"), F.sum("copies").alias("copies"))
    return found.where("settled").drop("settled").unionByName(outside)


def exact_dedup(docs: DataFrame, is_history: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which row stays of the rows whose texts are equal after normalising white space.

    ``is_history`` tells the rows that are already in the index from those that arrive; the result does not depend on
    the split. Returns doc_id, keep_id, group_size, kept, text_sha256, one row per input row. The smallest id stays,
    null ids come last; of repeated rows with one id, exactly one is kept. Null text is empty text, and all empty
    texts are one group. Only the id and the text are read; other columns do not matter. An empty table gives none.
    """
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
        F.coalesce(is_history, F.lit(False)).alias("history"),
        F.monotonically_increasing_id().alias("row"),
    ), "digests").withColumn("place", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    found = winners(
        rows.where("history").select("digest", "place"), rows.where("NOT history").select("digest", "place"))
    joined = rows.alias("r").join(found.alias("f"), "digest")
    return joined.select(
        "r.doc_id", F.col("f.winner.doc_id").alias("keep_id"), F.col("f.copies").alias("group_size"),
        (F.col("f.winner.row") == F.col("r.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def middle_id(docs: DataFrame, id_col: str = "doc_id"):
    """The middle between the smallest and the largest id; None without ids."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    return None if low is None else (low + high) // 2
