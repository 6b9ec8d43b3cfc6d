"""Jaccard join of documents on word shingles, by size-banded tiles with bitmap signatures.

A document is the sorted array of its shingle hashes. Two documents can only link if their sizes are close and if they
share one of the few shingles that come first in a common order (very common ones last). The smallest document that has
a shingle among its first leads it; a tile is a leader and a band of sizes, and holds the documents of the band and of
the band below that share a first shingle with the leader. So documents that resemble each other meet in few tiles,
however many shingles they share, and each brings its set there once.

In a tile, bitmaps of hashed shingles bound every overlap from above. Documents that a bound does not tell apart are
joined to groups; of the pairs of a tile only as many go out as it takes to join them, fewer than it has documents. Every
link is within such a group. Each group then meets once more, now with its sets: what passes the bounds is intersected
exactly, there and then, and again only those links go out that join two parts. A tile or a group with too many
documents, or too much of them, is cut into chunks, and its pairs of chunks are worked on by different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.graph import components
from fleetlens.llm.text import (
    RollingHashes, as_bytes, bit_filter, joined_words, mix, shuffle_parts, slices, stored, with_filter, word_hashes,
)

SHINGLE = 5
PERCENT = 80
COMMON_SHARE = 2_000
COMMON_MOST = 500_000
EXTRA = 3
CHUNK_DOCS = 2_000
CHUNK_BYTES = 8_000_000
GROUP_BYTES = 32_000_000
_MASK = np.uint64((1 << 48) - 1)


def pack_set(values: np.ndarray) -> bytes:
    """Sorted 48-bit numbers, six bytes each."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpack_sets(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the sets one after the other, and where each set begins (one entry more)."""
    six = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, 2:] = six
    return eight.view(">u8").ravel().astype(np.uint64), np.concatenate([[0], np.cumsum([len(b) // 6 for b in blobs])]).astype(np.int64)


def _shingles(words: list[bytes], offsets: np.ndarray, hashes: np.ndarray, length: int):
    """(document, hash) of the distinct shingles, in order."""
    counts = np.diff(offsets)
    starts = np.where(counts >= length, counts - length + 1, 0)
    first = np.concatenate([[0], np.cumsum(starts)])
    owner = np.repeat(np.arange(len(counts)), starts)
    at = np.arange(first[-1]) - np.repeat(first[:-1], starts) + offsets[:-1][owner]
    rolling = RollingHashes(hashes)
    value = rolling.runs(at, length) if len(at) else np.zeros(0, np.uint64)
    for short in range(1, length):
        few = np.flatnonzero(counts == short)
        if len(few):
            owner = np.concatenate([owner, few])
            value = np.concatenate([value, rolling.runs(offsets[:-1][few], short)])
    value = value & _MASK
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def own_keys(docs: DataFrame, id_col: str = "doc_id") -> tuple[Column, int | None]:
    """The key of a row, and the largest id; None for it when every row has an id.

    The key is the id. A row without one has a number of its own above all ids, which holds only once it is written.
    """
    number = F.col(id_col).cast("long")
    largest, missing = docs.agg(F.max(number), F.count_if(number.isNull())).first()
    if not missing:
        return number, None
    largest = -1 if largest is None else largest
    if largest >= (1 << 63) - (1 << 52):
        raise ValueError(f"ids up to {largest} leave no numbers for the {missing} rows without an id")
    return F.coalesce(number, F.monotonically_increasing_id() + F.lit(largest + 1)), largest


def shingle_sets(docs: DataFrame, key: Column, length: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """(id, n, digest, set): the distinct shingles of ``length`` words of every row.

    A text with fewer words is one shingle; without words the set is empty. ``set`` is null for empty sets and for
    those that an earlier row of the same batch has; the digest tells which are equal.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(stream, limit=2 << 20):
            words, offsets = joined_words(as_bytes(part), lower=True)
            owner, value = _shingles(words, offsets, word_hashes(words), length)
            sizes = np.bincount(owner, minlength=part.num_rows)
            packed = pack_set(value)
            ends = np.concatenate([[0], np.cumsum(sizes)]) * 6
            seen, digests, sets = set(), [], []
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
                digest = xxhash.xxh3_128_digest(packed[lo:hi])
                digests.append(digest)
                sets.append(packed[lo:hi] if hi > lo and digest not in seen else None)
                seen.add(digest)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())],
                names=["id", "n", "digest", "set"])

    source = docs.select(key.alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, n int, digest binary, set binary")


def _per_set(stream: Iterator[pa.RecordBatch], limit: int = 4 << 20):
    """Batches of sets as (batch, numbers, offsets)."""
    for part in slices(stream, "set", limit):
        yield part, *unpack_sets(part.column("set").to_pylist())


def common_shingles(sets: DataFrame) -> np.ndarray:
    """Shingles of very many documents, to be put last in the order; sorted.

    A batch reports what it has three times or more and at least in a thousandth of its rows; a shingle is common if
    the reports add up to one in COMMON_SHARE documents. So there are at most COMMON_SHARE times the mean set size of
    them, and COMMON_MOST are kept. The order they make is a matter of speed; any order gives the same links.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, _ in _per_set(stream, 8 << 20):
            found, counts = np.unique(values, return_counts=True)
            keep = counts >= max(3, part.num_rows // 1000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[keep].astype(np.int64)), pa.array(counts[keep].astype(np.int64))], names=["shingle", "n"])

    least = max(50, sets.count() // COMMON_SHARE)
    found = stored(sets.where("set IS NOT NULL").select("set").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).where(F.col("n") >= least), "common")
    rows = found.orderBy(F.col("n").desc(), "shingle").limit(COMMON_MOST).collect()
    return np.sort(np.array([r["shingle"] for r in rows], dtype=np.int64).astype(np.uint64))


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _first_shingles(values: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the common order (common ones last, by hash).

    A partner lacks at most n - percent * n / 100 of a document's shingles. So of the first shingles of both, one more
    than EXTRA are the same, or all that the two have in common if that is less.
    """
    n = len(values)
    count = n - -(-percent * n // 100) + 1 + EXTRA
    if common.any():
        values = values[np.argsort(common, kind="stable")]
    return values[:count]


def _links(overlap, a, b, percent: int):
    """Whether 100 * intersection >= percent * union."""
    return overlap * (100 + percent) >= percent * (a + b)


def _entries(common: np.ndarray, percent: int):
    """(shingle, id) of the first shingles of every set."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, ends in _per_set(stream):
            late = _in_sorted(values, common)
            chosen = [_first_shingles(values[lo:hi], late[lo:hi], percent) for lo, hi in zip(ends[:-1], ends[1:])]
            ids = np.repeat(part.column("id").to_numpy(), [len(c) for c in chosen])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(chosen).astype(np.int64)), pa.array(ids)], names=["shingle", "id"])

    return run


def distinct_sets(sets: DataFrame) -> DataFrame:
    """(id, set), one row for equal sets: the smallest id of those that have the set with them.

    Sets that may occur again are known from a bit filter; only these are shuffled, once, and what is left of them is
    stored, as every pass over the result would shuffle them again.
    """
    held = sets.where("set IS NOT NULL")
    again = stored(held.groupBy("digest").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("digest"), "again")
    marked = with_filter(held, bit_filter(again, "digest"), "digest", "again")
    once = marked.where(~F.col("again")).select("id", "set")
    return once.unionByName(stored(marked.where("again").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("set").alias("set")).select("id", "set"), "again-sets"))


def _narrowed(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``df`` without most of the rows whose value is not among ``keys``."""
    return with_filter(df, bit_filter(keys, column), column, "_wanted").where("_wanted").drop("_wanted")


def led_documents(reps: DataFrame, sized: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(leader, id, n, band, key), stored: each document with the leaders of those of its first shingles that it shares.

    The first shingles are taken from the sets in either pass; stored, they would take a third of the documents' bytes.
    """
    entries = reps.mapInArrow(_entries(common, percent), "shingle long, id long")
    shared = stored(entries.groupBy("shingle").agg(F.min("id").alias("leader"), F.max("id").alias("other")).where(
        "leader < other").select("shingle", "leader"), "shared")
    led = stored(_narrowed(entries, shared, "shingle").join(shared, "shingle").groupBy("leader", "id").agg(
        F.count(F.lit(1)).alias("times")), "shared-first")
    # Who shares fewer first shingles than any partner has with it has none.
    least = F.least(F.lit(EXTRA + 1), F.ceil(F.col("n") * percent / 100))
    enough = led.groupBy("id").agg(F.sum("times").alias("times")).join(sized.distinct(), "id").where(
        F.col("times") >= least).select("id", "n", "band")
    return _together(stored(led.select("leader", "id").join(enough, "id"), "led"))


def _together(led: DataFrame) -> DataFrame:
    """``led`` with ``key``: tiles of one key are worked on by one task, so a document of several comes there once.

    A leader goes with the first of its own leaders, unless more than CHUNK_DOCS documents would then come together.
    """
    firsts = led.groupBy("id").agg(F.min("leader").alias("key")).withColumnRenamed("id", "leader")
    # A leader may have been left out itself, as sharing too little; it goes with nobody then.
    keyed = led.join(firsts, "leader", "left").withColumn("key", F.coalesce("key", "leader"))
    few = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") <= CHUNK_DOCS).select(
        "key", F.lit(True).alias("few"))
    return stored(keyed.join(few, "key", "left").withColumn(
        "key", F.when(F.col("few"), F.col("key")).otherwise(F.col("leader"))).drop("few"), "led")


def _parted(df: DataFrame) -> DataFrame:
    """``df`` with the pairs of chunks (``part``) that a document is in, and its chunk; -1 where both are the same."""
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    both = df.withColumn("chunk", chunk).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    low, high = F.least("chunk", "with"), F.greatest("chunk", "with")
    return both.withColumns({"part": low * F.col("chunks") + high, "chunk": F.when(low < high, F.col("chunk")).otherwise(F.lit(-1))})


def _chunks(docs: str, volume: str) -> Column:
    return F.greatest(F.ceil(F.col(docs) / CHUNK_DOCS), F.ceil(F.col(volume) * 6 / CHUNK_BYTES)).cast("long").alias("chunks")


def tile_members(led: DataFrame, buckets: int) -> DataFrame:
    """(bucket, id, tiles), one row per document and bucket of tiles.

    A tile needs documents at home in its band, and two documents at least.
    """
    homes = led.groupBy("leader", "band").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("n").cast("long")).alias("volume"))
    one = F.lit(1).cast("int")
    tiles = homes.withColumn("home", F.col("docs")).unionByName(
        homes.withColumns({"band": F.col("band") + one, "home": F.lit(0).cast("long")})).groupBy("leader", "band").agg(
        F.sum("docs").alias("docs"), F.sum("volume").alias("volume"), F.sum("home").alias("home")).where(
        "home > 0 AND docs > 1").select("leader", F.col("band").alias("tile"), _chunks("docs", "volume"))
    there = _parted(
        led.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") + one))).join(tiles, ["leader", "tile"]))
    member = F.struct(
        F.xxhash64("leader", "tile", "part").alias("tile"), (F.col("tile") == F.col("band")).alias("home"), F.col("chunk").cast("long").alias("chunk"))
    return there.groupBy(F.pmod(F.xxhash64("key", "part"), F.lit(buckets)).alias("bucket"), "id").agg(
        F.collect_list(member).alias("tiles"))


def group_members(groups: DataFrame, sized: DataFrame, buckets: int) -> DataFrame:
    """(bucket, id, tiles), one row per document and bucket of groups; a group is one tile."""
    known = groups.join(sized.select("id", "n").distinct(), "id")
    sizes = known.groupBy("component").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("n").cast("long")).alias("volume")).select("component", _chunks("docs", "volume"))
    member = F.struct(
        F.xxhash64("component", "part").alias("tile"), F.lit(True).alias("home"),
        F.col("chunk").cast("long").alias("chunk"))
    return _parted(known.select("id", "component").distinct().join(sizes, "component")).groupBy(
        F.pmod(F.xxhash64("component", "part"), F.lit(buckets)).alias("bucket"), "id").agg(F.collect_list(member).alias("tiles"))


def signature_words(band: int, percent: int) -> int:
    """64-bit words of a band's bitmaps: one and a half to three bits for every shingle of its largest set."""
    largest = (100.0 / percent) ** (band + 1)
    return int(2 ** np.ceil(np.log2(max(1.0, 1.5 * largest / 64))))


def signature(values: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[(mix(values, 9) % np.uint64(words * 64)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def folded(blobs: list[np.ndarray], words: int) -> np.ndarray:
    """Bitmaps of ``words`` words as rows; a wider one is laid over itself, so that a shingle has one bit as before."""
    return np.stack([np.bitwise_or.reduce(b.reshape(-1, words), axis=0) if len(b) > words else b for b in blobs])


def _band(n: int, percent: int) -> int:
    """Sizes that can link are in the same band or in neighbouring ones."""
    return int(np.floor(np.log(n) / -np.log(percent / 100.0) + 1e-9))


def _sized(percent: int):
    """(id, n, band) of every set."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stream:
            sizes = pc.binary_length(part.column("set")).to_numpy() // 6
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sizes, pa.int32()), pa.array([_band(n, percent) for n in sizes], pa.int32())],
                names=["id", "n", "band"])

    return run


def _signed(percent: int):
    """(id, n, bits) of every set; the bitmap is as wide as its band needs it."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values, ends in _per_set(stream):
            sizes = np.diff(ends)
            bits = [signature(values[lo:hi], signature_words(_band(hi - lo, percent), percent)).tobytes()
                    for lo, hi in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary())], names=["id", "n", "bits"])

    return run


def overlap_bounds(one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """No intersection of the set with one of the others is larger: every bit that only one has costs it a shingle."""
    lost = np.bitwise_count(one & ~others).sum(axis=1, dtype=np.int64)
    lacks = np.bitwise_count(others & ~one).sum(axis=1, dtype=np.int64)
    return np.minimum(n - lost, sizes - lacks)


class _Bucket:
    """The documents of a bucket, in order of size, their tiles, and which of them are joined."""

    def __init__(self, table: pa.Table, sizes: np.ndarray, percent: int):
        order = np.lexsort((table.column("id").to_numpy(), sizes))
        table, self.sizes = table.take(pa.array(order)), sizes[order]
        self.table, self.percent, self.ids = table, percent, table.column("id").to_numpy()
        self.root = np.arange(len(order))
        self.links: list[tuple[int, int]] = []

    def tiles(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(documents, whether at home, chunk) of every tile in which not all are joined yet."""
        lists = self.table.column("tiles").combine_chunks()
        docs = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        tile, home, chunk = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
        order = np.lexsort((docs, tile))
        docs, tile, home, chunk = (c[order] for c in (docs, tile, home, chunk))
        starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])[:len(tile)])
        for lo, hi in zip(starts, [*starts[1:], len(tile)]):
            if (self.root[docs[lo:hi]] != self.root[docs[lo]]).any():
                yield docs[lo:hi], home[lo:hi], chunk[lo:hi]

    def join(self, one: int, others: np.ndarray) -> None:
        for other in others.tolist():
            if self.root[one] != self.root[other]:
                self.links.append((int(self.ids[one]), int(self.ids[other])))
                self.root[self.root == self.root[other]] = self.root[one]

    def work(self, docs: np.ndarray, bits: np.ndarray, home: np.ndarray, chunk: np.ndarray, linked) -> None:
        """All pairs of a tile that may link: of close sizes, one at home, from different chunks if there are two."""
        sizes = self.sizes[docs]
        ahead = np.searchsorted(sizes, 100 * sizes // self.percent, side="right")
        for k in range(len(docs) - 1):
            others = np.arange(k + 1, ahead[k])
            others = others[
                (self.root[docs[others]] != self.root[docs[k]]) & (home[k] | home[others])
                & ((chunk[others] != chunk[k]) | (chunk[k] < 0))]
            if len(others):
                bound = overlap_bounds(bits[k], bits[others], sizes[k], sizes[others])
                others = others[_links(bound, sizes[k], sizes[others], self.percent)]
            if len(others):
                linked(int(docs[k]), docs[others])

    def found(self) -> pa.Table:
        links = np.array(self.links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})


def _possible_links(percent: int):
    """Of the documents (id, n, bits, tiles) of a bucket, what joins those that the bounds do not tell apart."""

    def run(table: pa.Table) -> pa.Table:
        bucket = _Bucket(table, table.column("n").to_numpy().astype(np.int64), percent)
        blobs = [np.frombuffer(b, np.uint64) for b in bucket.table.column("bits").to_pylist()]
        for docs, home, chunk in bucket.tiles():
            mine = [blobs[k] for k in docs]
            bits = folded(mine, min(map(len, mine)))
            bucket.work(docs, bits, home, chunk, bucket.join)
        return bucket.found()

    return run


def _exact_links(percent: int):
    """Of the documents (id, set, tiles) of a bucket, links that join all that are linked."""

    def run(table: pa.Table) -> pa.Table:
        bucket = _Bucket(table, pc.binary_length(table.column("set")).to_numpy().astype(np.int64) // 6, percent)
        values, ends = unpack_sets(bucket.table.column("set").to_pylist())

        def intersect(one: int, others: np.ndarray) -> None:
            mine, volume = values[ends[one]:ends[one + 1]], np.cumsum(bucket.sizes[others]) >> 20
            for lo in np.flatnonzero(np.diff(volume, prepend=-1)):
                some = others[lo:np.searchsorted(volume, volume[lo], side="right")]
                some = some[bucket.root[some] != bucket.root[one]]
                if not len(some):
                    continue
                lengths = bucket.sizes[some]
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                at = np.arange(lengths.sum()) - np.repeat(starts - ends[some], lengths)
                overlap = np.add.reduceat(_in_sorted(values[at], mine).astype(np.int64), starts)
                bucket.join(one, some[_links(overlap, len(mine), lengths, percent)])

        for docs, home, chunk in bucket.tiles():
            words = int(2 ** np.ceil(np.log2(max(1.0, 2 * bucket.sizes[docs[-1]] / 64))))
            bits = np.stack([signature(values[ends[k]:ends[k + 1]], words) for k in docs])
            bucket.work(docs, bits, home, chunk, intersect)
        return bucket.found()

    return run


def jaccard_components(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Documents link if 100 * intersection >= ``percent`` * union of their shingle sets; a component's id is the
    smallest id in it. Words are lower-cased in A-Z. Rows without words are empty sets and link with nothing.
    Repeated rows and rows that share an id are one component. A row with a null id stands for itself and counts as
    larger than any id; a component of such rows only has a null id. Other columns are not read. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    key, largest = own_keys(docs, id_col)
    sets = stored(shingle_sets(docs, key, length, text_col), "sets")
    reps = distinct_sets(sets)
    sized = stored(reps.mapInArrow(_sized(percent), "id long, n int, band int"), "sized")
    led = led_documents(reps, sized, common_shingles(sets), percent)

    def buckets(rows: DataFrame, share: int) -> int:
        volume = rows.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
        return max(shuffle_parts(spark), volume * 6 // share // GROUP_BYTES + 1)

    # A document has some bits for every shingle here, and its set below.
    members = stored(tile_members(led, buckets(led, 8)), "members")
    bits = _narrowed(reps, members, "id").mapInArrow(_signed(percent), "id long, n int, bits binary")
    possible = members.join(bits, "id").groupBy("bucket").applyInArrow(_possible_links(percent), "a long, b long")
    groups = stored(components(possible), "groups")
    members = stored(group_members(groups, sized, buckets(groups.join(sized, "id"), 1)), "members")
    links = _narrowed(reps, members, "id").join(members, "id").groupBy("bucket").applyInArrow(
        _exact_links(percent), "a long, b long")
    equal = sets.where("n > 0").select("digest", "id")
    first = equal.groupBy("digest").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    labels = components(links.unionByName(equal.join(first, "digest").select("a", F.col("id").alias("b"))))
    found = sets.join(labels, "id", "left").select(
        "id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    known = lambda name: F.col(name) if largest is None else F.when(F.col(name) <= largest, F.col(name))
    return found.select(known("id").alias("doc_id"), "n_shingles", known("component_id").alias("component_id"))
