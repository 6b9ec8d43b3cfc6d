"""Shared pieces of the text operators: words, word tables, hashes, and small batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import scratch_path

# White space of the contracts: space and the five controls from tab to carriage return. bytes.split() cuts at
# exactly these.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20
MEMO_WORDS = 300_000
BITS_PER_ROW = 16
MOST_BITS = 1 << 26
BATCH_ROWS = 1_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that a lost executor costs a re-read.

    The folder goes through ``spark.checkpoint.dir``; what a job leaves there is freed with that folder. Batches to
    and from Python are kept to BATCH_ROWS rows meanwhile, for rows here hold whole texts or sets.
    """
    path = scratch_path(df.sparkSession, name)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_ROWS if int(before) <= 0 else min(int(before), BATCH_ROWS)))
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class BitFilter:
    """Which values a column has, as rows of 4 kB of bits; how many bits there are."""

    rows: DataFrame
    bits: int


def _position(column: Column, bits: int) -> Column:
    """Where a value falls in a bit filter, from 1."""
    return F.pmod(F.xxhash64(column), F.lit(bits)) + 1


def bit_filter(rows: DataFrame, column: str) -> BitFilter:
    """A filter over a column with about BITS_PER_ROW bits a row, up to MOST_BITS, beyond which it tells less."""
    bits = 1 << (max(1 << 16, min(MOST_BITS, BITS_PER_ROW * rows.count())) - 1).bit_length()
    at = rows.select(_position(F.col(column), bits).alias("at"))
    return BitFilter(stored(at.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits")), "filter"), bits)


def with_filter(df: DataFrame, filtered: BitFilter, column: str, name: str) -> DataFrame:
    """``df`` with whether the column's value may be in the filter: always true if it is, seldom if it is not.

    The filter is broadcast; it has at most MOST_BITS bits, whatever it was made from.
    """
    at = _position(F.col(column), filtered.bits)
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(filtered.rows), "_bucket", "left")
    found = F.coalesce(F.bit_get(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    return joined.withColumn(name, found).drop("_bucket", "_bits")


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of the column, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column, None for null."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def joined_words(texts: Iterable[bytes | None], lower: bool = False) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in one list, and the offset of each text's first word (one entry more than texts)."""
    words: list[bytes] = []
    offsets = [0]
    for text in texts:
        if text:
            words.extend((text.lower() if lower else text).split())
        offsets.append(len(words))
    return words, np.asarray(offsets, dtype=np.int64)


class WordTable(dict):
    """A row of numbers per distinct word, worked out once per word and task.

    ``rows`` maps a list of new words to an array with a row for each. The table starts afresh when it holds
    ``cap`` words, so its memory is bounded however many words a corpus has.
    """

    def __init__(self, rows: Callable[[list], np.ndarray], width: int, dtype, cap: int = MEMO_WORDS):
        super().__init__()
        self._rows, self._cap, self._new = rows, cap, []
        self._table = np.zeros((1 << 12, width), dtype=dtype)

    def __missing__(self, word):
        self[word] = number = len(self)
        self._new.append(word)
        return number

    def numbers(self, words: list) -> np.ndarray:
        if len(self) > self._cap:
            self.clear()
        known = len(self)
        found = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self._new:
            fresh = self._rows(self._new)
            self._new = []
            if len(self) > len(self._table):
                grown = np.zeros((max(len(self), 2 * len(self._table)), self._table.shape[1]), self._table.dtype)
                grown[:known] = self._table[:known]
                self._table = grown
            self._table[known:len(self)] = fresh
        return found

    def lookup(self, words: list) -> np.ndarray:
        numbers = self.numbers(words)
        return self._table[numbers]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Hashing again is no slower than a look-up, and keeps no words in memory."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scrambles 64-bit numbers, so that any bits of the result can serve as a bucket."""
    with np.errstate(over="ignore"):
        h = h ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < count."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        with np.errstate(over="ignore"):
            known = np.full(max(count, 1 << 16), np.uint64(base), dtype=np.uint64)
            known[0] = 1
            known = np.multiply.accumulate(known)
        if len(known) <= 1 << 20:
            _POWERS[base] = known
    return known[:count]


class RollingHashes:
    """Hashes of runs of words at any place: prefix sums of word hash times power, modulo 2 ** 64."""

    def __init__(self, hashes: np.ndarray):
        with np.errstate(over="ignore"):
            terms = mix(hashes, 7) * _powers(_BASE, len(hashes)) if len(hashes) else hashes
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self._back = _powers(_BASE_INVERSE, len(hashes)) if len(hashes) else hashes

    def runs(self, starts: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
        """Hashes of the runs of ``length`` words that begin at ``starts``."""
        with np.errstate(over="ignore"):
            return mix((self._sums[starts + length] - self._sums[starts]) * self._back[starts], seed + length)
