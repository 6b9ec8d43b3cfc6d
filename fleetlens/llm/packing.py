"""Harmonic packing of documents into sequences of a fixed number of tokens.

Pieces are sorted into reciprocal-capacity classes: class k holds lengths above capacity / (k + 1) and up to
capacity / k, and a bin of class k takes exactly k pieces, so bins of a class are filled by counting alone, without
looking at other classes or other bins. Documents are cut so that classes fit exactly: into full sequences and the
binary digits of what is left, which makes every length capacity / 2 ** j and every full bin free of padding. The last
k - 1 pieces or fewer of a class form bins of a power of two of pieces each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.text import slices, stored
from fleetlens.llm.tokens import WordTokenizer

CAPACITY = 4096
END_ID = 2
COUNTING_ROWS = 20_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then the binary digits of the rest, largest first. ``capacity`` is a power of two."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    return lengths + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: (doc_id, start, length, ids_crc32, doc_tokens).

    A document is its token ids followed by ``end_id``; null text is empty text, so it is ``end_id`` alone. The file
    at ``tokenizer_path`` must be readable on the executors.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(tokenizer_path)
        for batch in slices(batches, limit=2 << 20):
            numbers, starts, lengths, sums, totals = [], [], [], [], []
            for number, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                at = 0
                for length in cut_lengths(len(ids), capacity):
                    numbers.append(number)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(ids[at:at + length].tobytes()))
                    totals.append(len(ids))
                    at += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in (numbers, starts, lengths, sums, totals)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, PIECE)


def _log2(value: Column) -> Column:
    """Position of the highest bit."""
    return F.length(F.bin(value)) - F.lit(1)


def harmonic_pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    A piece's class is capacity // length. Pieces are counted off within (class, share of the rows); a share's place
    follows from the counts of the shares before it, so that no task sees a whole class. Bin n of class k takes the
    pieces k * n to k * n + k - 1. The m < k pieces that are left take one bin per binary digit of m, of that many
    pieces. Lengths from 1 to ``capacity``; ties are broken by document and start, and the order of fully equal rows
    does not matter. An empty table gives an empty result.
    """
    pieces = stored(pieces, "pieces")
    shares = max(1, -(-pieces.count() // COUNTING_ROWS))
    by = ["class", "share"]
    keyed = pieces.withColumns({
        "class": F.floor(F.lit(capacity) / F.col("length")).cast("int"),
        "share": F.pmod(F.xxhash64("doc_id", "start"), F.lit(shares)).cast("int"),
    })
    counts = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("class").orderBy("share").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *by, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(W.partitionBy("class")).alias("of_class"))
    inside = W.partitionBy(*by).orderBy("doc_id", "start", "ids_crc32")
    placed = keyed.withColumn("rank", F.row_number().over(inside).cast("long") - 1).join(offsets, by)
    rank, k = F.col("before") + F.col("rank"), F.col("class").cast("long")
    full = F.floor(F.col("of_class") / k).cast("long")
    left = F.col("of_class") - full * k
    within = rank - full * k
    digit = _log2(F.greatest(within.bitwiseXOR(left), F.lit(1)))
    late = rank >= full * k
    bin_of_class = F.when(late, full + digit).otherwise(F.floor(rank / k).cast("long"))
    numbered = placed.withColumns({
        "sequence_id": bin_of_class * F.lit(capacity + 1) + k, "_rank": rank,
    })
    in_bin = W.partitionBy("sequence_id").orderBy("_rank").rowsBetween(W.unboundedPreceding, -1)
    return numbered.withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0))).select(
        *pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every document cut and packed; one row per piece.

    Repeated rows are packed as often as they occur. Columns other than doc_id and text are not read.
    """
    return harmonic_pack(cut_documents(docs, tokenizer_path, capacity, end_id), capacity)
