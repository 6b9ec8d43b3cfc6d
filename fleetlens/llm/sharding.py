"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: it starts at an offset and goes on
by a skip, both from hashes of its name, which visits every slot once. The shards take turns; each claims the first
free slot in its order. The table has a fixed size, is broadcast, and gives every row its shard by one look-up. A
shard that goes leaves most slots of the others as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
FREE = -1


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The number of the owning shard for each slot; ``size`` must be a prime above the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(size) or size <= len(shards):
        raise ValueError("the table size must be a prime above the number of shards")
    at = [xxhash.xxh64_intdigest(name, seed=1) % size for name in shards]
    skip = [xxhash.xxh64_intdigest(name, seed=2) % (size - 1) + 1 for name in shards]
    table = np.full(size, FREE, dtype=np.int32)
    claimed = 0
    while claimed < size:
        for number in range(len(shards)):
            while table[at[number]] != FREE:
                at[number] = (at[number] + skip[number]) % size
            table[at[number]] = number
            claimed += 1
            if claimed == size:
                break
    return table


def assign_shards(docs: DataFrame, shards: Sequence[str], size: int = TABLE_SIZE, id_col: str = "doc_id") -> DataFrame:
    """doc_id, slot and shard of every row.

    The broadcast side has ``size`` rows, whatever the input holds. A null id has a hash as well and so a shard;
    repeated rows share theirs. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    owners = fill_table(shards, size)
    table = spark.createDataFrame([(k, shards[s]) for k, s in enumerate(owners.tolist())], "slot int, shard string")
    slot = F.pmod(F.xxhash64(F.col(id_col)), F.lit(size)).cast("int")
    placed = docs.select(F.col(id_col).alias("doc_id"), slot.alias("slot"))
    return placed.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")
