"""Prefix trie of conversations by Z-fast tries.

A node of the trie is a distinct sequence of turns that some conversation begins with, known by the digest of that
prefix. Every task keeps a compacted trie: an edge stands for a run of nodes without a branch or an end, and a
dictionary knows each edge by the digest at its two-fattest depth (the depth in the edge with most trailing zero bits).
A conversation finds the edge where it leaves the trie by a binary search over its own depths along that dictionary,
so it asks about log2(turns) times, however long the shared prefix is; only there the trie is split and a leaf is added.
Conversations come in batches, equal ones of a batch as one. A full trie hands out its nodes, edges expanded, and the
task goes on with an empty one. The nodes of all tasks are merged by digest; sums are made before they are shuffled, so
a prefix that very many conversations share costs one row per task.

What a subtree adds up to follows from chains: a node belongs to the smallest conversation through it, so a
conversation owns the deepest part of its path, and adds the sums of that part to the nodes above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import stored

DIGEST = 16
ROOT = bytes(DIGEST)
# Turns a task's trie holds before it hands out its nodes.
TRIE_TURNS = 400_000
# Ids are joined in blocks of 2 ** BLOCK_BITS consecutive numbers before they are hashed in order.
BLOCK_BITS = 7


# --- conversations as sequences of digests --------------------------------------------------------


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns (turn, digest, size) in order; texts stay behind.

    Order is by turn, null first, and by digest where turns are equal, so equal rows stay and their order is fixed.
    Null role or text counts as empty; rows without a conv_id belong to no conversation and are left out. The list of
    a conversation holds some 40 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST)
    turn = F.struct(F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    known = turns.where(F.col("conv_id").isNotNull())
    return known.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def share_heads(lists: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % family.

    h is crc32 of the decimal id modulo ``most``; a shorter head is taken whole, an absent one counts as empty.
    """
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = lists.select("conv_id", "turns", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    heads = lists.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    none = F.slice("turns", 1, 0)
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    first = F.when(F.col("first").isNull(), none).otherwise(F.slice("first", 1, F.col("h")))
    return own.join(heads, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def _prefixes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all prefixes of a conversation, the empty one first, and the sizes of its turns."""
    for batch in stream:
        paths, sizes = [], []
        for digests, lengths in zip(batch.column("digests").to_pylist(), batch.column("sizes").to_pylist()):
            path = [ROOT]
            for digest in digests:
                path.append(hashlib.blake2b(path[-1] + digest, digest_size=DIGEST).digest())
            paths.append(b"".join(path))
            sizes.append(np.array(lengths, dtype=np.int64).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(paths, pa.binary()), pa.array(sizes, pa.binary())],
            names=["conv_id", "path", "sizes"])


# --- the compacted trie ---------------------------------------------------------------------------


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with most trailing zero bits."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie over sequences that are given by the digests of their prefixes.

    Node k covers the depths low[k] + 1 to high[k] of its path; node 0 is the root. ``ends`` counts the sequences that
    end at a node's deepest depth, ``least`` is the smallest of their ids.
    """

    def __init__(self):
        self.low, self.high, self.paths, self.parent = [0], [0], [([ROOT], [0])], [-1]
        self.ends: list[int] = [0]
        self.least: list[int | None] = [None]
        self.handles: dict[bytes, int] = {}
        self.first: dict[bytes, int] = {}
        self.turns = 0

    def _common(self, node: int, prefixes: list[bytes], low: int, high: int) -> int:
        """The largest depth in low..high at which the node's path and the sequence agree; they do at low."""
        path = self.paths[node][0]
        while low < high:
            middle = (low + high + 1) // 2
            if path[middle] == prefixes[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def locate(self, prefixes: list[bytes]) -> tuple[int, int]:
        """The exit: the node whose edge the sequence leaves, or at whose end, and how many of its turns are there."""
        turns = len(prefixes) - 1
        node, low, high = 0, 0, turns
        while low < high:
            fat = two_fattest(low, high)
            found = self.handles.get(prefixes[fat])
            if found is None:
                high = fat - 1
                continue
            end = self.high[found]
            if end > turns or self.paths[found][0][end] != prefixes[end]:
                return found, self._common(found, prefixes, fat, min(end, turns))
            node, low = found, end
        if low < turns:
            found = self.first.get(prefixes[low + 1])
            if found is not None:
                return found, self._common(found, prefixes, low + 1, min(self.high[found], turns))
        return node, low

    def _enter(self, node: int) -> None:
        low, path = self.low[node], self.paths[node][0]
        self.handles[path[two_fattest(low, self.high[node])]] = node
        self.first[path[low + 1]] = node

    def _add(self, low: int, high: int, path, parent: int) -> int:
        for column, value in zip((self.low, self.high, self.paths, self.parent, self.ends, self.least), (low, high, path, parent, 0, None)):
            column.append(value)
        return len(self.low) - 1

    def insert(self, prefixes: list[bytes], sizes: list[int], count: int, least: int) -> None:
        """Add ``count`` equal sequences, whose smallest id is ``least``. ``sizes`` has an entry per prefix."""
        node, depth = self.locate(prefixes)
        if depth < self.high[node]:
            upper = self._add(self.low[node], depth, self.paths[node], self.parent[node])
            self.low[node], self.parent[node] = depth, upper
            self._enter(upper)
            self._enter(node)
            node = upper
        if depth < len(prefixes) - 1:
            node = self._add(depth, len(prefixes) - 1, (prefixes, sizes), node)
            self._enter(node)
            self.turns += len(prefixes)
        self.ends[node] += count
        self.least[node] = least if self.least[node] is None else min(least, self.least[node])

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int, int]]:
        """(digest, parent, depth, size, n_convs, n_ends, conv_id) of every node, edges expanded."""
        counts, least = list(self.ends), list(self.least)
        for node in sorted(range(1, len(self.low)), key=self.high.__getitem__, reverse=True):
            above = self.parent[node]
            counts[above] += counts[node]
            least[above] = least[node] if least[above] is None else min(least[above], least[node])
        if counts[0]:
            yield ROOT, None, 0, 0, counts[0], self.ends[0], least[0]
        for node in range(1, len(self.low)):
            path, sizes = self.paths[node]
            high = self.high[node]
            for depth in range(self.low[node] + 1, high + 1):
                yield (path[depth], path[depth - 1], depth, sizes[depth], counts[node],
                       self.ends[node] if depth == high else 0, least[node])


_NODE = pa.schema([("digest", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("size", pa.int64()),
                   ("n_convs", pa.int64()), ("n_ends", pa.int64()), ("conv_id", pa.int64())])
_NODE_SQL = "digest binary, parent binary, depth long, size long, n_convs long, n_ends long, conv_id long"
_OUT_ROWS = 20_000


def _rows(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
    held = []
    for row in trie.nodes():
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _NODE.types)], schema=_NODE)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _NODE.types)], schema=_NODE)


def _task_nodes(limit: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in stream:
            equal: dict[bytes, list] = {}
            for number, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes"))):
                known = equal.setdefault(path[-DIGEST:], [path, sizes, 0, number])
                known[2] += 1
                known[3] = min(known[3], number)
            for path, sizes, count, least in equal.values():
                prefixes = [path[k:k + DIGEST] for k in range(0, len(path), DIGEST)]
                trie.insert(prefixes, [0, *np.frombuffer(sizes, np.int64).tolist()], count, least)
                if trie.turns > limit:
                    yield from _rows(trie)
                    trie = ZFastTrie()
        yield from _rows(trie)

    return run


# --- sums over subtrees, and the digests of ends --------------------------------------------------


def _chain_sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the owned part of a path adds to every node of the path: saved bytes, leaves and children."""
    for batch in stream:
        out = [[], [], [], []]
        for path, own, leaf in zip(*(batch.column(c).to_pylist() for c in ("path", "own", "leaf"))):
            turns = len(path) // DIGEST - 1
            top = turns + 1 - len(own)
            below = np.zeros(turns + 1, dtype=np.int64)
            below[[r["depth"] for r in own]] = [r["saved"] for r in own]
            below = np.cumsum(below[::-1])[::-1]
            child = np.zeros(turns + 1, dtype=np.int64)
            child[max(top - 1, 0):turns] = 1
            out[0] += [path[k:k + DIGEST] for k in range(0, len(path), DIGEST)]
            out[1].append(below)
            out[2].append(np.full(turns + 1, int(leaf), dtype=np.int64))
            out[3].append(child)
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), *(pa.array(np.concatenate(c)) for c in out[1:])],
                names=["digest", "saved", "leaves", "children"])


def _ends_digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 over the ids of each digest; the blocks of one come one after the other, in order."""
    current, running, found = None, None, []
    for batch in stream:
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
            if digest != current:
                if current is not None:
                    found.append((current, running.hexdigest()))
                current, running = digest, hashlib.sha256(ids.encode())
            else:
                running.update(f",{ids}".encode())
        if len(found) >= _OUT_ROWS:
            yield _ends_batch(found)
            found = []
    if current is not None:
        yield _ends_batch([*found, (current, running.hexdigest())])


def _ends_batch(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
    digests, values = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(values, pa.string())], names=["digest", "ends_sha256"])


def ends_digests(paths: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the nodes where conversations end.

    sha256 goes over its input in order, so one task reads the ids of a node; they come as joined blocks, and it holds
    one block at a time however many there are.
    """
    last = F.substring("path", -DIGEST, DIGEST)
    blocks = paths.groupBy(last.alias("digest"), F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return blocks.repartition("digest").sortWithinPartitions("digest", "block").mapInArrow(
        _ends_digests, "digest binary, ends_sha256 string")


def _empty_digest() -> Column:
    return F.lit(hashlib.sha256(b"").hexdigest())


def prefix_trie(lists: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """The nodes of the trie over conversations (conv_id, turns with digest and size), one row each.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a node is known by its
    smallest member and its depth, a parent by its smallest member (null at the root). Conversations without turns are
    members of the root. Subtrees include their top; saved_tokens adds (n_convs - 1) times the bytes of a node's last
    text. Turns are equal if 128 bits of their sha256 are. No conversations give no nodes.
    """
    turns = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    paths = stored(turns.mapInArrow(_prefixes, "conv_id long, path binary, sizes binary"), "paths")
    nodes = stored(paths.mapInArrow(_task_nodes(trie_turns), _NODE_SQL).groupBy("digest").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("size").alias("size"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"), F.min("conv_id").alias("conv_id")), "nodes")
    saved = (F.col("size") * (F.col("n_convs") - 1)).alias("saved")
    # The deepest node of a chain is where its owner ends; it is a leaf if all of its members end there.
    chains = nodes.groupBy("conv_id").agg(
        F.collect_list(F.struct("depth", saved)).alias("own"),
        F.max_by(F.col("n_ends") == F.col("n_convs"), "depth").alias("leaf"))
    sums = chains.join(paths.select("conv_id", "path"), "conv_id").select("path", "own", "leaf").mapInArrow(
        _chain_sums, "digest binary, saved long, leaves long, children long").groupBy("digest").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children"))
    above = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.join(above, "parent", "left").select("digest", "conv_id", "depth", "parent_conv_id", "n_convs")
    ends = F.coalesce("ends_sha256", _empty_digest()).alias("ends_sha256")
    return placed.join(sums, "digest").join(ends_digests(paths), "digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends)
