"""Removal of repeated runs of words by prefix-partitioned suffix trees.

A suffix here is what starts at a word, up to ``depth`` words deep. The suffixes are split by prefixes into groups that
fit a task, and every group becomes a subtree: its suffixes in order, with the depth to which neighbours agree. An
internal node at full depth is a run of ``depth`` words that starts in more than one place.

Most suffixes are leaves that share nothing with any other. Two passes keep them away from the shuffle.

1. Frequencies of prefixes. Of the runs of ANCHOR words inside a window of ``depth`` words, the one with the smallest
   hash is the window's anchor; equal windows have equal anchors at equal places, and neighbouring windows mostly share
   theirs. Only anchors are counted. A window whose anchor occurs once is a leaf.
2. Subtrees. A remaining suffix goes to the group of its first ANCHOR words. Where its anchor is frequent the prefix is
   LONG words, so that what follows a frequent prefix is spread over many groups. An anchor is frequent from a
   thousandth of all anchors on, so at most a thousand are, and the driver can tell every task which.

In both passes a task first combines equal entries of its own batch. What it has seen twice is settled: it is sent on
once, whatever its number, and the batch's own documents are told directly. So a passage in a third of all documents
arrives once per batch. Two suffixes are equal if two independent hashes over their words are, 96 bits in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import (
    RollingHashes, as_bytes, bit_filter, joined_words, mix, shuffle_parts, slices, stored, with_filter, word_hashes,
)

DEPTH = 35
ANCHOR = 12
LONG = 24
FREQUENT_SHARE = 1000
GROUP_BYTES = 32_000_000

_BLOBS = ("keys", "checks", "owners", "places", "ids", "sums")
_ENTRIES = "group long, settled boolean, " + ", ".join(f"{name} binary" for name in _BLOBS)
_ENTRY_SCHEMA = pa.schema(
    [("group", pa.int64()), ("settled", pa.bool_()), *((name, pa.binary()) for name in _BLOBS)])
_FOUND = "home long, ids binary, sums binary, counts binary, places binary, total long"
_FOUND_SCHEMA = pa.schema([
    ("home", pa.int64()), *((name, pa.binary()) for name in ("ids", "sums", "counts", "places")), ("total", pa.int64())])
_NO_ID = -(1 << 63)
_KEYS = ["id_key", "sum"]


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])[:len(sorted_values)])


def _spans(sorted_values: np.ndarray):
    starts = _starts(sorted_values)
    return zip(starts.tolist(), [*starts[1:].tolist(), len(sorted_values)])


class _Batch:
    """The words of some documents, and the places where a full window starts."""

    def __init__(self, ids: np.ndarray, sums: np.ndarray, texts: list[bytes | None], depth: int):
        self.ids, self.sums = ids, sums
        self.words, self.offsets = joined_words(texts)
        self.hashes = word_hashes(self.words)
        self.rolling = RollingHashes(self.hashes)
        counts = np.diff(self.offsets)
        starts = np.maximum(counts - depth + 1, 0)
        first = np.concatenate([[0], np.cumsum(starts)])
        self.owner = np.repeat(np.arange(len(counts)), starts)
        self.place = np.arange(first[-1]) - np.repeat(first[:-1], starts)
        self.at = self.place + self.offsets[:-1][self.owner]

    def anchors(self, depth: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Per window the word where its anchor starts, and the anchor's hash."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        best_at = np.arange(len(self.words) - anchor + 1)
        best = value = self.rolling.runs(best_at, anchor)
        width, reach = 1, depth - anchor + 1
        while width < reach:  # the smallest hash of a growing stretch, the leftmost of equals
            step = min(width, reach - width)
            take = best[step:] < best[:-step]
            best_at = np.where(take, best_at[step:], best_at[:-step])
            best = np.where(take, best[step:], best[:-step])
            width += step
        mine = best_at[self.at]
        return mine, value[mine]


def _rows(batch: _Batch, group, key, check, owner, place, homes: int) -> list[tuple]:
    """What a batch sends into the shuffle: see the module text. Negative groups carry settled places home."""
    if not len(key):
        return []
    order = np.lexsort((check, key, group))
    group, key, check, owner, place = group[order], key[order], check[order], owner[order], place[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1]) | (group[1:] != group[:-1])
    run = np.cumsum(new) - 1
    sizes = np.bincount(run)
    several = sizes[run] > 1
    rows = []
    once = np.flatnonzero(~several)
    for lo, hi in _spans(group[once]):
        part = once[lo:hi]
        documents, local = np.unique(owner[part], return_inverse=True)
        rows.append((
            int(group[part[0]]), False, key[part].tobytes(), check[part].tobytes(),
            local.astype(np.uint32).tobytes(), place[part].astype(np.uint32).tobytes(),
            batch.ids[documents].tobytes(), batch.sums[documents].tobytes()))
    heads = np.flatnonzero(new & several)
    for lo, hi in _spans(group[heads]):
        part = heads[lo:hi]
        rows.append((int(group[part[0]]), True, key[part].tobytes(), check[part].tobytes(),
                     sizes[run[part]].astype(np.int64).tobytes(), b"", b"", b""))
    own = np.flatnonzero(several)
    for home, *blobs in _by_home(batch.ids, batch.sums, owner[own], place[own], homes):
        ids, sums, counts, places = blobs
        rows.append((-1 - home, True, b"", b"", counts, places, ids, sums))
    return rows


def _by_home(ids: np.ndarray, sums: np.ndarray, owner: np.ndarray, place: np.ndarray, homes: int):
    """Places by document, packed by the home its results are gathered at: (home, ids, sums, counts, places)."""
    home = (mix(ids[owner].view(np.uint64), 13) % np.uint64(homes)).astype(np.int64)
    order = np.lexsort((place, owner, home))
    owner, place, home = owner[order], place[order].astype(np.uint32), home[order]
    for lo, hi in _spans(home):
        first = _starts(owner[lo:hi])
        documents = owner[lo:hi][first]
        counts = np.diff(np.append(first, hi - lo)).astype(np.uint32)
        yield (int(home[lo]), ids[documents].tobytes(), sums[documents].tobytes(), counts.tobytes(), place[lo:hi].tobytes())


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blob(rows: list[dict], name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), dtype=dtype)


def _subtree(frequent: int, homes: int):
    """The work on one group: its leaves in order, and the places of those under an internal node of full depth.

    Keys that occur ``frequent`` times or more are given out as well, as rows without a document.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = [(-1 - r["group"], r["ids"], r["sums"], r["owners"], r["places"], None) for r in rows if r["group"] < 0]
        leaves = [r for r in rows if r["group"] >= 0 and not r["settled"]]
        settled = [r for r in rows if r["group"] >= 0 and r["settled"]]
        owners, base = [], 0
        for r in leaves:
            owners.append(np.frombuffer(r["owners"], np.uint32).astype(np.int64) + base)
            base += len(r["ids"]) // 8
        key = np.concatenate([_blob(leaves, "keys", np.uint64), _blob(settled, "keys", np.uint64)])
        check = np.concatenate([_blob(leaves, "checks", np.uint32), _blob(settled, "checks", np.uint32)])
        owner = np.concatenate([*owners, np.full(len(key) - sum(map(len, owners)), -1, np.int64)])
        place = np.concatenate([_blob(leaves, "places", np.uint32), np.zeros(len(key) - sum(map(len, owners)), np.uint32)])
        count = np.concatenate([np.ones(sum(map(len, owners)), np.int64), _blob(settled, "owners", np.int64)])
        ids, sums = _blob(leaves, "ids", np.int64), _blob(leaves, "sums", np.int64)
        if len(key):
            order = np.lexsort((check, key))
            key, check, owner, place, count = key[order], check[order], owner[order], place[order], count[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
            heads = np.flatnonzero(new)
            total = np.add.reduceat(count, heads)
            run_of = np.cumsum(new) - 1
            hit = np.flatnonzero((total[run_of] > 1) & (owner >= 0))
            out += [(*row, None) for row in _by_home(ids, sums, owner[hit], place[hit], homes)]
            if frequent:
                for head, n in zip(heads[total >= frequent], total[total >= frequent]):
                    out.append((-1, b"", b"", b"", key[head:head + 1].tobytes(), int(n)))
        return pa.Table.from_batches([_record_batch(out, _FOUND_SCHEMA)])

    return run


def _gather(table: pa.Table) -> pa.Table:
    """One row per document with all the places found for it."""
    rows = table.to_pylist()
    ids, sums = _blob(rows, "ids", np.int64), _blob(rows, "sums", np.int64)
    counts = _blob(rows, "counts", np.uint32).astype(np.int64)
    places = _blob(rows, "places", np.uint32)
    ends = np.cumsum(counts)
    order = np.lexsort((sums, ids))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(ids[order]) != 0) | (np.diff(sums[order]) != 0)
    starts = np.flatnonzero(new)
    found = [
        b"".join([places[ends[k] - counts[k]:ends[k]].tobytes() for k in order[lo:hi]])
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(order)])
    ]
    first = order[starts]
    return pa.table({"id_key": pa.array(ids[first]), "sum": pa.array(sums[first]), "places": pa.array(found, pa.binary())})


def _batches(stream: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[_Batch, pa.RecordBatch]]:
    for part in slices(stream):
        yield _Batch(
            part.column("id_key").to_numpy(zero_copy_only=False), part.column("sum").to_numpy(zero_copy_only=False),
            as_bytes(part), depth), part


def _given(batch: _Batch, part: pa.RecordBatch) -> np.ndarray:
    """The places found for the batch's documents, counted from the batch's first word."""
    blobs = [x or b"" for x in part.column("places").to_pylist()]
    lengths = np.array([len(b) // 4 for b in blobs])
    return np.frombuffer(b"".join(blobs), np.uint32).astype(np.int64) + np.repeat(batch.offsets[:-1], lengths)


def _anchor_entries(depth: int, anchor: int, groups: int, homes: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in _batches(stream, depth):
            mine, value = batch.anchors(depth, anchor)
            new = _starts(mine)  # an anchor lies in one document, so a change of document is a change of anchor
            group = (mix(value[new], 3) % np.uint64(groups)).astype(np.int64)
            owner = batch.owner[new]
            rows = _rows(batch, group, value[new], np.zeros(len(new), np.uint32), owner,
                         mine[new] - batch.offsets[:-1][owner], homes)
            yield _record_batch(rows, _ENTRY_SCHEMA)

    return run


def _suffix_entries(depth: int, anchor: int, long: int, groups: int, frequent: np.ndarray, homes: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _batches(stream, depth):
            mine, value = batch.anchors(depth, anchor)
            shared = np.zeros(len(batch.words) + 1, dtype=bool)
            shared[_given(batch, part)] = True
            chosen = np.flatnonzero(shared[mine])
            at = batch.at[chosen]
            key = batch.rolling.runs(at, depth)
            check = (RollingHashes(mix(batch.hashes, 11)).runs(at, depth, 5) >> np.uint64(32)).astype(np.uint32)
            prefix = np.where(
                np.isin(value[chosen], frequent), batch.rolling.runs(at, long, 2), batch.rolling.runs(at, anchor, 2))
            rows = _rows(batch, (prefix % np.uint64(groups)).astype(np.int64), key, check,
                         batch.owner[chosen], batch.place[chosen], homes)
            yield _record_batch(rows, _ENTRY_SCHEMA)

    return run


def _removal(depth: int, keep: list[str]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(stream):
            texts = as_bytes(part)
            words, offsets = joined_words(texts)
            lists = part.column("places").to_pylist()
            change = np.zeros(len(words) + 1, dtype=np.int32)
            for start, found in zip(offsets[:-1].tolist(), lists):
                if found:
                    at = np.frombuffer(found, np.uint32).astype(np.int64) + start
                    np.add.at(change, at, 1)
                    np.add.at(change, at + depth, -1)
            gone = np.cumsum(change)[:-1] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])
            cleaned = []
            for text, lo, hi in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
                if text is None:
                    cleaned.append(None)
                elif removed[hi] == removed[lo]:
                    cleaned.append(b" ".join(words[lo:hi]))
                else:
                    cleaned.append(b" ".join([words[k] for k in np.flatnonzero(~gone[lo:hi]) + lo]))
            columns = [part.column(name) for name in keep]
            columns += [pa.array(np.diff(offsets), pa.int64()), pa.array(removed[offsets[1:]] - removed[offsets[:-1]], pa.int64()),
                        pa.array(cleaned, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "n_removed", "text"])

    return run


def remove_repeats(docs: DataFrame, depth: int = DEPTH, anchor: int = ANCHOR, long: int = LONG,
                   group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, text): every document without the words of its repeated windows.

    A window is ``depth`` consecutive words of one document; it is repeated if the same words start anywhere else,
    in the same document or another. The windows are judged on the input. The text is what is left, joined by single
    spaces. Words are what stands between ASCII white space, unchanged.

    Null text stays null and has no words; documents shorter than a window stay whole. Repeated rows repeat each
    other's windows. A null id is an id of its own, and rows that share an id are told apart by their text. Columns
    other than id and text are not read. An empty table gives an empty result.
    """
    if not 0 < anchor <= long <= depth:
        raise ValueError("0 < anchor <= long <= depth is needed")
    spark = docs.sparkSession
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id_key"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("sum"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = shuffle_parts(spark)
    anchor_groups = homes = max(least, size // 3 // group_bytes + 1)
    suffix_groups = max(least, 3 * size // group_bytes + 1)
    frequent = max(100, size // 80 // FREQUENT_SHARE)

    counted = stored(
        keyed.select(*_KEYS, "text").mapInArrow(_anchor_entries(depth, anchor, anchor_groups, homes), _ENTRIES)
        .groupBy("group").applyInArrow(_subtree(frequent, homes), _FOUND), "anchors")
    often = counted.where("home < 0").orderBy(F.col("total").desc()).limit(2 * FREQUENT_SHARE).select("places")
    often = np.frombuffer(b"".join(bytes(r[0]) for r in often.collect()), dtype=np.uint64)

    def gathered(found: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The places by document, and the documents with a mark on those that may have some."""
        places = stored(found.where("home >= 0").groupBy("home").applyInArrow(
            _gather, "id_key long, sum long, places binary"), name)
        return places, with_filter(keyed, bit_filter(places, "id_key"), "id_key", "asked")

    candidates, marked = gathered(counted, "candidates")
    repeated = stored(
        marked.where("asked").join(candidates, _KEYS).select(*_KEYS, "text", "places")
        .mapInArrow(_suffix_entries(depth, anchor, long, suffix_groups, often, homes), _ENTRIES)
        .groupBy("group").applyInArrow(_subtree(0, homes), _FOUND), "repeats")
    places, marked = gathered(repeated, "places")
    # Most documents without a finding need not meet the findings.
    asked = marked.where("asked").join(places, _KEYS, "left").select("doc_id", "text", "places")
    others = marked.where("NOT asked").select("doc_id", "text", F.lit(None).cast("binary").alias("places"))
    return asked.unionByName(others).mapInArrow(
        _removal(depth, ["doc_id"]), "doc_id long, n_words long, n_removed long, text string")
