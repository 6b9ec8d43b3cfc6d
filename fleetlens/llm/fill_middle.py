"""Fill-in-the-middle forms of documents by piece tables.

A piece table is a list of descriptors (buffer, start, end) over buffers that never change: the text, and one buffer
with the three sentinels. Cutting a document splits descriptors, an arrangement permutes them, and the inverse
permutation restores the text. Digests are fed descriptor by descriptor, so no arranged text has to exist for them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
# A cut document has six pieces: prefix, middle, suffix, and the sentinels of prefix, suffix and middle.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
SEED, FORM_PERCENT, SPM_PERCENT = 42, 50, 80
_SENTINEL = re.compile(b"|".join((PREFIX, SUFFIX, MIDDLE)))

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class PieceTable:
    """A sequence of bytes as descriptors (buffer, start, end); operations return new tables over the same buffers."""

    __slots__ = ("buffers", "pieces")

    def __init__(self, buffers: Sequence[memoryview], pieces: Sequence[tuple[int, int, int]]):
        self.buffers, self.pieces = tuple(buffers), tuple(pieces)

    @classmethod
    def over(cls, text) -> PieceTable:
        """One descriptor over a whole buffer."""
        view = memoryview(text)
        return cls([view], [(0, 0, len(view))])

    def split(self, offsets: Sequence[int]) -> PieceTable:
        """Descriptors cut at rising offsets of the sequence. Every offset makes a cut, so a piece may be empty."""
        pieces, passed, waiting = [], 0, list(offsets)
        for buffer, start, end in self.pieces:
            length = end - start
            while waiting and waiting[0] <= passed + length:
                cut = start + waiting.pop(0) - passed
                pieces.append((buffer, start, cut))
                passed, length, start = passed + cut - start, end - cut, cut
            pieces.append((buffer, start, end))
            passed += length
        return PieceTable(self.buffers, pieces)

    def with_buffer(self, buffer, pieces: Sequence[tuple[int, int]]) -> PieceTable:
        """The table with one more buffer, and spans of it as further pieces at the end."""
        number = len(self.buffers)
        return PieceTable([*self.buffers, memoryview(buffer)], [*self.pieces, *((number, lo, hi) for lo, hi in pieces)])

    def arranged(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def restored(self, order: Sequence[int]) -> PieceTable:
        """What ``arranged(order)`` was made from."""
        inverse = [0] * len(order)
        for place, piece in enumerate(order):
            inverse[piece] = place
        return self.arranged(inverse)

    def taken(self, count: int) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[:count])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def digest(self) -> str:
        found = hashlib.sha256()
        for view in self.stream():
            found.update(view)
        return found.hexdigest()

    def read(self) -> bytes:
        return b"".join(self.stream())


def cut_document(text, first: int, second: int, form: str) -> PieceTable:
    """The text cut at two byte offsets and arranged with its sentinels."""
    sentinels = [(k, k + 3) for k in (0, 3, 6)]
    return PieceTable.over(text).split([first, second]).with_buffer(SENTINELS, sentinels).arranged(ARRANGEMENTS[form])


def uncut(output, form: str) -> PieceTable:
    """The text behind an output of the given form. Sentinels are found in the order of the form.

    The text itself holds none, and no sentinel can arise across a border, so the first one found is the right one.
    """
    if form == "plain":
        return PieceTable.over(output)
    offsets, at = [], 0
    for piece in ARRANGEMENTS[form]:
        if piece >= 3:
            sentinel = SENTINELS[3 * (piece - 3):3 * (piece - 2)]
            at = output.index(sentinel, at)
            offsets += [at, at + 3]
            at += 3
    # The first sentinel begins the output, so the cut at 0 would only give an empty piece.
    return PieceTable.over(output).split(offsets[1:]).restored(ARRANGEMENTS[form]).taken(3)


def choices(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """The first four groups of eight hexadecimal digits of sha256 of ``seed:doc_id``; a null id has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def form_of(h3: int, h4: int, percent: int = FORM_PERCENT, spm_percent: int = SPM_PERCENT) -> str:
    if h3 % 100 >= percent:
        return "plain"
    return "spm" if h4 % 100 < spm_percent else "psm"


def _unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words end in the data, the first of these ends of each text, and whether a text ends in white space."""
    space = _IS_SPACE[data]
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    filled = np.diff(offsets) > 0
    last = offsets[1:][filled] - 1
    after[last] = True
    trailing = np.zeros(len(offsets) - 1, dtype=bool)
    trailing[filled] = space[last]
    ends = np.flatnonzero(~space & after) + 1
    return ends, np.searchsorted(ends, offsets, side="right"), trailing


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


_COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   percent: int = FORM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256), one row per row of ``docs``.

    A unit is a word with the white space before it; white space at the end is a unit of its own. Two units of a
    document, drawn from a digest of the seed and the id, end its prefix and its middle; rows that share an id draw
    the same numbers, and a null id draws those of an empty one. A document stays ``plain`` if it is drawn so, is
    empty (null counts as empty) or contains a sentinel; lengths are null then. Rows are independent of each other, so
    repeated rows and ties need no rule. Other columns are not read. An empty table gives an empty result.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(stream):
            texts = pc.fill_null(part.column("text").cast(pa.binary()), b"")
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            held = texts.buffers()[2]
            data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
            offsets = offsets - offsets[0]
            view = memoryview(data)
            ends, first_end, trailing = _unit_ends(data, offsets)
            rows = []
            for k, number in enumerate(part.column("id").to_pylist()):
                lo, hi = int(offsets[k]), int(offsets[k + 1])
                own = ends[first_end[k]:first_end[k + 1]]
                n = len(own) + int(trailing[k])
                h1, h2, h3, h4 = choices(number, seed)
                form = form_of(h3, h4, percent, spm_percent)
                text = view[lo:hi]
                if form != "plain" and (n == 0 or _SENTINEL.search(text)):
                    form = "plain"
                if form == "plain":
                    table, lengths = PieceTable.over(text), (None, None)
                else:
                    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                    first, second = (
                        0 if u == 0 else int(own[u - 1]) - lo if u <= len(own) else hi - lo for u in cuts)
                    table = cut_document(text, first, second, form)
                    lengths = (_chars(data[lo:lo + first]), _chars(data[lo + first:lo + second]))
                rows.append((n, form, *lengths, table.read(), table.digest()))
            columns = list(zip(*rows))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            arrays = [pa.array(values, kind) for values, kind in zip(columns, types)]
            arrays[4] = arrays[4].view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *arrays],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id long, {_COLUMNS}")


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form", keep_text: bool = True) -> DataFrame:
    """``rows`` with ``restored`` (only with ``keep_text``) and ``restored_sha256``, rebuilt from output and form alone.

    The output column goes; other columns stay, and one named like a new column is an error. A null output counts as
    an empty text, a null form as plain.
    """
    kept = [c for c in rows.columns if c != output_col]
    made = ["restored", "restored_sha256"] if keep_text else ["restored_sha256"]
    clashing = sorted({c.lower() for c in kept} & set(made))
    if clashing:
        raise ValueError(f"columns are there already: {', '.join(clashing)}")
    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{output_col}`").alias("_output"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept], *[F.lit("").alias(c) for c in made]).schema

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(stream, "_output"):
            outputs = part.column("_output").cast(pa.binary()).to_pylist()
            tables = [uncut(o or b"", f or "plain") for o, f in zip(outputs, part.column(form_col).to_pylist())]
            new = [pa.array([t.digest() for t in tables], pa.string())]
            if keep_text:
                new.insert(0, pa.array([t.read() for t in tables], pa.binary()).view(pa.string()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], names=[*kept, *made])

    return source.mapInArrow(run, schema)
