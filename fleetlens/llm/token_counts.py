"""Unigram token counts by dynamic programming shared over a trie.

Under a unigram vocabulary a pre-token is cut into the pieces with the best sum of scores. The best score of a prefix
depends on the prefix alone, so the distinct pre-tokens of a batch are walked as a trie, depth first in sorted order:
going from one pre-token to the next, the forward scores up to their common prefix stay, and only what is new is worked
out. Each terminal node keeps its number of tokens; documents look theirs up and add.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import WordTable, as_bytes, joined_words, slices

SPACE_MARK = "▁"
# Scores are whole millionths of a natural logarithm, so that sums are exact and ties are ties.
UNIT = 1_000_000


def zipf_scores(path: str) -> dict[str, int]:
    """Scores of the pieces of a SentencePiece file: the log of their share if use falls with rank as Zipf's law says.

    The file's own scores are merge ranks. Control and byte pieces are left out; bytes serve unknown characters.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())
              if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    ranked = sorted(pieces, key=lambda p: -model.get_score(model.piece_to_id(p)))
    total = math.log(sum(1.0 / (k + 1) for k in range(len(ranked))))
    return {p: -round(UNIT * (math.log(k + 1) + total)) for k, p in enumerate(ranked)}


class TrieCounter:
    """Token counts of pre-tokens under the scores. A character in no piece costs one token per byte of UTF-8.

    A cut is one number, its score in the high part less its tokens in the low part, so the larger number is the
    better score and, of equal scores, the cut with fewer tokens.
    """

    _LOW = 1 << 40

    def __init__(self, scores: Mapping[str, int]):
        self._steps = {piece: score * self._LOW - 1 for piece, score in scores.items()}
        self._longest = max(map(len, scores), default=1)
        self._byte = (min(scores.values(), default=0) - 10 * UNIT) * self._LOW - 1

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each word; words may come in any order."""
        texts = [SPACE_MARK + w.decode("utf-8", "replace") for w in words]
        out = np.zeros((len(words), 1), dtype=np.int32)
        step, longest, byte = self._steps.get, self._longest, self._byte
        path, best = "", [0]  # best[d]: the best cut of the current path's first d characters
        for at in sorted(range(len(texts)), key=texts.__getitem__):
            text = texts[at]
            shared, limit = 0, min(len(path), len(text))
            while shared < limit and path[shared] == text[shared]:
                shared += 1
            del best[shared + 1:]
            for depth in range(shared + 1, len(text) + 1):
                last = text[depth - 1]
                found = best[-1] + byte * (1 if last.isascii() else len(last.encode("utf-8", "replace")))
                for start in range(depth - longest if depth > longest else 0, depth):
                    piece = step(text[start:depth])
                    if piece is not None and best[start] + piece > found:
                        found = best[start] + piece
                best.append(found)
            path = text
            out[at] = -best[-1] % self._LOW
        return out


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row; a pre-token is a word with the space mark before it.

    Null and empty texts have none. Repeated rows give equal rows; other columns are not read. The words a task knows
    are bounded, and nothing is shuffled. The file at ``vocabulary_path`` must be readable on the executors.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(TrieCounter(zipf_scores(vocabulary_path)).counts, 1, np.int32)
        for part in slices(stream):
            words, offsets = joined_words(as_bytes(part))
            sums = np.concatenate([[0], np.cumsum(table.lookup(words)[:, 0], dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
                 pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
