"""Token ids of whole texts by a public word-end BPE file, with the ids of each distinct word worked out once."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import regex

WORD_CAP = 300_000

# Letters whose lower case and normal form are letter by letter; words with anything else, or with the start of a
# special token, go through the tokenizer as a whole.
_PLAIN = regex.compile(r"[!-~¡-įĲ-ʯ]+")


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    letters, spare = [], 256
    for byte in range(256):
        if 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or byte >= 0xAE:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return "".join(letters)


_MARK = re.compile(rb"(?<=[a-z])(?=[!-&(-/:-@\[-`{-~])")


class _Numbers(dict):
    """Numbers words in the order they turn up, and lists those not yet worked out."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class WordTokenizer:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    The file's pattern never joins anything across white space, so a text's ids are those of its words in turn.
    """

    _open: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self._letters = _byte_letters()
        self._start()

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One instance per Python worker, so that tasks in turn share the words they know."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _start(self) -> None:
        self._numbers = _Numbers()
        self._ids = np.zeros(1 << 16, dtype=np.uint32)
        self._ends = np.zeros(1 << 14, dtype=np.int64)
        self._used = 0

    def word_ids(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "surrogatepass")
        if text.isascii():
            if text.isalpha():
                return self._part_ids(text.lower())
            plain = text.isprintable()
        else:
            plain = _PLAIN.fullmatch(text)
        if not plain or "<|" in text:
            return self._whole.encode(text, add_special_tokens=False).ids
        return [i for part in self._pattern.findall(text.lower()) for i in self._part_ids(part)]

    def _part_ids(self, part: str) -> list[int]:
        letters = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(self._letters)
        return [token.id for token in self._model.tokenize(letters)]

    def _learn(self, words: list[bytes]) -> None:
        found = [self.word_ids(w) for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))
        count = len(self._numbers) - len(words)
        if self._used + len(flat) > len(self._ids):
            self._ids = np.resize(self._ids, max(2 * len(self._ids), self._used + len(flat)))
        if count + len(words) + 1 > len(self._ends):
            self._ends = np.resize(self._ends, max(2 * len(self._ends), count + len(words) + 1))
        self._ids[self._used:self._used + len(flat)] = flat
        self._ends[count + 1:count + 1 + len(words)] = self._used + np.cumsum(lengths)
        self._used += len(flat)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; no ids for null."""
        if len(self._numbers) > WORD_CAP:
            self._start()
        flat, words = [], [0]
        for text in texts.cast(pa.binary()).to_pylist():
            if text:
                # ASCII capitals become small letters anyway, and no part goes on from a letter to a mark other than
                # the apostrophe. Special tokens are told apart by case and hold marks, so their texts stay as is.
                flat.extend((text if b"<|" in text else _MARK.sub(b" ", text.lower())).split())
            words.append(len(flat))
        at = np.fromiter(map(self._numbers.__getitem__, flat), np.int64, len(flat))
        if self._numbers.fresh:
            self._learn(self._numbers.fresh)
            self._numbers.fresh = []
        lengths = self._ends[at + 1] - self._ends[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self._ends[at] - (ends - lengths), lengths)
        ids = self._ids[places]
        cuts = np.concatenate([[0], ends])[words]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
