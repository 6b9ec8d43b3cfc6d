"""A linear-chain conditional random field over word shapes, in numpy.

A word is seen through a few features (its shape, digits, marks, ends), and those of two words on either side. The
field is fitted on a small labelled table by gradient steps on the exact likelihood (forward and backward sums over
all sequences at once), and decoded by Viterbi for all sequences of a batch at once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from fleetlens.llm.text import WordTable

REACH = 2
SHAPES = 2048
_RUNS = re.compile(r"(?P<d>[0-9]+)|(?P<a>[^\W\d_]+)|(?P<p>.)(?P=p)*", re.S)
_AT = re.compile(r"(?:^|[\[({<])at(?:$|[\])}>])", re.I)
_DOT = re.compile(r"(?:^|[\[({<])dot(?:$|[\])}>])", re.I)
# Sizes of the features of a word: bias, shape, digits, first and last character, marks, groups of digits, length.
_SIZES = (1, SHAPES, 21, 8, 8, 64, 8, 8)
_FIRST = np.concatenate([[0], np.cumsum(_SIZES)[:-1]])
FEATURES = sum(_SIZES)


def _run(match: re.Match) -> str:
    if match["d"]:
        return f"d{min(len(match['d']), 9)}"
    return "a" if match["a"] else match["p"]


def shape(word: str) -> str:
    """Runs of digits as their length, of letters as one letter, of other characters as one of them."""
    return _RUNS.sub(_run, word)


def _kind(c: str) -> int:
    if c.isdigit():
        return 1
    if c.isalpha():
        return 2
    return 3 + "+([.".find(c) if c in "+([." else 7


def word_features(word: str) -> list[int]:
    """The numbers of a word's features; the empty word stands for what is beyond the ends of a sequence."""
    digits = sum(map(str.isdigit, word))
    marks = ("@" in word, _AT.search(word), _DOT.search(word), "." in word, "-" in word, "(" in word or ")" in word)
    values = (
        0, zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % SHAPES, min(digits, 20),
        _kind(word[0]) if word else 0, _kind(word[-1]) if word else 0,
        sum(bool(m) << k for k, m in enumerate(marks)), min(len(re.findall(r"[0-9]+", word)), 7),
        min(len(word).bit_length(), 7))
    return [int(first) + value for first, value in zip(_FIRST, values)]


@dataclass(frozen=True)
class Crf:
    """Weights per offset, feature and tag; scores of tag after tag and of first tags. Tag 0 is no entity."""

    tags: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def table(self, cap: int = 50_000) -> WordTable:
        """A row per distinct word: its share in the scores of the words around it, one block per offset."""
        width = self.weights.shape[0] * len(self.tags)

        def rows(words: list[str]) -> np.ndarray:
            numbers = np.array([word_features(w) for w in words])
            return self.weights[:, numbers].sum(axis=2).transpose(1, 0, 2).reshape(len(words), width)

        return WordTable(rows, width, np.float32, cap)

    def decode(self, sequences: Sequence[Sequence[str]], table: WordTable) -> list[np.ndarray]:
        """The best tag numbers of every sequence; of equally good ones the path of lower tag numbers at its end."""
        found = [np.zeros(len(s), dtype=np.int64) for s in sequences]
        order = sorted((k for k, s in enumerate(sequences) if len(s)), key=lambda k: -len(sequences[k]))
        if not order:
            return found
        words, starts, lengths = _padded([sequences[k] for k in order])
        scores = _scores(table.lookup(words).reshape(len(words), -1, len(self.tags)))
        back = np.zeros((len(words), len(self.tags)), dtype=np.int8)
        best = scores[starts] + self.start
        for step in range(1, int(lengths[0])):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            at = starts[:active] + step
            paths = best[:active, :, None] + self.transitions
            back[at] = paths.argmax(axis=1)
            best[:active] = paths.max(axis=1) + scores[at]
        tag = best.argmax(axis=1)
        flat = np.zeros(len(words), dtype=np.int64)
        for step in range(int(lengths[0]) - 1, -1, -1):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            at = starts[:active] + step
            flat[at] = tag[:active]
            tag[:active] = back[at, tag[:active]]
        for k, lo, n in zip(order, starts.tolist(), lengths.tolist()):
            found[k] = flat[lo:lo + n]
        return found


def _padded(sequences: Sequence[Sequence[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words with empty ones between the sequences, where each sequence begins, and its length."""
    words, starts = [""] * REACH, []
    for sequence in sequences:
        starts.append(len(words))
        words.extend(sequence)
        words.extend([""] * REACH)
    return words, np.array(starts), np.array([len(s) for s in sequences])


def _scores(shares: np.ndarray) -> np.ndarray:
    """Scores of the tags at every place, from the shares of the words around it."""
    total = shares[:, REACH].copy()
    for offset in range(-REACH, REACH + 1):
        if offset:
            lo, hi = max(0, -offset), len(shares) - max(0, offset)
            total[lo:hi] += shares[lo + offset:hi + offset, offset + REACH]
    return total


def tags_of(kinds: Sequence[str]) -> tuple[str, ...]:
    return ("O", *(f"{mark}-{kind}" for kind in kinds for mark in "BI"))


def allowed(tags: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which tag may follow which, and which may come first: an inside tag only after one of its own kind."""
    follows = np.array([[b[0] != "I" or (a[0] != "O" and a[2:] == b[2:]) for b in tags] for a in tags])
    return follows, np.array([t[0] != "I" for t in tags])


def fit(labelled: Sequence[tuple[Sequence[str], Sequence[str]]], kinds: Sequence[str], rounds: int = 100,
        rate: float = 0.1, decay: float = 1e-3) -> Crf:
    """A field fitted to (words, tags) rows. Rows without words say nothing; without rows no tag but O is ever found.

    Adam on the whole table, so the same rows in the same order give the same field.
    """
    tags = tags_of(kinds)
    follows, first = allowed(tags)
    weights = np.zeros((2 * REACH + 1, FEATURES, len(tags)))
    transitions, start = np.zeros(follows.shape), np.zeros(len(tags))
    rows = sorted((r for r in labelled if len(r[0])), key=lambda r: -len(r[0]))
    forbidden = np.where(follows, 0.0, -1e4), np.where(first, 0.0, -1e4)
    if not rows:
        weights[REACH, 0, 0] = 1.0
        return Crf(tags, weights.astype(np.float32), forbidden[0].astype(np.float32), forbidden[1].astype(np.float32))
    words, starts, lengths = _padded([r[0] for r in rows])
    # Words with equal features are one type, so a round works on types and not on words.
    types, of_word = np.unique(np.array([word_features(w) for w in words]), axis=0, return_inverse=True)
    of_word = of_word.ravel()
    number = {t: k for k, t in enumerate(tags)}
    truth = np.zeros((len(words), len(tags)))
    counts, begun = np.zeros_like(transitions), np.zeros_like(start)
    for lo, (_, names) in zip(starts, rows):
        path = [number[n] for n in names]
        truth[np.arange(lo, lo + len(path)), path] = 1.0
        begun[path[0]] += 1
        np.add.at(counts, (path[:-1], path[1:]), 1)
    parameters = [weights, transitions, start]
    momenta = [[np.zeros_like(p), np.zeros_like(p)] for p in parameters]
    for turn in range(1, rounds + 1):
        shares = weights[:, types].sum(axis=2).transpose(1, 0, 2)
        marginal, pairs, opening = _expected(
            _scores(shares[of_word]), np.where(follows, np.exp(transitions), 0.0), np.where(first, np.exp(start), 0.0), starts, lengths)
        error = (marginal - truth) / len(rows)
        by_type = np.zeros_like(shares)
        for offset in range(-REACH, REACH + 1):
            lo, hi = max(0, -offset), len(words) - max(0, offset)
            seen = of_word[lo + offset:hi + offset]
            for tag in range(len(tags)):
                by_type[:, offset + REACH, tag] = np.bincount(seen, error[lo:hi, tag], minlength=len(types))
        slope = np.zeros_like(weights)
        for offset in range(2 * REACH + 1):
            np.add.at(slope[offset], types.ravel(), np.repeat(by_type[:, offset], types.shape[1], axis=0))
        slopes = [slope + decay * weights, (pairs - counts) / len(rows) + decay * transitions, (opening - begun) / len(rows) + decay * start]
        for parameter, gradient, (mean, square) in zip(parameters, slopes, momenta):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient ** 2 - square)
            parameter -= rate * (mean / (1 - 0.9 ** turn)) / (np.sqrt(square / (1 - 0.999 ** turn)) + 1e-8)
    return Crf(tags, weights.astype(np.float32), (transitions + forbidden[0]).astype(np.float32), (start + forbidden[1]).astype(np.float32))


def _expected(scores, follow, opening, starts, lengths):
    """Expected tags at every place, expected pairs of tags, and expected first tags, by forward and backward sums."""
    exp = np.exp(scores - scores.max(axis=1, keepdims=True))
    forward, scale = np.zeros_like(exp), np.ones(len(exp))
    longest = int(lengths[0])
    active = [int(np.searchsorted(-lengths, -step, side="left")) for step in range(longest)]
    for step in range(longest):
        at = starts[:active[step]] + step
        forward[at] = exp[at] * (opening if step == 0 else forward[at - 1] @ follow)
        scale[at] = forward[at].sum(axis=1)
        forward[at] /= scale[at][:, None]
    backward = np.zeros_like(exp)
    backward[starts + lengths - 1] = 1.0
    pairs = np.zeros_like(follow)
    for step in range(longest - 1, 0, -1):
        at = starts[:active[step]] + step
        ahead = exp[at] * backward[at] / scale[at][:, None]
        pairs += follow * (forward[at - 1].T @ ahead)
        backward[at - 1] = ahead @ follow.T
    marginal = forward * backward
    return marginal, pairs, marginal[starts].sum(axis=0)
