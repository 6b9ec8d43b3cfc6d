"""Personal data in texts: patterns with checks, and a conditional random field for what the patterns do not reach.

The patterns find well-formed e-mail addresses, IP numbers, card and phone numbers. The field is fitted on windows
around such finds, as they are and rewritten the way people disguise them (``name [at] host [dot] org``, other
separators, a missing country code), and on windows around other digits, where there is nothing. It reads word shapes,
is decoded around every word with a digit or a mark of this kind, and adds spans that no pattern has; a span is added
only if what it spells out is a plausible value of its kind.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import random
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm import crf
from fleetlens.llm.text import slices, stored

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: k for k, kind in enumerate(KINDS)}
NONE = "none"
# Labelled windows a kind is learned from, and those without any; characters of context on either side of a word.
WINDOWS = 200
OTHER_WINDOWS = 600
CONTEXT = 60

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LINE = re.compile(r"[^\x0A-\x0D]+")
_SIGNAL = re.compile(r"(?:[0-9@]|[\[({<\s](?:[dD][oO]|[aA])[tT](?=[\])}>\s]))[^\x20\x09-\x0D]*")


# --- patterns -------------------------------------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ back over the local part and on over the domain, so a long run without @ costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Numbers joined by dots, taken four at a time from the left."""
    for match in _DOTTED.finditer(text):
        parts = match[0].split(".")
        start = match.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            length = sum(map(len, four)) + 3
            if all(map(_small, four)):
                yield start, start + length
            start += length + 1


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _DIGITS.finditer(text):
        if match.end() - match.start() < 12:
            continue
        digits = _NOT_DIGIT.sub("", match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
            yield match.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the patterns' finds in code points, by start, then kind."""
    found = [(kind, lo, hi) for kind, finder in _FINDERS.items() for lo, hi in finder(text)]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


# --- windows and labels ---------------------------------------------------------------------------


def islands(text: str) -> list[tuple[int, int]]:
    """Parts of lines that reach CONTEXT characters around the words with a digit, an @ or a spelled-out dot."""
    found: list[list[int]] = []
    for match in _SIGNAL.finditer(text):
        lo, hi = max(0, match.start() - CONTEXT), match.end() + CONTEXT
        if found and lo <= found[-1][1]:
            found[-1][1] = hi
        else:
            found.append([lo, hi])
    return [line.span() for lo, hi in found for line in _LINE.finditer(text, lo, min(hi, len(text)))]


def readable_lines(text: str) -> list[tuple[int, int]]:
    """Lines with a digit, an @ or a spelled-out at or dot, whole; a line without any cannot hold a plausible span."""
    found, done = [], 0
    while match := _SIGNAL.search(text, done):
        lo = max(map(text.rfind, "\x0A\x0B\x0C\x0D", [done] * 4, [match.start()] * 4), default=-1) + 1
        line = _LINE.match(text, max(lo, done))
        done = max(line.end() if line else 0, match.start() + 1)
        if line:
            found.append(line.span())
    return found


def tagged_words(text: str, spans: list[Span]) -> tuple[list[str], list[str]]:
    """Words of a text and their tags. A word belongs to the first span it overlaps."""
    words, tags, last = [], [], None
    for match in _WORD.finditer(text):
        span = next((s for s in spans if s[1] < match.end() and match.start() < s[2]), None)
        words.append(match[0])
        tags.append("O" if span is None else f"{'I' if span is last else 'B'}-{span[0]}")
        last = span
    return words, tags


def labelled_windows(docs: DataFrame, text_col: str = "text", most: int = WINDOWS, most_other: int = OTHER_WINDOWS) -> DataFrame:
    """(kind, rank, text, spans): windows around the patterns' finds, and around signals where they find nothing.

    At most ``most`` distinct windows of each kind and ``most_other`` of the kind ``none``, those of smallest hash among
    all of the corpus. This bound is on the labelled rows that the field is fitted on.
    """

    def limit(kind: str) -> int:
        return most_other if kind == NONE else most

    def windows(text: str):
        spans = base_spans(text)
        for kind, lo, hi in spans:
            line_lo = max(text.rfind("\n", max(0, lo - CONTEXT), lo) + 1, lo - CONTEXT, 0)
            line_hi = text.find("\n", hi, hi + CONTEXT)
            yield kind, line_lo, line_hi if line_hi >= 0 else min(len(text), hi + CONTEXT)
        done = 0
        for lo, hi in islands(text):
            while done < len(spans) and spans[done][2] <= lo:
                done += 1
            if done == len(spans) or spans[done][1] >= hi:
                yield NONE, lo, min(hi, lo + 4 * CONTEXT)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, list[tuple[int, str]]] = {}
        known: dict[str, set[tuple[int, str]]] = {}
        for part in slices(stream):
            for text in part.column("text").to_pylist():
                for kind, lo, hi in windows(text or ""):
                    window = text[lo:hi]
                    row = (-(xxhash.xxh3_64_intdigest(window) >> 1), window)
                    held, seen = least.setdefault(kind, []), known.setdefault(kind, set())
                    if row in seen or (len(held) >= limit(kind) and row <= held[0]):
                        continue
                    seen.add(row)
                    if len(held) < limit(kind):
                        heapq.heappush(held, row)
                    else:
                        seen.discard(heapq.heappushpop(held, row))
        rows = [(kind, -rank, window) for kind, held in least.items() for rank, window in held]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], names=["kind", "rank", "text"])

    found = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(run, "kind string, rank long, text string"), "windows")
    bound = F.when(F.col("kind") == NONE, most_other).otherwise(most)
    # First within 64 parts of a kind, then among what is left of all: no part holds more than the tasks' own least.
    for keys in (["kind", F.pmod("rank", F.lit(64))], ["kind"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "text"))
        found = found.distinct().withColumn("_place", place).where(F.col("_place") <= bound).drop("_place")
    return found


# --- disguises ------------------------------------------------------------------------------------


def disguised(kind: str, value: str, draw: random.Random) -> str:
    """The value as somebody may write it to hide it from patterns."""
    if kind == "email":
        pick = draw.choice(["[{}]", "({})", " [{}] ", " ({}) ", " {} "])
        local, domain = value.split("@", 1)
        return local + pick.format("at") + domain.replace(".", pick.format("dot"))
    if kind == "ip":
        return value.replace(".", draw.choice(["[.]", "(.)", "[dot]", " . ", "(dot)"]))
    digits = _NOT_DIGIT.sub("", value)
    if kind == "card":
        return draw.choice([".", "/", "_", " - ", "  "]).join(digits[k:k + 4] for k in range(0, len(digits), 4))
    area, head, tail = digits[-10:-7], digits[-7:-4], digits[-4:]
    country = digits[:-10]
    return draw.choice([
        f"({area}) {head}-{tail}", f"00{country or 1} {area} {head} {tail}", f"({area}) {head} {tail}",
        f"{area}-{head}-{tail}", f"{area}.{head}.{tail}"])


def training_rows(windows: list[tuple[str, int, str]], disguises: int = 2) -> list[tuple[list[str], list[str]]]:
    """(words, tags) of the windows and of their disguised forms, the same for the same windows."""
    rows = []
    for kind, rank, text in windows:
        spans = base_spans(text)
        rows.append(tagged_words(text, spans))
        for turn in range(disguises if kind != NONE else 0):
            draw = random.Random(f"{rank}:{turn}")
            pieces, placed, at = [], [], 0
            for name, lo, hi in spans:
                if lo < at:
                    continue
                pieces.append(text[at:lo])
                start = sum(map(len, pieces))
                pieces.append(disguised(name, text[lo:hi], draw))
                placed.append((name, start, start + len(pieces[-1])))
                at = hi
            rows.append(tagged_words("".join(pieces) + text[at:], placed))
    return rows


def fit(docs: DataFrame, text_col: str = "text") -> crf.Crf:
    """The field fitted on the labelled windows of ``docs``; their number is bounded, so they go to the driver."""
    windows = sorted((r["kind"], r["rank"], r["text"]) for r in labelled_windows(docs, text_col).collect())
    return crf.fit(training_rows(windows), KINDS)


# --- spans ----------------------------------------------------------------------------------------

_SPELLED_AT = re.compile(r"\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+|@", re.I)
_SPELLED_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EDGE = re.compile(r"[\w+(\[]")


def plausible(kind: str, value: str) -> bool:
    """Whether a span that the field found spells out a value of its kind."""
    if kind == "email":
        return _ADDRESS.fullmatch(_SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", value, count=1))) is not None
    if kind == "ip":
        parts = _SPELLED_DOT.sub(".", value).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    if any(c.isalpha() for c in value):
        return False
    digits = _NOT_DIGIT.sub("", value)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _trimmed(text: str, lo: int, hi: int) -> tuple[int, int]:
    """Without punctuation at the ends; opening brackets and plus signs stay in front."""
    while lo < hi and not _EDGE.match(text[lo]):
        lo += 1
    while lo < hi and not (text[hi - 1].isalnum()):
        hi -= 1
    return lo, hi


def _added(text: str, words: list[tuple[int, int]], tags, names, base: list[Span]) -> list[Span]:
    """Plausible spans of one decoded sequence that no pattern's span overlaps."""
    found, k = [], 0
    while k < len(words):
        name = names[tags[k]]
        if name[0] != "B":
            k += 1
            continue
        end = k + 1
        while end < len(words) and names[tags[end]] == f"I-{name[2:]}":
            end += 1
        lo, hi = _trimmed(text, words[k][0], words[end - 1][1])
        if lo < hi and plausible(name[2:], text[lo:hi]) and not any(s[1] < hi and lo < s[2] for s in base):
            found.append((name[2:], lo, hi))
        k = end
    return found


def _overlapping(by_kind: list[list[Span]], lo: int, hi: int) -> list[Span]:
    """Spans that overlap lo..hi; the spans of one kind are in order and do not overlap each other."""
    found = []
    for spans in by_kind:
        first = bisect.bisect_right(spans, lo, key=lambda s: s[2])
        found += spans[first:bisect.bisect_left(spans, hi, key=lambda s: s[1])]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for kind, lo, hi in spans)


_COLUMNS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_personal_data(docs: DataFrame, model: crf.Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row per row of ``docs``.

    Counts and ``base_sha256`` are those of the patterns' spans, ``spans`` has these and the ones the field adds, as
    kind:start:end in code points, by start, then kind. Null counts as an empty text, which has no spans. Rows are
    independent of each other, so repeated rows, ties and null ids need no rule. Other columns are not read. An empty
    table gives an empty result.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for part in slices(stream):
            texts = [t or "" for t in part.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            owners, places = [], []
            for k, text in enumerate(texts):
                for lo, hi in readable_lines(text):
                    owners.append(k)
                    places.append([m.span() for m in _WORD.finditer(text, lo, hi)])
            decoded = model.decode([[texts[k][a:b] for a, b in words] for k, words in zip(owners, places)], table)
            added: list[list[Span]] = [[] for _ in texts]
            by_kind = [[[s for s in spans if s[0] == kind] for kind in KINDS] for spans in base]
            for k, words, tags in zip(owners, places, decoded):
                if tags.any():
                    near = _overlapping(by_kind[k], words[0][0], words[-1][1])
                    added[k] += _added(texts[k], words, tags, model.tags, near)
            rows = []
            for spans, more in zip(base, added):
                counts = [sum(s[0] == kind for s in spans) for kind in KINDS]
                everything = sorted(spans + more, key=lambda s: (s[1], ORDER[s[0]]))
                rows.append((*counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(everything), len(more)))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"doc_id long, {_COLUMNS}")
