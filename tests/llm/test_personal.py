"""Personal data: patterns against plain regular expressions, the field against enumeration and on held-out rows."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import crf, personal
from tests.llm.conftest import sentence

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, value):
    digits = "".join(c for c in value if c in "0123456789")
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    # Without an @ the expression for addresses finds nothing, but takes time with the square of a long word.
    kinds = {k: p for k, p in PLAIN.items() if k != "email" or "@" in text}
    found = [(kind, *m.span()) for kind, p in kinds.items() for m in re.finditer(p, text) if valid(kind, m[0])]
    return sorted(found, key=lambda s: (s[1], list(PLAIN).index(s[0])))


PIECES = ["4", "1", "255", "256", "00", ".", ".", "-", " ", "@", "a", "Z_", "é", "+", "(", ")", "4539 1488 0343 6467", "mail", "\n", "%"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25))
def test_patterns_equal_plain_expressions(pieces):
    assert personal.base_spans("".join(pieces)) == plain_spans("".join(pieces))


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "1.1.1.999." * 40_000, "@" * 300_000, "a@" * 150_000,
                                  "+1" + " (" * 200_000, "a@b" * 100_000, "7 " * 200_000, "[dot " * 60_000])
def test_long_texts_take_time_in_proportion(text):
    started = time.monotonic()
    personal.base_spans(text)
    for lo, hi in personal.islands(text):
        assert hi > lo
    assert time.monotonic() - started < 5


def number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def card(rng):
    digits = "4" + number(rng, 14)
    return next(digits + d for d in "0123456789" if personal.luhn(digits + d))


def value(kind, rng):
    if kind == "email":
        return f"{rng.choice(['anna', 'jo.lee', 'kim'])}{number(rng, 2)}@mail{number(rng, 1)}.example.{rng.choice(['com', 'org'])}"
    if kind == "ip":
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == "card":
        c = card(rng)
        return rng.choice([c, " ".join(c[k:k + 4] for k in (0, 4, 8, 12))])
    return f"+{rng.randint(1, 99)} ({number(rng, 3)}) {number(rng, 3)}-{number(rng, 4)}"


def corpus(n, seed):
    rng, rows = random.Random(seed), []
    for k in range(n):
        words = [w.rstrip("0123456789") if rng.random() < 0.7 else w for w in sentence(seed * 1000 + k, 60).split()]
        for kind in personal.KINDS:
            if rng.random() < 0.5:
                words.insert(rng.randrange(len(words)), value(kind, rng))
        words.insert(rng.randrange(len(words)), rng.choice(["2024-05-17", "12:30", "v1.2.3", "id=99182", "3.14", "1,200", number(rng, 6)]))
        rows.append((k, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return personal.fit(spark.createDataFrame(corpus(400, 1), "doc_id long, text string").repartition(3))


def spans_of(row):
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row.spans.split(",") if s)]


def test_base_spans_stay(spark, docs, rows, model):
    planted = spark.createDataFrame([(1000 + k, t, None, None, None) for k, t in corpus(60, 2)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    both = docs.unionByName(planted, allowMissingColumns=True)
    texts = Counter((i, t or "") for i, t, *_ in rows) + Counter((1000 + k, t) for k, t in corpus(60, 2))
    found = Counter()
    by_text = {}
    for row in personal.find_personal_data(both, model).collect():
        by_text.setdefault(row.doc_id, []).append(row)
    for (doc_id, text), times in texts.items():
        base = plain_spans(text)
        digest = hashlib.sha256(personal.joined(base).encode()).hexdigest()
        counts = tuple(sum(s[0] == kind for s in base) for kind in personal.KINDS)
        same = [r for r in by_text[doc_id] if r.base_sha256 == digest and (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts]
        assert len(same) >= times
        for row in same:
            spans = spans_of(row)
            assert set(base) <= set(spans) and len(spans) == len(base) + row.n_added
            assert spans == sorted(spans, key=lambda s: (s[1], personal.ORDER[s[0]]))
            # What the field adds here are values that run into a number beside them, which the patterns take along.
            assert all(valid(s[0], text[s[1]:s[2]]) for s in spans if s not in base) and row.n_added <= 1
        found[doc_id] += times
    assert sum(found.values()) == sum(len(v) for v in by_text.values())


def test_disguised_values_are_found(spark, model):
    """On held-out texts the field finds most disguised values, at their place, and hardly anything else."""
    rng, rows, wanted = random.Random(9), [], set()
    for k, (_, text) in enumerate(corpus(200, 3)):
        kind = personal.KINDS[k % 4]
        hidden = personal.disguised(kind, value(kind, rng), rng)
        before = " ".join(w for w in text.split()[:20] if not any(c.isdigit() for c in w)) + " "
        rows.append((k, before + hidden + " and then more of the words 17 here"))
        if not plain_spans(hidden):
            wanted.add((k, kind, len(before), len(before) + len(hidden)))
    found = set()
    for row in personal.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        base = set(plain_spans(rows[row.doc_id][1]))
        found |= {(row.doc_id, *s) for s in spans_of(row) if s not in base}
    assert len(wanted) > 150
    assert len(found & wanted) >= 0.8 * len(wanted)
    assert len(found - wanted) <= 0.1 * len(wanted)


def test_clean_texts_stay_clean(spark, model):
    texts = [f"at 12:30 on 2024-05-17 we met {k} people, version 1.2.{k}, 3.14 and {k},200 or so" for k in range(100)]
    rows = personal.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.spans for r in rows] == [""] * 100


def test_no_documents_and_nothing_to_learn(spark, no_docs):
    model = personal.fit(no_docs)
    assert personal.find_personal_data(no_docs, model).collect() == []
    frame = spark.createDataFrame([(None, None), (1, "mail a@b.cd or a [at] b [dot] cd")], "doc_id long, text string")
    rows = {r.doc_id: r for r in personal.find_personal_data(frame, model).collect()}
    assert rows[1].spans == "email:5:11" and rows[None].spans == "" and rows[None].n_email == 0


def test_the_labelled_table_is_bounded_and_the_same_however_it_is_dealt(spark):
    frame = spark.createDataFrame(corpus(300, 5), "doc_id long, text string")
    take = lambda parts: sorted(map(tuple, personal.labelled_windows(frame.repartition(parts), most=20, most_other=30).collect()))
    rows = take(2)
    assert rows == take(7)
    counts = Counter(r[0] for r in rows)
    assert [counts[k] for k in personal.KINDS] == [20] * 4 and 0 < counts["none"] <= 30


# --- the field ------------------------------------------------------------------------------------


def small_field(seed):
    rng = np.random.default_rng(seed)
    tags = crf.tags_of(["x", "y"])
    follows, first = crf.allowed(tags)
    weights = rng.normal(size=(2 * crf.REACH + 1, crf.FEATURES, len(tags))).astype(np.float32)
    return crf.Crf(tags, weights, np.where(follows, rng.normal(size=follows.shape), -1e4).astype(np.float32),
                   np.where(first, rng.normal(size=len(tags)), -1e4).astype(np.float32))


def path_score(field, words, path):
    padded = [""] * crf.REACH + list(words) + [""] * crf.REACH
    total = float(field.start[path[0]])
    for k in range(len(words)):
        for offset in range(2 * crf.REACH + 1):
            total += float(field.weights[offset, crf.word_features(padded[k + offset]), path[k]].sum())
        if k:
            total += float(field.transitions[path[k - 1], path[k]])
    return total


def test_viterbi_finds_the_best_path():
    field = small_field(4)
    sequences = [["a", "+1", "555-12"], [], ["x@y.z"], ["12", "(at)", "b", "c3"], ["one", "two"]]
    for words, path in zip(sequences, field.decode(sequences, field.table())):
        if words:
            best = max(itertools.product(range(len(field.tags)), repeat=len(words)), key=lambda p: path_score(field, words, p))
            assert tuple(path) == best


def test_expected_tags_by_enumeration():
    rng = np.random.default_rng(1)
    tags = crf.tags_of(["x"])
    follows, first = crf.allowed(tags)
    scores, lengths = rng.normal(size=(10, 3)), np.array([4, 2])
    starts = np.array([1, 7])
    follow, opening = np.where(follows, np.exp(rng.normal(size=(3, 3))), 0), np.where(first, np.exp(rng.normal(size=3)), 0)
    marginal, pairs, begun = crf._expected(scores, follow, opening, starts, lengths)
    all_pairs = np.zeros((3, 3))
    for lo, n in zip(starts, lengths):
        total, mine, links = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = opening[path[0]] * np.exp(sum(scores[lo + k, t] for k, t in enumerate(path)))
            weight *= np.prod([follow[a, b] for a, b in itertools.pairwise(path)])
            total += weight
            mine[np.arange(n), path] += weight
            for a, b in itertools.pairwise(path):
                links[a, b] += weight
        assert np.allclose(marginal[lo:lo + n], mine / total)
        all_pairs += links / total
    assert np.allclose(pairs, all_pairs) and np.allclose(begun, marginal[starts].sum(axis=0))


def test_every_place_of_a_plausible_span_is_read():
    """Lines without digits that spell out an address are read, and lines are read whole, however long."""
    far = "word " * 40
    text = f"nothing here\nwrite to ana [at] host.org or\n{far}ana at host.org{far}\nana(AT)host.org\x0bmore 7 {far}end\nno"
    lines = [text[lo:hi] for lo, hi in personal.readable_lines(text)]
    assert lines == [line for line in re.split("[\n\x0b]", text)[1:-1]]
    assert personal.readable_lines("") == [] and personal.readable_lines("Look at\nthis.\n") in ([], [(0, 7)])


def marks():
    class Marks:
        """In place of a field: everything from a word with mia to one with org is an address."""

        tags = crf.tags_of(personal.KINDS)

        def table(self):
            return None

        def decode(self, sequences, table):
            begun, inside = self.tags.index("B-email"), self.tags.index("I-email")
            found = []
            for words in sequences:
                tags = np.zeros(len(words), dtype=np.int64)
                lo = next((k for k, w in enumerate(words) if "mia" in w), None)
                hi = next((k for k, w in enumerate(words) if "org" in w), None)
                if lo is not None and hi is not None:
                    tags[lo:hi + 1] = inside
                    tags[lo] = begun
                found.append(tags)
            return found

    return Marks()


def test_the_field_is_asked_about_every_place(spark):
    far = "x" * 80
    docs = spark.createDataFrame([(1, "to mia.lund [at] lund.org today"), (2, f"to mia{far} at {far}.{far}.org today")], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in personal.find_personal_data(docs, marks()).collect()}
    assert found == {1: "email:3:25", 2: f"email:3:{3 + 3 + 80 + 4 + 80 + 1 + 80 + 4}"}
