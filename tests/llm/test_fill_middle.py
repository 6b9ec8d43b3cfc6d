"""Fill-in-the-middle forms against a plain rebuild of the texts."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import fill_middle as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    """(n, form, prefix, middle, output) by slicing a list of units."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_forms_and_restored_texts(docs, rows):
    made = M.fill_in_middle(docs)
    found = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256) for r in made.collect())
    wanted = Counter((i, *e, hashlib.sha256(e[4].encode()).hexdigest()) for i, t, *_ in rows for e in [expected(i, t)])
    assert found == wanted
    assert len({f[2] for f in found}) == 3
    back = M.restore(made)
    assert Counter((r.doc_id, r.restored, r.restored_sha256) for r in back.collect()) == Counter(
        (i, t or "", hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)


def test_texts_with_sentinels_stay_plain(spark):
    texts = ["a <P> b", "<S>", "x<M>y z", "<P", "S> <", "é ü <p> z ", " \t", "a\n"]
    frame = spark.createDataFrame([(k, t) for k in range(30) for t in texts], "doc_id long, text string")
    made = M.fill_in_middle(frame)
    wanted = Counter((k, *expected(k, t)) for k in range(30) for t in texts)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()) == wanted
    assert Counter((r.doc_id, r.restored) for r in M.restore(made).collect()) == Counter((k, t) for k in range(30) for t in texts)


def test_empty_table_and_clashing_names(spark, no_docs):
    made = M.fill_in_middle(no_docs)
    assert M.restore(made).collect() == []
    with pytest.raises(ValueError):
        M.restore(made.withColumnRenamed("n", "restored"))
    odd = spark.createDataFrame([(1, None, None)], "form long, output string, f string")
    assert M.restore(odd, form_col="f").collect()[0].restored == ""


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40).filter(lambda b: not M._SENTINEL.search(b)), st.integers(0, 40), st.integers(0, 40), st.sampled_from(sorted(M.ARRANGEMENTS)))
def test_inverse_permutation_restores(text, a, b, form):
    first, second = sorted((min(a, len(text)), min(b, len(text))))
    table = M.cut_document(text, first, second, form)
    p, m, s = text[:first], text[first:second], text[second:]
    assert table.read() == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    assert table.digest() == hashlib.sha256(table.read()).hexdigest()
    assert table.restored(M.ARRANGEMENTS[form]).taken(3).read() == text
    assert M.uncut(table.read(), form).read() == text


def test_split_keeps_empty_pieces_and_crosses_descriptors():
    table = M.PieceTable.over(b"abcdef").split([0, 2, 2, 6])
    assert [bytes(v) for v in table.stream()] == [b"", b"ab", b"", b"cdef", b""]
    again = table.split([1, 3])
    assert again.read() == b"abcdef" and b"a" in [bytes(v) for v in again.stream()]
