"""Fingerprints, packing, sharding, mixing, extraction, token counts and languages against brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import html, language, mixing, packing, sharding, spotsigs, token_counts
from fleetlens.llm.queries import VOCABULARY, tokenizer_path
from fleetlens.llm.text import RollingHashes, WordTable
from fleetlens.llm.tokens import WordTokenizer


def test_rolling_hashes_depend_on_the_words_alone():
    h = np.arange(100, dtype=np.uint64) % np.uint64(10)
    runs = RollingHashes(h).runs(np.arange(90), 7)
    assert (runs[:80] == runs[10:90]).all() and len(set(runs.tolist())) == 10


def test_word_table_starts_afresh_at_its_cap():
    seen = []
    table = WordTable(lambda words: (seen.extend(words), np.array([[len(w)] for w in words]))[1], 1, np.int64, cap=3)
    for batch in (["a", "bb", "a"], ["ccc", "dddd", "bb"], ["a", "eeeee"]):
        assert table.lookup(batch)[:, 0].tolist() == [len(w) for w in batch]
    assert seen.count("a") == 2


# --- SpotSigs -------------------------------------------------------------------------------------


def test_edit_report(docs, rows, spark):
    plain = [(i, t or "") for i, t, *_ in rows]
    order = sorted(plain, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    wanted = Counter()
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        wanted[(i, len(text), text[:len(text) - half] + following[:half])] += 1
    found = spotsigs.edit_report(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_text) for r in found) == wanted
    prints = {}
    for r in found:
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        assert r.near_edited == spotsigs.likeness(
            spotsigs.from_text(r.fingerprint), spotsigs.from_text(r.edited_fingerprint))
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert prints[(1, plain[0][1].__len__())] == prints[(2, plain[1][1].__len__())]


def test_signatures_by_hand():
    signer = spotsigs.Signer(anchors=("the", "of"), chain=2)
    same, other, longer = signer.fingerprints([b"The red fox.", b"the, RED of fox", b"the red fox of the deep sea"])
    assert len(same) == 1 and same.tolist() == other[:1].tolist() and set(same) < set(longer) and len(longer) == 3
    assert [len(x) for x in signer.fingerprints([None, b"", b"plain words", b"the"])] == [0, 0, 1, 1]


def test_near_duplicates(docs):
    found = spotsigs.near_duplicates(docs, 0.5)
    got = {(r.a, r.b): r.likeness for r in found.collect()}
    by_print = {}
    for r in spotsigs.fingerprint(docs).collect():
        if r.n_signatures:
            ids = by_print.setdefault(r.fingerprint, [])
            ids.append(r.doc_id)
    reps = sorted((min((i for i in ids if i is not None), default=None), p) for p, ids in by_print.items()
                  if any(i is not None for i in ids))
    wanted = {}
    for x, (a, p) in enumerate(reps):
        for b, q in reps[x + 1:]:
            value = spotsigs.likeness(spotsigs.from_text(p), spotsigs.from_text(q))
            if value >= 0.5 and a != b:
                wanted[(a, b)] = value
    assert {k: v for k, v in got.items() if None not in k} == pytest.approx(wanted)


# --- packing --------------------------------------------------------------------------------------


def test_word_tokenizer_equals_the_tokenizer(rows):
    tokenizer = WordTokenizer(tokenizer_path())
    odd = ["<|endoftext|> a<|startoftext|>B<|ENDOFTEXT|>", "İstanbul ΣΑΣ ς", "日本語 テスト é ́x", "a\x1cb\x85c\xa0d e",
           "it's I'LL don't 'S 123 ½ ² x_y--z", "", "﻿abc ­ ŉ ǅ ß ẞ", None, "\x00\x01 a\x7f", "K Å ﬁ \U0001F600‍ x",
           "a.'s b*'s c''s", "été*** ça&&& naïve.'"]
    texts = odd + [t for _, t, *_ in rows if t is None or len(t) < 5000]
    for _ in range(2):  # the second time from the words it knows
        for text, ids in zip(texts, tokenizer.encode(pa.array(texts, pa.string()))):
            assert ids.tolist() == tokenizer._whole.encode(text or "", add_special_tokens=False).ids, text


def check_packing(found, capacity=4096):
    by_sequence, by_document = {}, {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity and end & (end - 1) == 0  # no sequence needs padding
    return by_document


def test_pack(docs, rows, monkeypatch):
    monkeypatch.setattr(packing, "COUNTING_ROWS", 40)
    found = packing.pack(docs.where("doc_id <> 9 AND doc_id <> 10"), tokenizer_path()).collect()
    whole = WordTokenizer.of(tokenizer_path())._whole
    texts = {i: t for i, t, *_ in rows if i not in (None, 9, 10)}
    by_document = check_packing(found)
    assert {i for i, _ in by_document} == set(texts)
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in found}
    for (i, total), pieces in by_document.items():
        ids = np.array([*whole.encode(texts[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert len(ids) == total == sum(n for _, n in pieces)
        end = 0
        for start, length in sorted(pieces):
            assert start == end and sums[(i, start)] == zlib.crc32(ids[start:start + length].tobytes())
            end += length


def test_pack_repeated_rows_and_nothing(docs, no_docs):
    found = packing.pack(docs.where("doc_id = 9"), tokenizer_path()).collect()
    assert sum(r.length for r in found) == 2 * found[0].doc_tokens
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_harmonic_classes_of_any_length(spark):
    lengths = [1, 2, 3, 5, 7, 8, 9, 10, 16] * 7
    pieces = spark.createDataFrame([(k, 0, n, 0, n) for k, n in enumerate(lengths)], packing.PIECE)
    found = packing.harmonic_pack(pieces, 16).collect()
    assert Counter(r.length for r in found) == Counter(lengths)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by_sequence.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 16 and len({16 // n for _, n in members}) == 1


# --- sharding -------------------------------------------------------------------------------------


def test_table_is_even_and_steady():
    names = [f"s{k}" for k in range(20)]
    before = sharding.fill_table(names, 2003)
    counts = np.bincount(before)
    assert counts.min() >= 2003 // 20 and counts.max() <= 2003 // 20 + 1
    after = sharding.fill_table(names[:-1], 2003)
    stayed = (before != 19) & (before == after)
    assert stayed.sum() / (before != 19).sum() > 0.7
    for wrong in ((["a", "a"], 7), ([], 7), (["a"], 8), (["a", "b", "c"], 3)):
        with pytest.raises(ValueError):
            sharding.fill_table(*wrong)


def test_assign_shards(docs, no_docs, rows):
    names = ["a", "b", "c"]
    table = sharding.fill_table(names, 101)
    found = sharding.assign_shards(docs, names, 101).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in rows)
    assert all(r.shard == names[table[r.slot]] for r in found)
    assert len({(r.doc_id, r.slot) for r in found}) == len({r.doc_id for r in found})
    assert sharding.assign_shards(no_docs, names, 101).count() == 0


# --- mixing ---------------------------------------------------------------------------------------


def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] >= cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_sources(docs, rows, no_docs):
    found = mixing.mix_sources(docs, block_rows=20).collect()
    words = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    targets = brute_targets(sizes)
    source = {}
    for i, t, _, s, _ in rows:
        source.setdefault((i, words(t)), s)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, words(t)) for i, t, *_ in rows)
    taken, largest = Counter(), Counter()
    for r in found:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken == r.copies * r.size)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= largest[s]
    again = mixing.mix_sources(docs.repartition(7), block_rows=20).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == Counter((r.doc_id, r.size, r.taken) for r in again)
    assert mixing.mix_sources(no_docs).count() == 0


# --- extraction -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="no-sidebar"><header><a href="/">Site</a></header><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div class="content"><h1>Title &amp; more</h1><!-- ad --><div class="ad">Buy, buy, buy</div>
<p>Hello, <a href=x>link</a>   world &lt;3. This is a long paragraph, with commas, and so on.<br>Same block
<p>Second&#32;para<ul><li>one<li>two</ul><blockquote>Quoted, text</blockquote></div>
<div class="sidebar"><p>side, bar, text</p></div></div>
<section id="comments"><article class="comment"><p>nice, post, really, really, really</p></article></section>
<form><p>Name, please</p><input></form><aside>More</aside><footer>foot, er</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == (
        "Title & more\nHello, link world <3. This is a long paragraph, with commas, and so on. Same block\n"
        "Second para\none\ntwo\nQuoted, text")
    assert html.main_text("<nav><a>Menu</a></nav><article><h1>A</h1><p><b>A<br><p>B</article><footer>f</footer>") == "A\nA\nB"
    assert [html.main_text(x) for x in (None, "", "<p>", "no markup &lt;b&gt;", "<script>x</script>")] == [
        "", "", "", "no markup <b>", ""]
    deep = "<div>" * 3000 + "<p>inside, at last</p>"
    assert html.main_text(deep) == "inside, at last"
    sections = "<article>" + "".join(f"<section><h2>h{k}</h2><p>short {k}</p></section>" for k in range(5)) + "</article>"
    assert html.main_text(sections).split("\n") == [x for k in range(5) for x in (f"h{k}", f"short {k}")]


TEXT = "A first paragraph, with commas, and words enough to count, as articles have."
PARTS = f"<h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p>"
WHOLE = f"Title\n{TEXT}\n{TEXT}"


@pytest.mark.parametrize("page", [
    f"<body><div id=page class='has-sidebar'><div>{PARTS}</div><div class=sidebar><p>side</p></div></div></body>",
    f"<body><nav>menu</nav><div class='content widget'>{PARTS}</div></body>",
    f"<body><div class='hidden-print'><main>{PARTS}</main></div><div class=ad>Buy, buy</div></body>",
    f"<body><form action=x><input name=state><div>{PARTS}<div class=share>Share</div></div></form></body>",
    f"<body><form><fieldset><div class='widget'>{PARTS}</div></fieldset></form><form><p>Search, here</p></form></body>",
    f"<div class=comments-open><div>{PARTS}</div><div id=comments>" + "<p>I, for one, agree, really.</p>" * 30 + "</div></div>",
    f"<body><div>{PARTS}</div><div class=comments>" + "<article><p>I, for one, agree, really.</p></article>" * 30 + "</div></body>",
    f"<body><article>{PARTS}</article><div class=sidebar>" + f"<p>{TEXT}</p>" * 3 + "</div></body>",
    f"<body><div>{PARTS}</div><div class=related><article><p>Another, teaser</p></article></div></body>",
])
def test_doubtful_elements_stay_when_they_hold_the_article(page):
    assert html.main_text(page) == WHOLE


def test_short_sibling_parts_stay():
    for tag in ("div", "section"):
        parts = "".join(f"<{tag}>" + f"<p>Short part {k}.</p>" * (3 - 2 * k) + f"</{tag}>" for k in range(2))
        assert html.main_text(f"<body>{parts}</body>") == "Short part 0.\n" * 3 + "Short part 1."
    assert html.main_text(f"<span class=widget>{TEXT}</span>") == TEXT


def test_extract_main_text(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, 2), (3, "v", "", 3), (4, "w", "<p>" + "long, text " * 50_000, 4)]
    found = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert Counter((r.page_id, r.url, r.text) for r in found) == Counter((i, u, html.main_text(h)) for i, u, h, _ in rows)
    assert all(r.n_chars == len(r.text) for r in found)


# --- token counts ---------------------------------------------------------------------------------


def brute_count(word, scores, byte):
    best = [(0, 0)]
    for d in range(1, len(word) + 1):
        size = len(word[d - 1].encode())
        options = [(best[d - 1][0] + size * byte, best[d - 1][1] - size)]
        options += [(best[s][0] + scores[word[s:d]], best[s][1] - 1) for s in range(d) if word[s:d] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_count_tokens(docs, rows, no_docs):
    scores = token_counts.zipf_scores(tokenizer_path(VOCABULARY))
    byte = min(scores.values()) - 10 * token_counts.UNIT
    known = {}
    wanted = Counter()
    for i, t, *_ in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        if any(len(w) > 1000 for w in words):
            continue
        for w in set(words) - set(known):
            known[w] = brute_count(token_counts.SPACE_MARK + w, scores, byte)
        wanted[(i, len(words), sum(known[w] for w in words))] += 1
    found = token_counts.count_tokens(docs, tokenizer_path(VOCABULARY)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_tokens) for r in found if r.doc_id != 12) == wanted
    assert token_counts.count_tokens(no_docs, tokenizer_path(VOCABULARY)).count() == 0


@pytest.mark.parametrize("probe", [
    "<a x ", "<div><p>", "<b>x", "<li>x", "<i><b>x</i>", "<td>", '<a x="', "<nav></x>", "</x>", "<p>a<div>b", "<form><p>x"])
def test_pages_take_time_in_proportion(probe):
    """Twice the page takes about twice the time; with the square it would take four times as long."""
    times = []
    for k in (10_000, 20_000, 40_000):
        started = time.process_time()
        html.main_text(probe * k)
        times.append(time.process_time() - started)
    assert times[2] < 0.2 or times[2] < 8 * times[0], times


def test_ends_of_tags():
    """Against a plain scan from every place."""
    rng = random.Random(2)
    for _ in range(300):
        page = "".join(rng.choice("a <>\"'") for _ in range(rng.randint(0, 14)))
        ends = html._TagEnds(page)
        for at in range(len(page) + 1):
            quote, end = "", -1
            for k in range(at, len(page)):
                if quote:
                    quote = "" if page[k] == quote else quote
                elif page[k] in "\"'":
                    quote = page[k]
                elif page[k] == ">":
                    end = k
                    break
            assert ends.after(at) == end


def test_no_pages(spark):
    assert html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- languages ------------------------------------------------------------------------------------


def test_phrases_against_substring_search():
    samples = {"x": " the cat sat on the mat ", "y": " der hund und die katze "}
    model = language.LanguageModel(samples)

    def phrases(text, sample):
        count = at = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at:at + size + 1] in sample:
                size += 1
            count, at = count + 1, at + size
        return count

    words = ["the", "cathedral", "hund", "katzen", "q", "日本", "satonthemat"]
    for word, row in zip(words, model.costs(words)):
        assert row.tolist() == [phrases(f" {word} ", samples[name]) for name in model.languages]


def test_identify_edge_cases(docs, rows, no_docs):
    model = language.LanguageModel({"x": " alpha beta gamma ", "y": " river stone light "})
    found = language.identify(docs, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0.0 for i in (4, 5, 6))
    assert all(0.0 <= r.score <= 1.0 for r in found)
    assert language.identify(no_docs, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.LanguageModel({})).collect()} == {"und"}
    assert language.fit(no_docs).languages == []


def test_held_out_accuracy(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(sample, ~language.held_out())
    found = language.identify(sample, model, ["doc_id", "lang"]).where(language.held_out()).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
