"""Prefix tries against sets of all prefixes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import prefix_trie as T


def path_of(sequence):
    """Digests of the prefixes of a sequence of small numbers."""
    path = [T.ROOT]
    for x in sequence:
        path.append(hashlib.blake2b(path[-1] + bytes([x]), digest_size=T.DIGEST).digest())
    return path


@pytest.mark.parametrize("low, high", [(0, 1), (0, 9), (3, 4), (5, 7), (8, 15), (7, 8)])
def test_two_fattest(low, high):
    zeros = lambda k: (k & -k).bit_length()
    assert T.two_fattest(low, high) == max(range(low + 1, high + 1), key=zeros)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=25))
def test_exit_nodes_and_expanded_edges(sequences):
    """Every exit depth is the longest prefix that is there, and the nodes are the distinct prefixes."""
    trie, seen = T.ZFastTrie(), {()}
    for number, sequence in enumerate(sequences):
        node, depth = trie.locate(path_of(sequence))
        assert depth == max(d for d in range(len(sequence) + 1) if tuple(sequence[:d]) in seen)
        assert trie.low[node] < depth <= trie.high[node] or depth == trie.high[node]
        trie.insert(path_of(sequence), [0, *sequence], 1, 100 - number)
        seen |= {tuple(sequence[:d]) for d in range(len(sequence) + 1)}
    members, ends = defaultdict(list), Counter()
    for number, sequence in enumerate(sequences):
        ends[path_of(sequence)[-1]] += 1
        for digest in path_of(sequence):
            members[digest].append(100 - number)
    found = {row[0]: row for row in trie.nodes()}
    assert len(found) == len(seen) and set(found) == set(members)
    for digest, (_, _, _, _, n_convs, n_ends, least) in found.items():
        assert (n_convs, n_ends, least) == (len(members[digest]), ends[digest], min(members[digest]))


def test_a_long_shared_prefix_is_found_in_few_steps():
    trie, asked = T.ZFastTrie(), []

    class Counting(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    trie.handles = Counting()
    base = [k % 5 for k in range(4000)]
    trie.insert(path_of(base), [0, *base], 1, 1)
    for cut in (1, 17, 1000, 3999):
        trie.insert(path_of(base[:cut] + [9, 9]), [0] * (cut + 3), 1, 2)
    asked.clear()
    assert trie.locate(path_of(base[:3998] + [8]))[1] == 3998
    assert len(asked) <= 13


def brute_force(rows):
    """Nodes from the turns (conv_id, turn, role, text) by sets of all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    for p, ids in members.items():
        under = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        ends = ",".join(str(c) for c in sorted(ids) if len(rebuilt[c]) == len(p))
        out[(min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p],
             sum(children[q] == 0 for q in under), saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def turns_of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = {name: F.lit("x") for name in ("turns", "digest", "size", "path", "base", "h")}
    return frame.withColumns(clashing).repartition(3)


def trie_of(frame, **kw):
    return Counter(tuple(r) for r in T.prefix_trie(T.share_heads(T.turn_lists(frame)), **kw).collect())


def test_awkward_conversations(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(-6, 60), 1000, 1003]:
        if c % 7 == 3 and c % 5 == 0:
            continue  # heads that are absent
        rows += [(c, k, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])) for k in range(rng.randint(1, 12))]
    rows += [(70, None, "user", "first"), (70, 0, "user", "a"), (70, 0, "user", "b"), (70, 0, "user", "b"), (None, 0, "user", "a")]
    rows += [(71 + k, 0, "system", "same") for k in range(300)]
    rows += [(500, k, "user", "long " * 50) for k in range(300)] + [(505, k, "user", "x" * 200_000) for k in range(2)]
    wanted = brute_force(rows)
    frame = turns_of(spark, rows)
    assert trie_of(frame) == wanted
    assert trie_of(frame, trie_turns=40) == wanted, "tries that are handed out often"


def test_a_search_that_finds_nothing_gives_another_trie(monkeypatch):
    """Without exits, sequences share nothing but the root."""
    paths = [path_of([1, 2, 3]), path_of([1, 2, 4])]
    trie = T.ZFastTrie()
    monkeypatch.setattr(trie, "locate", lambda prefixes: (0, 0))
    for k, path in enumerate(paths):
        trie.insert(path, [0] * 4, 1, k)
    assert [row[4] for row in trie.nodes()].count(2) == 1, "only the root is shared"


def test_no_conversations(spark):
    assert trie_of(turns_of(spark, []).where("false")) == Counter()
    assert trie_of(turns_of(spark, [(None, 1, "user", "a")])) == Counter()


def test_conversations_that_become_turnless(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 5)]
    assert trie_of(turns_of(spark, rows)) == brute_force(rows)
