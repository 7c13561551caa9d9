from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from helpers import awkward, corpus, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm import parity_join as p
from kiln.llm.components import connected_components
from kiln.llm.hashing import shingle_sets


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows))


def test_matches_brute_force(spark):
    rng, rows = random.Random(8), corpus(seed=8, n=90)
    for i in range(100, 160):                     # copies at all distances around the threshold
        w = rows[i % 7][1].split(" ")
        for k in rng.sample(range(len(w)), 1 + i % 9):
            w[k] = f"z{rng.randrange(9999)}"
        rows.append((i, " ".join(w)))
    rows += [(200, "A b"), (201, "a B"), (202, "a b c"), (203, ""), (204, " ")]
    got = p.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_edge_rows(spark):
    got = p.near_duplicates(awkward(spark)).collect()
    assert len(got) == 10
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(r["component_id"] == i for i, r in by.items())
    assert by[9001]["n_shingles"] == 0 and by[9003]["n_shingles"] == 0 and by[9006]["n_shingles"] == 1
    assert p.near_duplicates(empty(spark)).count() == 0


def test_large_group_of_near_copies(spark):
    rng = random.Random(2)
    w = [f"t{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join([*w[:i % 100], f"x{i}", *w[i % 100 + 1:]])) for i in range(400)]
    got = p.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in got.collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.floats(0.0, 0.16), st.integers(0, 2**31))
def test_linked_sets_share_a_word_of_their_sketches(n, change, seed):
    """The guarantee behind the candidates, whatever frequencies the tokens are given."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    k = int(len(a) * change)
    b = np.unique(np.concatenate((a[k:], rng.integers(0, 2**63, int(rng.integers(0, k + 1)), dtype=np.uint64))))
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both):
        return
    grades = lambda s: (s % np.uint64(15)).astype(np.uint8)
    home = [int(np.searchsorted(p.BOUNDS, len(s), side="right")) - 1 for s in (a, b)]
    shared = False
    for band in {home[0], home[0] + 1} & {home[1], home[1] + 1}:
        x, y = (set(p.sketch_words(s, band, grades(s))[0].tolist()) for s in (a, b))
        shared |= bool(x & y)
    assert shared
    assert p.parity_distance(p.parity_bits(a), p.parity_bits(b)) <= len(a) + len(b) - 2 * both


def test_shingle_sets_follow_the_words():
    texts = ["A b c d e f", "a B c\td e\nf", "a b", "A  B", "", " \n", "b a", "a b c d e e"]
    sets = [s.tobytes() for s in shingle_sets([t.encode() for t in texts])]
    want = [shingles(t) for t in texts]
    assert [[x == y for y in sets] for x in sets] == [[x == y for y in want] for x in want]
    assert [len(s) // 8 for s in sets] == [len(x) for x in want]


def test_words_of_the_same_classes_become_one(monkeypatch):
    def packed(rows):                             # rows of (key, class index, frequent)
        key, own, plain = (np.array(x, np.uint32) for x in zip(*rows, strict=True))
        return pa.RecordBatch.from_pydict({"part": [3], "keys": [key.tobytes()], "owners": [(own | plain << np.uint32(31)).tobytes()],
                                           "classes": [np.array([10, -20, 30, 40], np.int64).tobytes()]})
    rows = [(1, 0, 0), (1, 1, 0), (2, 1, 0), (2, 0, 0), (2, 0, 0), (3, 0, 0), (3, 1, 0), (3, 2, 0), (4, 3, 0),
            (5, 2, 1), (6, 0, 1), (6, 1, 0), (6, 2, 0)]
    got = [tuple(r.values()) for b in p._shared_words(iter([packed(rows[:5]), packed(rows[5:])])) for r in b.to_pylist()]
    lists = {tuple(c): n for w, c, n in got if w is None}
    assert lists == {(-20, 10): 2, (-20, 10, 30): 1}
    # a key that words of rare and of frequent tokens happen to share keeps its rows
    assert sorted((w, *c, n) for w, c, n in got if w is not None) == sorted(
        [(-6, 30, 1), (-7, 10, 3), (3 << 32 | 6, -20, 3), (3 << 32 | 6, 30, 3)])
    monkeypatch.setattr(p, "MAX_LIST", 2)         # a word with more classes takes a row for each
    long = [tuple(r.values()) for b in p._shared_words(iter([packed(rows[:9])])) for r in b.to_pylist()]
    assert sorted((tuple(c), n) for w, c, n in long if w is None) == [((-20, 10), 2)]
    assert sorted((w, *c, n) for w, c, n in long if w is not None) == [(3 << 32 | 3, c, 3) for c in (-20, 10, 30)]


def test_words_of_one_leading_component_are_joined_once(spark):
    rng = random.Random(5)
    comp = {c: c if c % 4 else 0 for c in range(300)}                     # every fourth class is in component 0
    family = [(w, c, comp[c]) for w in range(50) for c in range(40) if rng.random() < 0.8]
    loose = [(100 + w, c, comp[c]) for w in range(60) for c in rng.sample(range(40, 300), 4)]
    hub = [(1000 + w, c, comp[c]) for w in range(80) for c in (999, 41 + 4 * (w % 60) - w % 2)
           if comp.setdefault(c, c) is not None]                            # words of one class with many others

    def pairs(rows):
        by = {}
        for w, c, k in rows:
            by.setdefault(w, set()).add((c, k))
        return [(a[0], b[0]) for x in by.values() for a in x for b in x if a < b and a[1] != b[1]]
    for rows in (family, family + loose + hub, loose, hub):
        got = [tuple(r) for r in p._merged(spark.createDataFrame(rows, "word long, class long, comp long")).collect()]
        assert len(got) == len(set(got)) and {r[1:] for r in got} == {r[1:] for r in rows}
        assert set(pairs(rows)) <= set(pairs(got)) and len(pairs(got)) <= len(pairs(rows))
        if rows is family:                                                  # one row a class, one pair for each two classes
            assert sorted(r[1] for r in got) == list(range(40)) and len(pairs(rows)) > 20 * len(pairs(got))
    assert p._merged(spark.createDataFrame([], "word long, class long, comp long")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(50, 99)] + [(3, 1), (3, 7), (200, 100), (5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 50 for i in range(50, 100)}, 1: 1, 3: 1, 7: 1, 100: 100, 200: 100}
