from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from helpers import awkward, corpus, empty

from kiln.llm import suffix_dedup as s
from kiln.llm.repeat_index import super_grams, window_minima


def brute(rows, length=s.LENGTH):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = True
        edges = np.diff(np.concatenate(([0], gone.view(np.int8))))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(t), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def planted():
    rng = random.Random(7)
    rows = corpus(seed=7)
    base = rows[0][1] + rows[3][1]
    for n in (199, 200, 201, 320, 361, 400):
        rows.append((300 + n, f"start {n} {rng.random()} " + base[37:37 + n] + f" é{rng.random()} end"))
    rows += [(800, "abc" * 300), (801, "x" * 450), (802, "x" * 200), (803, "x" * 199), (804, "y" * 205 + "z" + "y" * 205), (805, "ü" * 150)]
    edge = " ".join(f"passage{i}" for i in range(60))
    rows += [(900 + i, f"{rng.random()} {edge} {'tail' * (i % 4)} {rng.random()} {rng.random()}") for i in range(30)]
    return rows


@pytest.mark.parametrize("max_group", [s.MAX_GROUP, 3])
def test_matches_counts_of_all_strings(spark, max_group):
    rows = planted()
    got = s.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), max_group=max_group)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_edge_rows(spark):
    df = awkward(spark, [(1, "short")])
    rows = [(r["doc_id"], r["text"] if r["doc_id"] != 9005 else "") for r in df.collect()]
    got = s.without_repeats(df).collect()
    assert sorted((tuple(r) for r in got if r["doc_id"] != 9005), key=repr) == brute([r for r in rows if r[0] != 9005])
    long = [r for r in got if r["doc_id"] == 9005]
    assert len(long) == 2 and all(r["n_removed"] == r["n_bytes"] and r["n_spans"] == 1 for r in long)
    assert s.without_repeats(empty(spark)).count() == 0


def test_super_grams_hold_every_start_once():
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 100, 3000, dtype=np.uint8)) + b"q" * 500
    x = super_grams(text, 200, 40, 80)
    starts = np.concatenate([np.arange(a, a + n - 199) for a, n in zip(x["start"], x["size"], strict=True)])
    assert (starts == np.arange(len(text) - 199)).all()
    order = rng.integers(0, 50, 333).astype(np.uint64)
    assert (window_minima(order, 20) == [order[i:i + 20].min() for i in range(314)]).all()


def test_construction_against_direct_comparison():
    rng = random.Random(5)
    group, col, strings = [], [], []
    for g in range(12):
        gram = "".join(rng.choice("ab") for _ in range(8)).encode()
        for _ in range(rng.randrange(1, 14)):
            a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(8, 14))).encode()[-rng.randrange(0, 9) or 99:] for _ in range(2))
            x = a[-6:] + gram + b[:6] + b"c" * 4
            if (g, len(a[-6:]), x) not in zip(group, col, strings, strict=True):
                group.append(g)
                col.append(len(a[-6:]))
                strings.append(x)
    got = s.repeated_starts(np.array(group), np.array(col), strings, 12)
    for i, x in enumerate(strings):
        for k in range(len(x) - 11):
            want = any(j != i and group[j] == group[i] and (o := k - col[i] + col[j]) >= 0 and strings[j][o:o + 12] == x[k:k + 12]
                       for j in range(len(strings)))
            assert got[i, k] == want, (i, k)
