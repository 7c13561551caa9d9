"""Spelling variants against all words by brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import awkward, empty

from kiln.llm import trie_variants as tv


def counted(docs):
    up = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    c = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(up)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            c[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def neighbours(words):
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            v = w[:i] + w[i + 1:]
            holes[i, v].add(w)
            if v in words:
                near[w].add(v)
                near[v].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(docs):
    n = counted(docs)
    near, form, out = neighbours(n), {}, {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in tv.spelling_variants(df).collect()}


def corpus(seed, letters, stems, tail):
    """Few letters, common fronts and ends: many near words, deep nodes, double letters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(tail)]
    vocabulary = [rng.choice(stems) + w for w in vocabulary] + [w + rng.choice(stems) for w in vocabulary]
    return [(i, " ".join(rng.choice(vocabulary) if rng.random() < 0.8 else vocabulary[0] for _ in range(60))) for i in range(150)]


@pytest.mark.parametrize("case", [(1, "ab", ["aaaa", "abab", "bbbbbbbb"], 60), (2, "abcdéÿ", ["inter", "extra", ""], 500), (3, "aA", ["aaaaaaa"], 80)])
def test_equals_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(tv, "BUCKET", 4)
    docs = corpus(*case)
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_chain_of_forms_and_ties(spark):
    counts = {"abcdefgh": 2000, "abcdefg": 200, "abcdeg": 500, "abcdefx": 20, "abcdxfx": 2, "zbcdefgh": 2000, "qqqqqqqq": 2, "yzcdefgh": 2}
    docs = [(None, " ".join([w] * n)) for w, n in counts.items()]
    want = brute(docs)
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == want
    assert len({w for w, r in want.items() if r[0]}) >= 3


def test_long_words_that_share_long_parts(spark, monkeypatch):
    monkeypatch.setattr(tv, "BUCKET", 2)
    stem = "x" * 3000 + "abc" * 500
    words = [stem + t for t in ("", "d", "de", "df", "dg", "dge", "q")] + [t + stem for t in ("d", "ed", "fd")]
    docs = [(i, f"{w}. {w}") for i, w in enumerate(words)]
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_awkward_and_empty(spark):
    rows = [(1, "Straßen×÷Wörter straßen×÷wörter 漢字abcdefgh abcdefgh abcdefg9 ABCDEFGI abcdefgi"), (1, None)]
    df = awkward(spark, rows)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert result(df) == brute(docs)
    out = tv.spelling_variants(empty(spark))
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert tv.spelling_variants(spark.createDataFrame([(1, "only short words")], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark):
    from kiln.llm.common import table
    from kiln.llm.q13 import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op13_spelling_variants"](spark, sf).collect()} == brute(docs)
