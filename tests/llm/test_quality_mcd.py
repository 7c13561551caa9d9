from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from helpers import awkward, corpus, empty

from kiln.llm import quality_mcd as q


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts_and_edge_rows(spark):
    rows = [*corpus(), (500, "# a | b\n# a | b\n\n x <y> $5 %\n# a | b"), (501, "a b a b a b a b"), (502, "in in in in"), (503, "one two")]
    got = q.robust_quality(awkward(spark, rows)).collect()
    assert len(got) == len(rows) + 10
    for r in got:
        n, chars, symbols, dup, repeat = counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    assert set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "score", "shard", "spans", *q.RESULTS}
    assert q.robust_quality(empty(spark)).count() == 0


def test_outliers_go_and_clean_texts_stay(spark):
    rng = random.Random(3)
    clean = [(i, " ".join(f"word{rng.randrange(3000)}" for _ in range(rng.randrange(80, 900)))) for i in range(400)]
    junk = [(1000 + i, " ".join(f"w{rng.randrange(900)}##$$" for _ in range(200))) for i in range(40)]
    df = spark.createDataFrame([(i, t, "en", "hot" if i % 3 else f"s{i % 7}") for i, t in clean + junk], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in q.robust_quality(df, ["doc_id"]).filter("kept").collect()}
    assert kept == {i for i, _ in clean}


def test_estimate_is_mean_and_covariance_with_ridge(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(q.STATS))) @ rng.normal(size=(len(q.STATS), len(q.STATS)))
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "_g string, " + ", ".join(f"{s} double" for s in q.STATS))
    est = q._estimate(df)
    cov = np.cov(x.T, bias=True) + np.diag(np.array(q.FLOOR) ** 2)
    row = est.first().asDict()
    chol = np.array([[row.get(f"l{i}{j}", 0.0) or 0.0 for j in range(len(q.STATS))] for i in range(len(q.STATS))])
    assert np.allclose(chol, np.linalg.cholesky(cov), atol=1e-8)
    d = sorted(r["distance2"] for r in q._with_distance(df, est).collect())
    c = x - x.mean(0)
    assert d == pytest.approx(sorted(np.einsum("ij,jk,ik->i", c, np.linalg.inv(cov), c)), rel=1e-6)


def _clean(rng, n, words=3000):
    return [" ".join(f"word{rng.randrange(words)}" for _ in range(rng.randrange(80, 900))) for _ in range(n)]


def test_small_groups_are_judged_by_all_rows_of_the_language_or_table(spark):
    rng = random.Random(11)
    junk = lambda: " ".join(f"w{rng.randrange(900)}##$$" for _ in range(200))
    rows = [(i, t, "en", "big") for i, t in enumerate(_clean(rng, 400))]
    rows += [(1000 + i, junk(), "en", "junk only") for i in range(6)]         # the language's estimate
    rows += [(2000 + i, junk(), "xx", "junk only") for i in range(6)]         # the table's estimate
    rows += [(3000 + i, t, "en", "small") for i, t in enumerate(_clean(rng, 5))]
    rows += [(4000 + i, t, "yy", None) for i, t in enumerate(_clean(rng, 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in q.robust_quality(df, ["doc_id"]).filter("kept").collect()}
    assert kept == {i for i, *_ in rows if not 1000 <= i < 3000}


def test_estimate_of_least_determinant_is_near_the_brute_force_one(spark):
    """Clustered outliers; the brute force concentrates from 200 random starts in NumPy. The starts of
    ``fit_mcd`` reach a determinant as small up to the approximate percentiles."""
    rng = np.random.default_rng(4)
    p, ridge = len(q.STATS), np.diag(np.array(q.FLOOR) ** 2)
    x = np.vstack([rng.normal(size=(240, p)) @ rng.normal(size=(p, p)), rng.normal(size=(60, p)) * 0.3 + 12])
    keep, best = int(len(x) * q.H), None
    for _ in range(200):
        rows = rng.choice(len(x), q.START_ROWS, replace=False)
        for _ in range(10):
            m, c = x[rows].mean(0), np.cov(x[rows].T, bias=True) + ridge
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            rows = np.argsort(d)[:keep]
        det = np.linalg.slogdet(np.cov(x[rows].T, bias=True) + ridge)[1]
        if best is None or det < best[0]:
            best = det, rows
    assert best[1].max() < 240
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "_g string, " + ", ".join(f"{s} double" for s in q.STATS))
    est = q.fit_mcd(df)
    d = sorted((r["distance2"] / r["_scale"], r["x_len"] > 8 and r["x_word"] > 8)
               for r in q._with_distance(df, est).select("distance2", "_scale", "x_len", "x_word").collect())
    cut = q.chi2_quantile(1 - q.ALPHA)
    assert [far for d2, far in d if d2 > cut] == [True] * 60 and not any(far for d2, far in d if d2 <= cut)
    start = q._starts(df)
    for step in range(q.TRIALS + q.STEPS):
        start = q._concentrated(df, start, f"-test{step}")
    dets = [2 * sum(np.log(r[f"l{i}{i}"]) for i in range(p)) for r in start.collect()]
    assert len(dets) > 1 and min(dets) < best[0] + 0.25


def test_chi_square_quantiles():
    assert q.chi2_quantile(0.5) == pytest.approx(5.3481, abs=1e-4) and q.chi2_quantile(0.975) == pytest.approx(14.4494, abs=1e-4)
