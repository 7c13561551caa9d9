"""Rules from one count table, and statistics stored per span, against the rows themselves."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.operators import profile_store as PS
from kiln.operators import rules as R
from kiln.operators import schema as S
from kiln.operators import stats as ST
from kiln.operators import validate as V
from kiln.session import scratch_path


def _split(spark, rows, schema="id int, name string, tags array<string>, x double"):
    return spark.createDataFrame(rows, schema)


TRAIN = [(1, "a", ["u"], 1.0), (2, "b", ["u", "v"], 2.0), (3, "a", ["w"], 3.0), (4, "c", ["w"], None)]


def test_schema_from_counts_equals_the_profile(spark):
    df = _split(spark, TRAIN)
    counts = R.count_table({"train": df})
    got = R.schema_from_counts(counts, "train")
    want = S.infer_schema(ST.profile(df), array_sizes=V.array_sizes(df, ["tags"]))
    assert sorted(map(tuple, got.domains.collect())) == sorted(map(tuple, want.domains.collect()))
    assert {r["feature"]: r.asDict() for r in got.features.collect()} == {r["feature"]: r.asDict() for r in want.features.collect()}


def test_every_rule_fires(spark):
    evals = _split(spark, [("1", "a", ["u"], 5.0, True), ("2", "z", [], 1.0, False), ("3", "z", ["a", "b", "c"], 1.0, None)],
                   "id string, name string, tags array<string>, x double, extra boolean")
    serving = _split(spark, [(None, None, ["u"])], "id int, name string, tags array<string>")
    counts = R.count_table({"train": _split(spark, TRAIN), "eval": evals, "serving": serving})
    schema = R.schema_from_counts(counts, "train")
    schema = S.set_feature(schema, "name", skew_threshold=0.1, drift_threshold=0.1)
    got = {tuple(r)[:4]: r["value"] for r in R.validate_splits(counts, schema, {"eval": None, "serving": None}, ("train", "serving"), ("eval", "train")).collect()}
    assert got == {
        ("eval", "extra", "SCHEMA_NEW_COLUMN", None): None, ("eval", "id", "UNEXPECTED_TYPE", "INT->BYTES"): None,
        ("eval", "tags", "VALUE_COUNT", "below_min"): 0.0, ("eval", "tags", "VALUE_COUNT", "above_max"): 3.0,
        ("eval", "name", "UNEXPECTED_STRING_VALUES", "z"): 2 / 3, ("eval", "name", "DRIFT", "z"): 2 / 3,
        ("serving", "x", "SCHEMA_MISSING_COLUMN", None): None, ("serving", "id", "PRESENCE", "count"): 0.0,
        ("serving", "name", "PRESENCE", "count"): 0.0, ("serving", "name", "SKEW", "a"): 0.5}


def test_environments_relaxed_domains_and_clean_splits(spark):
    train = _split(spark, TRAIN)
    other = _split(spark, [(9, "a", ["u"], 1.0), (8, "b", ["u"], None), (7, "y", ["u"], 2.0)])
    counts = R.count_table({"train": train, "eval": other, "serving": other.drop("name")})
    schema = S.not_in_environment(R.schema_from_counts(counts, "train"), "name", "SERVING")
    assert R.validate_splits(counts, schema, {"train": None, "serving": "SERVING"}).count() == 0
    assert R.validate_splits(counts, S.set_feature(schema, "name", min_domain_mass=0.6), {"eval": None}).count() == 0
    strict = R.validate_splits(counts, schema, {"eval": "TRAINING"}).collect()
    assert [(r["feature"], r["anomaly"], r["detail"]) for r in strict] == [("name", "UNEXPECTED_STRING_VALUES", "y")]
    nothing = R.count_table({"train": train, "eval": train.limit(0)})
    rows = R.validate_splits(nothing, R.schema_from_counts(nothing, "train"), {"eval": None}).collect()
    assert {(r["feature"], r["anomaly"], r["detail"]) for r in rows} == {(c, "PRESENCE", "count") for c in ("id", "name", "tags", "x")}


def test_three_shuffles_at_most(spark):
    """Totals and distances are one exchange each; the counts are stored with one."""
    df = spark.range(100).select((F.col("id") % 9).cast("string").alias("name"))
    counts = R.count_table({"train": df, "eval": df.where("name <> '3'")})
    schema = S.set_feature(R.schema_from_counts(counts, "train"), "name", drift_threshold=0.001)
    out = R.validate_splits(counts, schema, {"eval": None}, drift=("eval", "train"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1 and plan.count("Exchange hashpartitioning") <= 1


# ------------------------------------------------------------------------------ stored spans

def _rows(n=6000, seed=2):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), 0.0]
    return [(f"d{rng.randrange(5)}", rng.choice(odd) if i % 40 == 0 else 1e6 + rng.gauss(0, 3), None if i % 9 == 0 else f"v{int(rng.expovariate(0.2))}") for i in range(n)]


@pytest.fixture(scope="module")
def store(spark):
    path = scratch_path(spark, "store")
    rows = _rows()
    df = spark.createDataFrame(rows, "day string, x double, v string")
    PS.write_spans(df.where("day <> 'd4'"), path, "day")
    PS.write_span(df.where("day = 'd4'").drop("day"), path, "d4")           # a later delivery of one span
    PS.write_span(df.where("day = 'd4'").drop("day"), path, "d4")           # written again: nothing changes
    return path, rows


def test_merged_statistics_equal_the_rows(spark, store):
    path, rows = store
    for spans in (None, ["d1", "d4"]):
        mine = [r for r in rows if spans is None or r[0] in spans]
        st = {r["feature"]: r for r in PS.statistics(PS.merged(PS.stored(spark, path, spans)), [0.1, 0.5, 0.9]).collect()}
        x = sorted(r[1] for r in mine if r[1] is not None and abs(r[1]) < float("inf"))
        mean = sum(x) / len(x)
        s = st["x"]
        assert (s["count"], s["missing"], s["other"]) == (len(x), sum(r[1] is None for r in mine), len(mine) - len(x) - sum(r[1] is None for r in mine))
        assert s["zeros"] == x.count(0.0) and (s["min"], s["max"]) == (x[0], x[-1]) and abs(s["mean"] - mean) < 1e-6
        assert abs(s["std_dev"] - (sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5) < 1e-4
        for p, v in zip([0.1, 0.5, 0.9], s["quantiles"], strict=True):
            assert sum(y < v for y in x) / len(x) <= p + PS.RANK_ERROR and sum(y <= v for y in x) / len(x) >= p - PS.RANK_ERROR
        v = [r[2] for r in mine if r[2] is not None]
        assert st["v"]["count"] == len(v) and abs(st["v"]["distinct"] - len(set(v))) <= 0.05 * len(set(v)) and st["v"]["std_dev"] is None
        assert abs(st["v"]["avg_length"] - sum(map(len, v)) / len(v)) < 1e-9 and st["v"]["quantiles"] == [None] * 3


def _linf(a, b):
    p, q = Counter(a), Counter(b)
    d = {v: abs(p[v] / max(len(a), 1) - q[v] / max(len(b), 1)) for v in p | q}
    top = max(d.values())
    return top, min(v for v in d if abs(d[v] - top) < 1e-12)


def test_drift_and_distance_equal_the_rows(spark, store):
    path, rows = store
    of = lambda *days: [r[2] for r in rows if r[0] in days and r[2] is not None]
    got = {r["span"]: r for r in PS.drift_of_spans(PS.stored(spark, path), 0.01).collect()}
    assert sorted(got) == ["d1", "d2", "d3", "d4"]
    for k in range(1, 5):
        d, at = _linf(of(f"d{k}"), of(f"d{k - 1}"))
        assert abs(got[f"d{k}"]["distance"] - d) < 1e-12 and got[f"d{k}"]["at_value"] == at and got[f"d{k}"]["previous_span"] == f"d{k - 1}"
    two = [PS.merged(PS.stored(spark, path, s)) for s in (["d0", "d1"], ["d2", "d3", "d4"])]
    r = PS.distance(*two, 0.5).first()
    assert abs(r["distance"] - _linf(of("d0", "d1"), of("d2", "d3", "d4"))[0]) < 1e-12 and not r["is_anomaly"]


def test_shares_beyond_the_tracked_values_stay_within_the_bound(spark, monkeypatch):
    monkeypatch.setattr(PS, "HEAVY", 64)
    rng = random.Random(6)
    values = [f"h{i % 3}" if rng.random() < 0.5 else f"r{rng.randrange(3000)}" for i in range(8000)]
    path = scratch_path(spark, "store-heavy")
    for k in range(4):
        PS.write_span(spark.createDataFrame([(v,) for v in values[k::4]], "v string"), path, f"s{k}")
    got = {r["value"]: r["share"] for r in PS.shares(PS.merged(PS.stored(spark, path))).collect()}
    true = Counter(values)
    assert {"h0", "h1", "h2"} <= set(got) and all(abs(s - true[v] / 8000) <= 4.0 / 64 for v, s in got.items())
    missed = max((n / 8000 for v, n in true.items() if v not in got), default=0)
    assert missed <= 4.0 / 64


def test_empty_spans_and_missing_features(spark):
    path = scratch_path(spark, "store-empty")
    PS.write_span(spark.createDataFrame([(None, None)], "x double, v string"), path, "a")
    PS.write_span(spark.createDataFrame([("k",)], "v string"), path, "b")
    st = {r["feature"]: r for r in PS.statistics(PS.merged(PS.stored(spark, path))).collect()}
    assert (st["x"]["count"], st["x"]["missing"], st["x"]["quantiles"], st["v"]["count"]) == (0, 1, [None], 1)
    assert PS.drift_of_spans(PS.stored(spark, path), 0.1).count() == 0        # the first span of v has no value
