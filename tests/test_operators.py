"""Hand-worked cases and properties of the kiln operators (small in-memory inputs)."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions import scalar as X
from kiln.functions import text as TX
from kiln.functions import vectors as VX
from kiln.operators import metrics as M
from kiln.operators import models as MD
from kiln.operators import schema as S
from kiln.operators import stats as ST
from kiln.operators import validate as V
from kiln.operators.analyze import analyze, vocab_apply, vocab_build
from kiln.operators.position import with_position
from kiln.operators.split import split_hash, split_positional, split_sizes, splits_of


# ------------------------------------------------------------------------------ splits / positions

def test_split_sizes_hand_worked():
    assert split_sizes(10) == (7, 1, 2)
    assert split_sizes(90) == (62, 14, 14)          # int(90 * 0.7) is 62 in floating point


@pytest.mark.parametrize("parts", [1, 2, 8])
def test_position_index_matches_global_row_number(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("t"))
        p = with_position(df, ["k", "t"])
        g = df.withColumn("g", F.row_number().over(Window.orderBy("k", "t")) - 1)
        j = p.join(g, ["k", "t"])
        assert j.count() == 5000
        assert j.where(F.col("pos") != F.col("g")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_position_index_hot_leading_value(spark):
    # a third of the rows share one leading value; the tiebreak keeps the order total
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("t"))
    p = with_position(df, ["k", "t"])
    g = df.withColumn("g", F.row_number().over(Window.orderBy("k", "t")) - 1)
    assert p.join(g, ["k", "t"]).where(F.col("pos") != F.col("g")).count() == 0


def test_position_index_hot_value_is_split(spark):
    # one leading value holds half the rows; its rows must spread over several intervals
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"),
                                     (F.lit(10000) - F.col("id")).alias("t"))
    p = with_position(df, ["k", ("t", "desc")], buckets=16)
    g = df.withColumn("g", F.row_number().over(Window.orderBy(F.col("k"), F.col("t").desc())) - 1)
    assert p.join(g, ["k", "t"]).where(F.col("pos") != F.col("g")).count() == 0


def test_position_index_string_keys(spark):
    words = ["b", "a", "ab", "abc", "ba", "", "zz", "a\u00e9", "\u00e9", "abcdefghij", "abcdefghik"]
    df = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], "w string, c long")
    p = {r["w"]: r["pos"] for r in with_position(df, [("c", "desc"), ("w", "desc")], buckets=4).collect()}
    want = [w for _, w in sorted(((-(i % 3), w) for i, w in enumerate(words)),
                                 key=lambda t: (t[0], [-b for b in t[1].encode()] + [1]))]
    assert [w for w, _ in sorted(p.items(), key=lambda kv: kv[1])] == want


def test_split_positional_parts_disjoint_and_complete(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "key")
    t = split_positional(df, "key")
    counts = {r["split"]: r["n"] for r in t.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == dict(zip(("train", "eval", "serving"), split_sizes(1001)))
    parts = splits_of(t)
    assert sum(p.count() for p in parts.values()) == 1001
    assert parts["train"].agg(F.max("key")).first()[0] < parts["eval"].agg(F.min("key")).first()[0]


def test_split_hash_repeatable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = split_hash(df, "k").collect()
    b = split_hash(df.repartition(3), "k").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    shares = {r["split"]: r["n"] / 2000 for r in split_hash(df, "k").groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(shares["train"] - 0.70) < 0.05


# ------------------------------------------------------------------------------ string parsers

def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first()["o"]


def test_parse_storage_hand_worked(spark):
    r = _one(spark, X.parse_storage, "128GB SSD +  1TB HDD")
    assert (r["ssd_gb"], r["hdd_gb"], r["flash_gb"], r["total_storage_gb"]) == (128.0, 1024.0, 0.0, 1152.0)
    r = _one(spark, X.parse_storage, "1.0TB Hybrid")
    assert (r["ssd_gb"], r["hdd_gb"], r["flash_gb"], r["total_storage_gb"]) == (0.0, 0.0, 0.0, 0.0)
    r = _one(spark, X.parse_storage, "256GB Flash Storage")
    assert r["flash_gb"] == 256.0 and r["total_storage_gb"] == 256.0


def test_bucket_edges(spark):
    df = spark.createDataFrame([(13.9,), (14.0,), (15.6,)], "x float")
    got = [r[0] for r in df.select(X.bucketize(F.col("x"), [14.0, 15.6])).collect()]
    assert got == [0.0, 1.0, 2.0]


def test_resolution_takes_whole_width(spark):
    r = _one(spark, X.parse_resolution, "IPS Panel Full HD 1920x1080")
    assert (r["width"], r["height"]) == (1920.0, 1080.0)
    r = _one(spark, X.parse_resolution, "no numbers")
    assert r["width"] is None


def test_cpu_os_units_tokens(spark):
    r = _one(spark, X.parse_cpu, "Intel Core i5 7200U 2.5GHz")
    assert (r["brand"], r["family"]) == ("intel", "core i5") and abs(r["clock_ghz"] - 2.5) < 1e-6
    r = _one(spark, X.parse_cpu, "AMD A9-Series 9420 3GHz")
    assert (r["brand"], r["family"], r["clock_ghz"]) == ("amd", "a9-series", 3.0)
    assert [_one(spark, X.map_os, v) for v in ["Windows 10", "macOS", "Mac OS X", "Linux"]] == \
        ["windows", "macos", "macos", "linux"]
    assert _one(spark, lambda c: X.parse_unit(c, "gb"), "8GB") == 8.0
    assert _one(spark, lambda c: X.parse_unit(c, "kg"), "1.37kg") == 1.37
    assert _one(spark, lambda c: X.token_at(c, 1), "Nvidia GeForce GTX 1050") == "geforce"
    assert _one(spark, lambda c: X.token_at(c, 5), "Nvidia GeForce") == ""
    assert _one(spark, X.default_if_empty, "   ") == "UNKNOWN_COMPANY"
    assert _one(spark, lambda c: X.flag_contains(c, "quad hd+"), "Quad HD+ 3200x1800") == 1.0


# ------------------------------------------------------------------------------ analyzers

def test_vocab_ties_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "t string")
    v = {r["term"]: r["id"] for r in vocab_build(df, "t").collect()}
    assert v == {"c": 0, "b": 1, "a": 2}        # count desc, then term desc
    ev = spark.createDataFrame([("a",), ("z",)], "t string")
    got = {r["t"]: r["x"] for r in vocab_apply(ev, "t", vocab_build(df, "t"), "x").collect()}
    assert got == {"a": 2, "z": -1}


def test_zscore_and_impute_from_train_only(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    tf = analyze(train, lambda i, ctx: {"z": ctx.zscore(ctx.impute_mean(i["x"])), "c": ctx.zscore(F.lit(5.0))})
    z = [r["z"] for r in tf.apply(train).collect()]
    assert abs(np.mean(z)) < 1e-12 and abs(np.std(z) - 1.0) < 1e-12
    assert {r["c"] for r in tf.apply(train).collect()} == {0.0}             # std 0 -> 0
    ev1 = spark.createDataFrame([(10.0,)], "x double")
    ev2 = spark.createDataFrame([(10.0,), (-50.0,)], "x double")
    a = tf.apply(ev1).first()["z"]
    b = [r["z"] for r in tf.apply(ev2).collect()][0]
    assert a == b                                  # eval rows never change the frozen statistics


# ------------------------------------------------------------------------------ profiles & validation

def _toy(spark):
    train = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", None)], "s string, n long")
    serve = spark.createDataFrame([("a", 1), ("d", 2), ("d", 3), ("b", 4)], "s string, n long")
    return train, serve


def test_profile_and_schema(spark):
    train, _ = _toy(spark)
    prof = ST.profile(train)
    num = prof["numeric"].first()
    assert (num["count"], num["missing"], num["min"], num["max"]) == (3, 1, 1.0, 3.0)
    st = prof["string"].first()
    assert (st["count"], st["distinct"], st["top"], st["top_freq"]) == (4, 3, "a", 2)
    sch = S.infer_schema(prof)
    feats = {r["feature"]: r for r in sch.features.collect()}
    assert feats["s"]["domain"] == "s" and feats["n"]["type"] == "INT"
    assert feats["n"]["min_fraction"] == 0.0 and feats["s"]["min_fraction"] == 1.0
    assert sorted(r["value"] for r in S.domain_get(sch, "s").collect()) == ["a", "b", "c"]
    twice = S.domain_append(S.domain_append(sch, "s", ["d"]), "s", ["d", "a"])
    assert sorted(r["value"] for r in S.domain_get(twice, "s").collect()) == ["a", "b", "c", "d"]


def test_domain_mass_and_env(spark):
    train, serve = _toy(spark)
    sch = S.infer_schema(ST.profile(train))
    sf = ST.profile(serve)["freq"]
    d = V.validate_domain(sf, sch).collect()
    assert {(r["detail"], r["value"]) for r in d} == {("d", 0.5)}
    relaxed = S.set_feature(sch, "s", min_domain_mass=0.4)
    assert V.validate_domain(sf, relaxed).count() == 0
    env = S.not_in_environment(S.add_environment(sch, "TRAINING", "SERVING"), "n", "SERVING")
    assert [r["feature"] for r in S.env_filter(env, "SERVING").collect()] == ["s"]
    missing = V.validate_missing_column(ST.profile(serve.drop("n")), env, "TRAINING").collect()
    assert [r["feature"] for r in missing] == ["n"]
    assert V.validate_missing_column(ST.profile(serve.drop("n")), env, "SERVING").count() == 0


def test_linf_symmetric_bounded(spark):
    train, serve = _toy(spark)
    a, b = ST.profile(train)["freq"], ST.profile(serve)["freq"]
    d1 = V.linf_distance(a, b).first()["distance"]
    d2 = V.linf_distance(b, a).first()["distance"]
    assert d1 == d2 and 0.0 <= d1 <= 1.0
    assert abs(d1 - 0.5) < 1e-12                # 'd' has 0.5 on one side, 0 on the other
    assert V.linf_distance(a, a).first()["distance"] == 0.0


# ------------------------------------------------------------------------------ text and vectors

def test_multi_hot_and_sequences(spark):
    df = spark.createDataFrame([([8, 5, 8],)], "s array<int>")
    assert df.select(TX.multi_hot("s")).first()[0] == [5, 8]
    docs = spark.createDataFrame([(1, "the cat the hat"), (2, "a cat"), (3, ""), (4, None)], "id long, text string")
    idx = TX.word_index(docs, "text", 10)
    ranks = {r["word"]: r["rank"] for r in idx.collect()}
    assert ranks["the"] == 1 and ranks["cat"] == 2
    enc = {r["id"]: r["sequence"] for r in TX.encode(docs, "id", "text", idx, 100, index_rows=10).collect()}
    assert enc[1][0] == 1 and enc[1][1] == ranks["the"] + 3 and enc[3] == [1] and enc[4] == [1]
    dec = {r["id"]: r["decoded"] for r in TX.decode(
        TX.encode(docs, "id", "text", idx, 100, index_rows=10), "id", "sequence", idx, index_rows=10).collect()}
    assert dec[1] == "? the cat the hat"
    # the join-and-regroup path gives the same sequences as the in-task lookup
    old = TX.IN_TASK_LOOKUP_MAX
    TX.IN_TASK_LOOKUP_MAX = 0
    try:
        enc2 = {r["id"]: r["sequence"] for r in TX.encode(docs, "id", "text", idx, 100).collect()}
        dec2 = {r["id"]: r["decoded"] for r in TX.decode(
            TX.encode(docs, "id", "text", idx, 100), "id", "sequence", idx).collect()}
    finally:
        TX.IN_TASK_LOOKUP_MAX = old
    assert enc2 == enc and dec2 == dec
    v = TX.multi_hot_vector(spark.createDataFrame([([8, 5, 8],)], "s array<int>"), "s", 10).first()["features"]
    assert list(v.indices) == [5, 8] and v.size == 10


def test_encoding_looks_up_few_tokens_at_a_time(spark):
    import pyarrow as pa
    lists = pa.array([[1] * n for n in (3, 0, 500, 2, 2, 0, 7, 1)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.concat_arrays([lists, pa.array([[]], lists.type)])], names=["k", "s"])
    pieces = list(TX._pieces(iter([batch.slice(1), batch.slice(3, 0)]), 5))
    assert all(p.num_rows == 1 or len(p.column(1).flatten()) <= 5 for p in pieces)
    assert pa.Table.from_batches(pieces).equals(pa.Table.from_batches([batch.slice(1)]))


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 2)], "k long, v array<double>, y int")
    r = df.select(VX.argmax("v").alias("a"), VX.one_hot("y", 4).alias("o"), VX.vec_mean("v").alias("m"),
                  VX.vec_std("v").alias("s"), VX.vec_flatten(VX.vec_reshape("v", 2, 2)).alias("f"),
                  VX.dense_forward("v", [[1, 0], [0, 1], [0, 0], [0, 0]], [0.0, 0.0], "softmax").alias("p")).first()
    assert r["a"] == 3 and r["o"] == [0, 0, 1, 0] and r["m"] == 2.5 and r["f"] == [1.0, 2.0, 3.0, 4.0]
    assert abs(r["s"] - np.std([1, 2, 3, 4])) < 1e-12
    assert abs(r["p"][1] - math.exp(2) / (math.exp(1) + math.exp(2))) < 1e-12
    z = spark.createDataFrame([([0.0, 0.0],)], "v array<double>").select(VX.vec_standardize_clip("v")).first()[0]
    assert z == [0, 0]


# ------------------------------------------------------------------------------ metrics and history

def test_accuracy_hand_worked(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, 0.0, 1.0])],
                               "y int, p array<double>").withColumn("pred", VX.argmax("p"))
    assert M.accuracy(df, "pred", "y").first()[0] == 1.0
    assert M.rmse_onehot(df, "p", "y").first()[0] == 0.0
    half = spark.createDataFrame([(0, [0.5, 0.5])], "y int, p array<double>")
    assert abs(M.rmse_onehot(half, "p", "y").first()[0] - math.sqrt(0.5)) < 1e-12   # divided by rows


def test_history_rules(spark):
    h = spark.createDataFrame([(1, 1.0), (2, 0.8), (3, 0.9), (4, 0.85), (5, 0.7), (6, 0.75)],
                              "epoch int, val_loss double")
    e = M.early_stop(h, "epoch", "val_loss", patience=2).first()
    assert (e["stop_epoch"], e["best_epoch"], e["best_value"]) == (4, 5, 0.7)
    assert [r["epoch"] for r in M.best_checkpoint(h, "epoch", "val_loss").orderBy("epoch").collect()] == [1, 2, 5]
    lr = [r["lr_next"] for r in M.lr_plateau(h, "epoch", "val_loss", 0.01, 0.5, 2).orderBy("epoch").collect()]
    assert lr == [0.01, 0.01, 0.01, 0.005, 0.005, 0.005]


def test_linear_gd_matches_rowwise_descent(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "x0 double, x1 double, y double")
    got = MD.linear_gd(df, ["x0", "x1"], "y", 0.1, 40).orderBy("step").collect()
    w, b = np.zeros(2), 0.0
    for step in range(40):
        pred = x @ w + b
        loss = np.mean((y - pred) ** 2)
        assert abs(got[step]["loss"] - loss) < 1e-10
        w = w - 0.1 * (-2 * x.T @ (y - pred) / len(y))
        b = b - 0.1 * (-2 * np.mean(y - pred))
    assert abs(got[-1]["w_x0"] - w[0]) < 1e-10 and abs(got[-1]["b"] - b) < 1e-10


def test_user_metric(spark):
    df = spark.createDataFrame([(0, 2.0), (0, 4.0), (1, 10.0)], "g int, v double")
    m = M.UserMetric("mean", {"s": lambda: F.col("v"), "n": lambda: F.lit(1.0)}, lambda s: s["s"] / s["n"])
    assert {r["g"]: r["mean"] for r in m.evaluate(df, ["g"]).collect()} == {0: 3.0, 1: 10.0}


def test_slice_range_by_class_both_paths(spark):
    from kiln.operators.split import slice_range_by_class
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("c"), F.col("id").alias("k"))
    small = {(r["c"], r["k"], r["class_pos"]) for r in slice_range_by_class(df, "c", "k", 5, 15).collect()}
    big = {(r["c"], r["k"], r["class_pos"]) for r in slice_range_by_class(df, "c", "k", 5, 1500).collect()}
    assert small == {(c, 3 * p + c, p) for c in range(3) for p in range(5, 15)}
    assert big == {(c, 3 * p + c, p) for c in range(3) for p in range(5, 1000)}
    nulls = df.select(F.when(F.col("c") == 0, F.lit(None)).otherwise(F.col("c")).alias("c"), "k")
    got = slice_range_by_class(nulls, "c", "k", 0, 1200).where(F.col("c").isNull()).count()
    assert got == 1000                             # the null class keeps all its rows


def test_position_on_timestamp_ntz_any_zone(spark):
    import datetime as dt
    base = dt.datetime(2024, 3, 10, 1, 0, 0)
    rows = [(base + dt.timedelta(minutes=7 * i, microseconds=i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, i long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # 02:00-03:00 does not exist
        got = [r["i"] for r in with_position(df, ["ts", "i"], buckets=4).orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == list(range(60))


@pytest.mark.parametrize("desc", [False, True])
def test_position_hot_string_lead_with_shared_prefix(spark, desc):
    # URL-like keys share a long prefix; one value holds a third of the rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("https://site/page-hot"))
        .otherwise(F.concat(F.lit("https://site/page-"), F.lpad((F.col("id") % 701).cast("string"), 4, "0")))
        .alias("u"), F.col("id").alias("t"))
    keys = [("u", "desc") if desc else "u", "t"]
    p = with_position(df, keys, buckets=16)
    o = F.col("u").desc() if desc else F.col("u").asc()
    g = df.withColumn("g", F.row_number().over(Window.orderBy(o, F.col("t"))) - 1)
    assert p.join(g, ["u", "t"]).where(F.col("pos") != F.col("g")).count() == 0


@pytest.mark.parametrize("lead", ["num", "str"])
def test_position_hot_value_spreads_over_intervals(spark, lead):
    from kiln.operators.position import with_position_and_count
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    df = spark.range(0, 6000).select((k.cast("string") if lead == "str" else k).alias("k"), F.col("id").alias("t"))
    p, n = with_position_and_count(df, ["k", "t"], buckets=16, keep_intervals=True)
    sizes = [r["n"] for r in p.groupBy("__kiln_b1", "__kiln_b2").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert n == 6000 and sum(sizes) == 6000
    assert max(sizes) <= 0.2 * 6000          # the hot value (a third of the rows) is spread out


def test_api_names(spark):
    from kiln import api
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", float(i)) for i in range(20)], "k long, s string, x double")
    parts = api.split_positional(df, "k", label="x")
    assert [parts[p].count() for p in ("train", "eval", "serving")] == [14, 3, 3]
    assert "x" not in parts["serving"].columns
    assert api.allow_columns(df, {"k"}).columns == ["s", "x"]
    prof = api.profile(df, remove={"k"})
    sch = api.infer_schema(prof)
    assert api.validate(prof, sch).count() == 0
    assert api.skew(df, df.where("k < 10"), "s", 0.01).first()["distance"] == 0.0
    pts = api.synth_normal(spark, 4000, (0.0, 3.0), ((1.0, 0.5), (0.5, 1.0)))
    m = pts.agg(F.avg("x0"), F.avg("x1"), F.corr("x0", "x1")).first()
    assert abs(m[0]) < 0.1 and abs(m[1] - 3) < 0.1 and abs(m[2] - 0.5) < 0.1


def test_hyphenated_feature_names(spark):
    df = spark.createDataFrame([("No", 1.0), ("Steady", 2.0), ("No", None)], "`glimepiride-pioglitazone` string, `num-x` double")
    prof = ST.profile(df)
    sch = S.infer_schema(prof)
    assert {r["feature"] for r in sch.features.collect()} == {"glimepiride-pioglitazone", "num-x"}
    ev = spark.createDataFrame([("Up", 1.0)], "`glimepiride-pioglitazone` string, `num-x` double")
    anomalies = V.validate_all(ST.profile(ev), sch).collect()
    assert ("glimepiride-pioglitazone", "UNEXPECTED_STRING_VALUES") in {(r["feature"], r["anomaly"]) for r in anomalies}
    tf = analyze(df, lambda i, ctx: {"z": ctx.zscore(i["num-x"]), "v": ctx.vocab(i["glimepiride-pioglitazone"])})
    assert tf.apply(ev).count() == 1
    assert {r["column"] for r in __import__("kiln.operators.split", fromlist=["x"]).null_counts(df).collect()} == \
        {"glimepiride-pioglitazone", "num-x"}


def test_profile_splits_equals_per_split_profiles(spark):
    from oracle import rows_of
    from kiln.plans.fixtures import orders_split
    from kiln.operators.split import splits_of
    tagged = orders_split(spark, "/root/testdata/sf0.001")
    rm = {"o_orderkey", "pos"}
    one = ST.profile_splits(tagged, ("train", "eval", "serving"), remove=rm, exclude={"serving": {"o_orderstatus"}})
    parts = splits_of(tagged, label="o_orderstatus")
    for name in ("train", "eval", "serving"):
        sep = ST.profile(parts[name], remove=rm)
        for k in ("numeric", "string", "freq", "features"):
            assert rows_of(one[name][k].toPandas(), 9) == rows_of(sep[k].toPandas(), 9), (name, k)


def test_running_metric_chunked_prefix_sum(spark):
    rows = [(e, b, float(b % 7), float(b % 2), 2) for e in (1, 2) for b in range(50)]
    summ = spark.createDataFrame(rows, "epoch int, batch long, loss_sum double, correct_sum double, n long")
    got = {(r["epoch"], r["batch"]): r["running_loss"] for r in M.running_metric(summ, "epoch", "batch", chunk=8).collect()}
    for e in (1, 2):
        tot = 0.0
        for b in range(50):
            tot += b % 7
            assert abs(got[(e, b)] - tot / (2 * (b + 1))) < 1e-12


@pytest.mark.parametrize("kind", ["boolean", "decimal(10,2)", "date", "null"])
def test_position_index_other_key_types(spark, kind):
    base = spark.range(0, 300)
    if kind == "boolean":
        k = (F.col("id") % 3 == 0)
    elif kind == "date":
        k = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 17).cast("int"))
    elif kind == "null":
        k = F.lit(None).cast("int")
    else:
        k = ((F.col("id") % 23) / F.lit(7)).cast(kind)
    df = base.select(k.alias("k"), F.col("id").alias("t"))
    p = with_position(df, ["k", "t"], buckets=8)
    g = df.withColumn("g", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first(), "t")) - 1)
    assert p.join(g, ["t"]).where(F.col("pos") != F.col("g")).count() == 0


def test_split_positional_tiny_inputs(spark):
    for n in (0, 1, 2, 5):
        df = spark.range(0, n).withColumnRenamed("id", "key")
        counts = {r["split"]: r["c"] for r in split_positional(df, "key").groupBy("split")
                  .agg(F.count(F.lit(1)).alias("c")).collect()}
        want = dict(zip(("train", "eval", "serving"), split_sizes(n)))
        assert counts == {k: v for k, v in want.items() if v}


def test_boundary_split_equals_position_split(spark):
    df = spark.range(0, 5000).select(F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 997).alias("k"),
                                     F.col("id").alias("t"))
    a = {(r["k"], r["t"], r["split"]) for r in split_positional(df, ["k", "t"]).collect()}
    b = {(r["k"], r["t"], r["split"]) for r in split_positional(df, ["k", "t"], with_positions=True).drop("pos").collect()}
    assert a == b and len(a) == 5000


def test_boundary_split_nested_path(spark, monkeypatch):
    from kiln.operators import position as P
    monkeypatch.setattr(P, "DIRECT_RANK_ROWS", 10)
    df = spark.range(0, 4000).select(F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 997).alias("k"),
                                     F.col("id").alias("t"))
    a = {(r["k"], r["t"], r["split"]) for r in split_positional(df, ["k", "t"]).collect()}
    b = {(r["k"], r["t"], r["split"]) for r in split_positional(df, ["k", "t"], with_positions=True).drop("pos").collect()}
    assert a == b and len(a) == 4000


def test_exact_median_matches_rank_rule(spark):
    for n in (1, 2, 7, 10, 1001):
        vals = [float((i * 37) % 101) for i in range(n)]
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
        got = ST.stats_numeric(df, ["x"], exact_median=True).first()["median"]
        assert got == sorted(vals)[(n - 1) // 2]


def test_drift_by_span_hand_worked(spark):
    rows = [("d1", "a")] * 3 + [("d1", "b")] + [("d2", "a")] * 1 + [("d2", "b")] * 3 + [("d3", "b")] * 4
    df = spark.createDataFrame(rows, "span string, v string")
    got = {r["span"]: (r["previous_span"], r["distance"], r["at_value"], r["is_anomaly"])
           for r in V.drift_by_span(df, "span", ["v"], 0.3).collect()}
    assert got["d2"] == ("d1", 0.5, "a", True)           # a: .75 → .25, b: .25 → .75 (tie: smallest value)
    assert got["d3"][:3] == ("d2", 0.25, "a")             # a: .25 → 0, b: .75 → 1
    assert "d1" not in got


def test_stats_compare_overlays_two_sets(spark):
    a = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    b = spark.createDataFrame([(5.0,)], "x double")
    c = ST.stats_compare(ST.stats_numeric(a), ST.stats_numeric(b), ["count", "mean", "max"], "train", "eval")
    got = {r["measure"]: (r["train"], r["eval"]) for r in c.collect()}
    assert got == {"count": (2.0, 1.0), "mean": (2.0, 5.0), "max": (3.0, 5.0)}


def test_standardize_clip_values(spark):
    x = [0.0, 1.0, 2.0, 3.0]
    got = spark.createDataFrame([(x,)], "v array<double>").select(VX.vec_standardize_clip("v")).first()[0]
    m, sd = np.mean(x), np.std(x)
    assert got == [int(np.clip((v - m) / sd * 64 + 128, 0, 255)) for v in x]


def test_decode_unknown_ids(spark):
    idx = spark.createDataFrame([("cat", 1, 5), ("dog", 2, 3)], "word string, rank long, count long")
    seqs = spark.createDataFrame([(1, [1, 4, 5, 2, 99])], "id long, s array<bigint>")
    assert TX.decode(seqs, "id", "s", idx, index_rows=2).first()["decoded"] == "? cat dog ? ?"


def test_labelled_files_plain_class_folders(spark, tmp_path):
    from kiln.sources.io import read_labelled_files
    for cls, n in (("cat", 3), ("dog", 2)):
        (tmp_path / cls).mkdir()
        for i in range(n):
            (tmp_path / cls / f"{i}.jpg").write_bytes(bytes([i]) * (i + 1))
    got = read_labelled_files(spark, str(tmp_path), glob="*.jpg")
    rows = {(r["class"], r["class_index"], r["length"]) for r in got.collect()}
    assert rows == {("cat", 0, 1), ("cat", 0, 2), ("cat", 0, 3), ("dog", 1, 1), ("dog", 1, 2)}


def test_typed_parse_and_csv_quoting(spark, tmp_path):
    from kiln.sources.io import apply_feature_spec, read_table
    raw = spark.createDataFrame([(" 7 ", " Acer ", "", "13.3")], "a string, b string, c string, d string")
    r = apply_feature_spec(raw, {"a": "int64", "b": "string", "c": "float32", "d": "float32"}).first()
    assert (r["a"], r["b"], r["c"]) == (7, "Acer", None) and abs(r["d"] - 13.3) < 1e-6
    p = tmp_path / "t.csv"
    p.write_text('k,name\n1,"Core i5, 2.5GHz"\n2,plain\n')
    got = {r["k"]: r["name"] for r in read_table(spark, str(p), "k long, name string").collect()}
    assert got == {1: "Core i5, 2.5GHz", 2: "plain"}


def test_decision_boundary_line(spark):
    d = MD.decision_boundary(spark, [2.0, -4.0], 0.5, -1.0, 1.0, 3).orderBy("i").collect()
    assert [r["x"] for r in d] == [-1.0, 0.0, 1.0]
    for r in d:                                     # points satisfy W·x + b = 0.5
        assert abs(2.0 * r["x"] - 4.0 * r["y"] + 0.5 - 0.5) < 1e-12


def test_split_outputs_hold_their_own_rows(spark):
    from kiln.session import scratch_path
    from kiln.sources import sinks as SK
    df = split_hash(spark.range(0, 500).withColumnRenamed("id", "k"), "k")
    path = scratch_path(spark, "splits-test")
    SK.write_splits(df, path)
    back = SK.read_splits(spark, path)
    for name in ("train", "eval", "test"):
        want = {r["k"] for r in df.where(F.col("split") == name).collect()}
        got = {r["k"] for r in spark.read.parquet(f"{path}/split={name}").collect()}
        assert got == want and want
    assert back.count() == 500


# ------------------------------------------------------------------------------ missing data, modes

def test_positions_with_nan_nulls_and_infinities(spark):
    from kiln.operators.position import with_position
    rows = [(None if i % 2 else float("nan") if i % 10 == 0 else float("inf") if i % 34 == 4 else float(i % 97), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "x double, id long").repartition(7)
    rank = lambda x: (0, 0.0) if x is None else (2, 0.0) if x != x else (1, x)
    up = {i: p for p, (_, i) in enumerate(sorted(rows, key=lambda r: (rank(r[0]), r[1])))}
    down = {i: p for p, (_, i) in enumerate(sorted(rows, key=lambda r: ([-v for v in rank(r[0])], r[1])))}
    for direction, want in (("asc", up), ("desc", down)):
        got = {r["id"]: r["pos"] for r in with_position(df, [("x", direction), "id"], buckets=16).collect()}
        assert got == want
    kept = with_position_and_count_intervals(df)
    assert max(kept.values()) <= 2 * 4000 / 16


def with_position_and_count_intervals(df):
    from collections import Counter

    from kiln.operators.position import with_position_and_count
    out, _ = with_position_and_count(df, ["x", "id"], buckets=16, keep_intervals=True)
    return Counter((r["__kiln_b1"], r["__kiln_b2"]) for r in out.select("__kiln_b1", "__kiln_b2").collect())


def test_text_paths_agree_whatever_the_index_size(spark, monkeypatch):
    from kiln.functions import text as TX
    docs = spark.createDataFrame([(1, "a b a c"), (1, "b c"), (2, None), (2, None), (3, ""), (None, "zzz a")], "k long, t string")
    seqs = spark.createDataFrame([(1, [1, 4, 5]), (1, [1, 4, 5]), (2, None), (2, []), (None, [99, 3])], "k long, s array<long>")
    index = TX.word_index(docs, "t", 3)
    order = lambda df: sorted(map(repr, df.collect()))
    inside = order(TX.encode(docs, "k", "t", index, 10)), order(TX.decode(seqs, "k", "s", index))
    monkeypatch.setattr(TX, "IN_TASK_LOOKUP_MAX", 2)
    joined = order(TX.encode(docs, "k", "t", index, 10, index_rows=1)), order(TX.decode(seqs, "k", "s", index, index_rows=1))
    assert inside == joined and len(inside[0]) == 6 and len(inside[1]) == 5


def test_maximise_mode(spark):
    from kiln.operators import metrics as M
    h = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.6), (4, 0.7), (5, 0.9)], "epoch long, val_accuracy double")
    e = M.early_stop(h, "epoch", "val_accuracy", patience=2, mode="max").first()
    assert (e["stop_epoch"], e["best_epoch"], e["best_value"]) == (4, 5, 0.9)
    best = M.best_checkpoint(h, "epoch", "val_accuracy", mode="max").orderBy("epoch").collect()
    assert [(r["epoch"], r["is_best"]) for r in best] == [(1, False), (2, False), (5, True)]
    lr = M.lr_plateau(h, "epoch", "val_accuracy", lr0=1.0, patience=2, mode="max").orderBy("epoch").collect()
    assert [r["lr_next"] for r in lr] == [1.0, 1.0, 1.0, 0.5, 0.5]


def test_null_and_constant_vectors(spark):
    from kiln.functions import vectors as VX
    df = spark.createDataFrame([(1, [1.0, 3.0]), (2, None), (3, [0.1, 0.1]), (4, [0.0, 0.0]), (5, [])], "i long, v array<double>")
    got = {r["i"]: r["s"] for r in df.select("i", VX.vec_standardize_clip("v").alias("s")).collect()}
    assert got == {1: [64, 192], 2: None, 3: [128, 128], 4: [0, 0], 5: []}
    some = df.where("i < 5")
    out = {r["i"]: r["z"] for r in some.select("i", VX.dense_forward("v", [[1.0], [2.0]], [0.5]).alias("z")).collect()}
    assert out[2] is None and out[1] == [7.5]


def test_gram_sums_leave_out_incomplete_rows(spark):
    from kiln.operators import models as MD
    rows = [(0.1 * i, 1.0 - 0.2 * i) for i in range(10)]
    full = spark.createDataFrame(rows, "x double, y double")
    holes = spark.createDataFrame([*rows, (None, 1.0), (2.0, None), (None, None)], "x double, y double")
    a, b = (MD.gram_sums(d, ["x"], "y") for d in (full, holes))
    assert a.n == b.n == 10 and a.c == pytest.approx(b.c) and sum(a.a, []) == pytest.approx(sum(b.a, []))


def test_histogram_has_its_empty_buckets(spark):
    from kiln.operators import stats as ST
    h = ST.stats_histogram(spark.createDataFrame([(0.0,), (10.0,)], "x double"), "x", 10).orderBy("bucket").collect()
    assert [r["count"] for r in h] == [1, *[0] * 8, 1]


def test_callback_hooks(spark):
    from pyspark.sql import functions as F

    from kiln.operators.user import Callback, run_callbacks
    h = spark.createDataFrame([(1, 0.5), (2, 0.4)], "epoch long, loss double")
    b = spark.createDataFrame([(1, 0, 0.6), (1, 1, 0.4)], "epoch long, batch long, loss double")

    class Log(Callback):
        name = "log"

        def on_train_begin(self, history):
            return history.agg(F.min("epoch").alias("epoch"), F.lit(0.0).alias("value"))

        def on_batch_end(self, batches):
            return batches.select("epoch", F.col("loss").alias("value"))

        def on_epoch_end(self, history):
            return history.select("epoch", F.col("loss").alias("value"))
    got = sorted((r["epoch"], r["value"]) for r in run_callbacks(h, [Log()], b).collect())
    assert got == [(1, 0.0), (1, 0.4), (1, 0.5), (1, 0.6), (2, 0.4)]
    assert run_callbacks(h, [Callback()]).count() == 0


def test_split_takes_the_eval_fraction(spark):
    from kiln import api
    parts = api.split_positional(spark.range(100).toDF("k"), "k", (0.6, 0.1))
    assert [parts[x].count() for x in ("train", "eval", "serving")] == [60, 10, 30]


# ------------------------------------------------------------------------------ streaming over several files

def _day_files(spark, folder, days, start=0):
    for k, (day, values) in enumerate(days, start=start):
        rows = [(f"2024-01-{day:02d} 0{i}:00:00", float(v)) for i, v in enumerate(values)]
        (spark.createDataFrame(rows, "t string, value double").select(F.col("t").cast("timestamp").alias("ts"), "value")
         .coalesce(1).write.mode("append").parquet(f"{folder}"))


def test_stream_updates_restart_and_late_rows(spark, tmp_path):
    from kiln.streaming.twins import stream_window_metric
    folder, schema = str(tmp_path / "in"), "ts timestamp, value double"
    paths = (str(tmp_path / "out"), str(tmp_path / "ckpt"))
    run = lambda: {r["day"]: (r["n"], r["mean"]) for r in stream_window_metric(
        spark, folder, "*.parquet", spark.read.schema(schema).parquet(folder).schema, "ts", "value",
        watermark="1 day", files_per_trigger=1, mode="update", paths=paths).collect()}
    _day_files(spark, folder, [(1, [1, 3]), (2, [5])])
    assert run() == {"2024-01-01": (2, 2.0), "2024-01-02": (1, 5.0)}
    _day_files(spark, folder, [(2, [7])])                       # a restart goes on with the stored state
    assert run()["2024-01-02"] == (2, 6.0)
    _day_files(spark, folder, [(9, [2])])
    assert run()["2024-01-09"] == (1, 2.0)
    _day_files(spark, folder, [(1, [100])])                     # later than the watermark: dropped
    assert run()["2024-01-01"] == (2, 2.0)


def test_holdouts_at_their_limits(spark):
    from kiln.operators.split import holdout_head, holdout_tail
    df = spark.range(10).toDF("k")
    val = lambda d: sorted(r["k"] for r in d.where("role = 'val'").collect())
    assert val(holdout_head(df, "k", 3)) == [0, 1, 2] and val(holdout_tail(df, "k", 3)) == [7, 8, 9]
    assert val(holdout_head(df, "k", 0)) == [] == val(holdout_tail(df, "k", 0))
    assert val(holdout_head(df, "k", 10)) == list(range(10)) == val(holdout_tail(df, "k", 99))


def test_presence_of_features_without_other_statistics(spark):
    from kiln.operators import schema as S
    from kiln.operators import stats as ST
    from kiln.operators import validate as V
    full = spark.sql("SELECT id, id > 2 AS flag, date'2024-01-01' AS day, array(id) AS xs, binary('b') AS raw FROM range(8)")
    holes = spark.sql("SELECT id, IF(id > 3, true, NULL) AS flag, CAST(NULL AS date) AS day, array(id) AS xs, binary('b') AS raw FROM range(8)")
    schema = S.infer_schema(ST.profile(full))
    assert {r["feature"]: r["min_fraction"] for r in S.infer_schema(ST.profile(holes)).features.collect()} == {
        "id": 1.0, "flag": 0.0, "day": 0.0, "xs": 1.0, "raw": 1.0}
    bad = {r["feature"]: (r["anomaly"], r["value"]) for r in V.validate_presence(ST.profile(holes), schema).collect()}
    assert bad == {"flag": ("PRESENCE", 0.5), "day": ("PRESENCE", 0.0)}
    both = full.withColumn("split", F.lit("train"))
    assert V.validate_presence(ST.profile_splits(both, ("train",))["train"], schema).count() == 0


def test_positions_of_long_strings_with_outliers(spark):
    from collections import Counter

    from kiln.operators.position import with_position_and_count
    urls = [f"https://example.org/shared/path/to/item/{i * 7919 % 100_000:06d}" for i in range(4000)] + ["a", "zzz", None, ""]
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "u string, id long").repartition(5)
    for direction in ("asc", "desc"):
        out, _ = with_position_and_count(df, [("u", direction), "id"], buckets=16, keep_intervals=True)
        rows = out.select("id", "pos", "__kiln_b1", "__kiln_b2").collect()
        byte = lambda i: (urls[i] is not None, (urls[i] or "").encode())
        up = sorted(range(len(urls)), key=lambda i: (byte(i), i))
        want = up if direction == "asc" else sorted(range(len(urls)), key=lambda i: byte(i), reverse=True)
        assert [r["id"] for r in sorted(rows, key=lambda r: r["pos"])] == want
        assert max(Counter((r["__kiln_b1"], r["__kiln_b2"]) for r in rows).values()) <= 2 * len(urls) / 16


def test_fit_multi_output_scores_every_document(spark):
    from kiln.plans.fixtures import read
    from kiln.plans.q_training import q_fit_multi_output
    sf = "/root/testdata/sf0.001"
    ids = {r["doc_id"] for r in read(spark, sf, "documents").select("doc_id").collect()}
    assert read(spark, sf, "labels").count() < len(ids)
    got = q_fit_multi_output(spark, sf).collect()
    for target in ("quality", "toxic"):
        mine = [r for r in got if r["target"] == target]
        assert len(mine) == len(ids) and {r["doc_id"] for r in mine} == ids
        assert all(0 <= r["prob"] <= 1 for r in mine)
