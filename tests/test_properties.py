"""Cross-cutting properties: stream equals batch; results do not depend on the partition count."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import rows_of

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def test_stream_equals_batch(spark):
    got = QUERIES["stream_metric"](spark, SF).toPandas()
    ev = spark.read.parquet(f"{SF}/events.parquet")
    want = (ev.groupBy(F.to_date("ts").cast("string").alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
            .select("day", "n", F.round("mean", 6).alias("mean")).toPandas())
    assert rows_of(got, 6) == rows_of(want, 6)


@pytest.mark.parametrize("key", ["split_positional", "shuffle_seeded", "vocab_build", "metric_running",
                                 "encode_tokens", "preprocess_flow", "drift_linf", "slice_range_by_class"])
def test_same_result_for_any_partition_count(spark, key):
    results = []
    for parts in (1, 3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            results.append(rows_of(QUERIES[key](spark, SF).toPandas(), 6))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_stream_callbacks_run_per_batch(spark):
    import glob
    import os

    from kiln.streaming.twins import stream_window_metric
    seen = []

    def busiest_day(result, batch_id):
        seen.append(batch_id)
        return result.orderBy(F.col("n").desc(), F.col("day")).limit(1).select("day", "n")

    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    out = stream_window_metric(spark, SF, "events.parquet", schema, "ts", "value", callbacks=[busiest_day])
    assert seen == [0]
    paths = out.inputFiles()
    folder = os.path.dirname(paths[0].replace("file:", ""))
    events = spark.read.parquet(folder + "-callbacks")
    assert events.count() == 1 and set(events.columns) == {"day", "n", "batch_id"}
    assert glob.glob(folder + "-callbacks/batch_id=0/*.parquet")


def test_value_frequencies_sum_to_one_and_histogram_covers_rows(spark):
    from kiln.operators import stats as ST
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    freq = ST.stats_value_freq(orders, ["o_orderstatus", "o_orderpriority"])
    tot = {r["feature"]: r["t"] for r in freq.groupBy("feature").agg(F.sum("count").alias("t")).collect()}
    assert tot == {"o_orderstatus": orders.count(), "o_orderpriority": orders.count()}
    p = freq.join(freq.groupBy("feature").agg(F.sum("count").alias("t")), "feature")
    sums = [r["s"] for r in p.groupBy("feature").agg(F.sum(F.col("count") / F.col("t")).alias("s")).collect()]
    assert all(abs(s - 1.0) < 1e-12 for s in sums)
    h = ST.stats_histogram(orders, "o_totalprice", 10)
    assert h.agg(F.sum("count")).first()[0] == orders.count() and h.count() <= 10
