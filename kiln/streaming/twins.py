"""Structured Streaming twins of the incremental operators.

Both read a folder of Parquet files as a stream, aggregate with state, and publish every micro-batch
through ``foreachBatch`` to the shared scratch folder. ``complete`` mode overwrites the full result,
which keeps every window's state; ``update`` mode stores only the keys that a batch changed, one
folder per batch, and the published result is each key's latest row – state is bounded by the
watermark, and rows later than it are dropped. Both are idempotent per batch, so a restarted query
publishes the same. Run with ``trigger(availableNow=True)`` they give the batch answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import scratch_path


def event_time(ts: str, spark: SparkSession) -> Column:
    """Event time as an instant whose UTC wall clock equals the stored wall clock.

    Timestamps without a zone cannot carry a watermark; casting them applies the session zone,
    which ``from_utc_timestamp`` undoes, so windows start at the data's own midnight whatever the
    session zone is.
    """
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz)


def file_stream(spark: SparkSession, folder: str, glob: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def _latest(spark: SparkSession, out: str, keys: list[str], schema) -> DataFrame:
    """Each key's row of the last batch that changed it."""
    rows = spark.read.schema(schema.add("batch_id", "long")).parquet(out)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("__v"))
    return last.select(*keys, "__v.*")


def _publish(agg: DataFrame, name: str, callbacks: list | None = None, keys: list[str] | None = None,
             mode: str = "complete", paths: tuple[str, str] | None = None) -> DataFrame:
    """Run ``agg`` to the end of the available input, publishing every micro-batch. ``paths`` (output,
    checkpoint) continue an earlier run; by default both are new.

    ``callbacks`` are user hooks ``fn(result, batch_id) -> DataFrame | None`` run on each published
    result (the streaming form of epoch-end callbacks); what they return is stored next to the
    output, partitioned by batch id (``<out>-callbacks/batch_id=N``).
    """
    spark = agg.sparkSession
    out, ckpt = paths or (scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt"))
    schema = agg.schema

    def published() -> DataFrame:
        return _latest(spark, out, keys, T.StructType(list(schema.fields))) if mode == "update" else spark.read.parquet(out)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}" if mode == "update" else out)
        for cb in callbacks or []:
            events = cb(published(), batch_id)
            if events is not None:
                # one folder per batch, overwritten: a replayed batch after a restart writes the same rows
                events.write.mode("overwrite").parquet(f"{out}-callbacks/batch_id={batch_id}")

    q = (agg.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return published()


def stream_window_metric(spark: SparkSession, folder: str, glob: str, schema, ts: str, value: str,
                         window: str = "1 day", watermark: str = "1 day", callbacks: list | None = None,
                         files_per_trigger: int = 1000, mode: str = "complete",
                         paths: tuple[str, str] | None = None) -> DataFrame:
    """Metric per tumbling window (the reset period): count and mean of ``value``.

    Output: (day, n, mean) with ``day`` the window start as a date string.
    """
    src = file_stream(spark, folder, glob, schema, files_per_trigger).withColumn("__et", event_time(ts, spark))
    agg = (src.withWatermark("__et", watermark).groupBy(F.window("__et", window).alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(value).cast("double")).alias("mean")))
    day = F.date_add(F.lit("1970-01-01").cast("date"),
                     F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int")).cast("string")
    return _publish(agg.select(day.alias("day"), "n", "mean"), "stream-metric", callbacks, ["day"], mode, paths)


def stream_regression(spark: SparkSession, folder: str, glob: str, schema, ts: str, value: str) -> DataFrame:
    """Closed-form least-squares line of ``value`` against event time in days, updated as rows
    arrive: (n, slope, intercept)."""
    src = file_stream(spark, folder, glob, schema).withColumn("__et", event_time(ts, spark))
    x = F.unix_micros("__et") / F.lit(86400e6)
    agg = src.select(x.alias("x"), F.col(value).cast("double").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
    return _publish(agg, "stream-regression")
