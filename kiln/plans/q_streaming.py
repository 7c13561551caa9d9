"""Streaming twins over the events table (file source, availableNow, complete mode)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import table_path
from kiln.streaming.online import stream_online_regression
from kiln.streaming.twins import stream_regression, stream_window_metric


def _schema(spark, sf):
    return spark.read.parquet(table_path(sf, "events")).schema   # footer only


@query("stream_metric", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(round(avg(value), 9), 6) AS mean FROM events GROUP BY 1""")
def q_stream_metric(spark, sf):
    out = stream_window_metric(spark, sf, "events.parquet", _schema(spark, sf), "ts", "value")
    return out.select("day", "n", rnd("mean", 6).alias("mean"))


@query("stream_regression", """
SELECT count(*) AS n, round(round(regr_slope(value, epoch_us(ts) / 86400e6), 9), 6) AS slope,
       round(round(regr_intercept(value, epoch_us(ts) / 86400e6), 9), 4) AS intercept FROM events""")
def q_stream_regression(spark, sf):
    out = stream_regression(spark, sf, "events.parquet", _schema(spark, sf), "ts", "value")
    return out.select("n", rnd("slope", 6).alias("slope"), rnd("intercept", 4).alias("intercept"))


@query("stream_online", """
WITH RECURSIVE p AS (SELECT event_type AS key, row_number() OVER w AS n, (epoch_us(ts) % 86400000000) / 86400e6 AS x, value / 100 AS y FROM events
                     WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
s AS MATERIALIZED (SELECT key, n, sum(x) OVER w AS sx, sum(y) OVER w AS sy, sum(x * x) OVER w AS sxx, sum(x * y) OVER w AS sxy FROM p
      WINDOW w AS (PARTITION BY key ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
line(key, n, slope, intercept) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 0.0::DOUBLE, 0.0::DOUBLE FROM s
  UNION ALL
  SELECT s.key, s.n, l.slope - 0.2 * (2 * (l.slope * sxx + l.intercept * sx - sxy) / s.n),
         l.intercept - 0.2 * (2 * (l.slope * sx + l.intercept * s.n - sy) / s.n)
  FROM line l JOIN s ON s.key = l.key AND s.n = l.n + 1)
SELECT key, n, round(round(slope, 9), 6) AS slope, round(round(intercept, 9), 6) AS intercept FROM line
QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC) = 1""")
def q_stream_online(spark, sf):
    """Value by time of day, a line per event type, one descent step per arrival."""
    x = F.pmod(F.unix_micros("__et"), F.lit(86400000000)) / F.lit(86400e6)
    out = stream_online_regression(spark, sf, "events.parquet", _schema(spark, sf), "ts", "event_type", "event_id", x, F.col("value") / 100)
    return out.select("key", "n", rnd("slope", 6).alias("slope"), rnd("intercept", 6).alias("intercept"))
