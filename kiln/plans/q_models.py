"""Queries of the coefficient-only descent (SQL twin via a recursive CTE); the networks are in ``q_training``."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import models as MD
from kiln.plans.q_data import _synth_sql, synth_points
from kiln.plans.present import rnd
from kiln.plans.registry import query

GD_SQL = ("WITH RECURSIVE pts AS (" + _synth_sql(rounded=False).replace("WITH li AS", "SELECT * FROM (WITH li AS", 1) + """)),
s AS (SELECT count(*)::DOUBLE AS n, sum(x0) AS s0, sum(x1) AS s1, sum(x0 * x0) AS s00, sum(x0 * x1) AS s01,
             sum(x1 * x1) AS s11, sum(label::DOUBLE) AS sy, sum(x0 * label) AS s0y, sum(x1 * label) AS s1y,
             sum(label * label)::DOUBLE AS syy, min(x0) AS lo, max(x0) AS hi FROM pts),
gd(step, w0, w1, b, loss) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE
  UNION ALL
  SELECT step + 1,
         w0 - 0.1 * (2 * (s00 * w0 + s01 * w1 + s0 * b - s0y) / n),
         w1 - 0.1 * (2 * (s01 * w0 + s11 * w1 + s1 * b - s1y) / n),
         b - 0.1 * (2 * (s0 * w0 + s1 * w1 + n * b - sy) / n),
         (w0 * (s00 * w0 + s01 * w1 + s0 * b) + w1 * (s01 * w0 + s11 * w1 + s1 * b) + b * (s0 * w0 + s1 * w1 + n * b)
          - 2 * (w0 * s0y + w1 * s1y + b * sy) + syy) / n
  FROM gd, s WHERE step < 40)
""")


@query("linear_gd", GD_SQL + """
SELECT CAST(step AS INTEGER) AS step, round(round(loss, 9), 6) AS loss, round(round(w0, 9), 6) AS w_x0, round(round(w1, 9), 6) AS w_x1, round(round(b, 9), 6) AS b
FROM gd WHERE step > 0""")
def q_linear_gd(spark, sf):
    h = MD.linear_gd(synth_points(spark, sf), ["x0", "x1"], "label", lr=0.1, steps=40)
    return h.select("step", *[rnd(c, 6).alias(c) for c in ["loss", "w_x0", "w_x1", "b"]])


@query("decision_boundary", GD_SQL + """,
last AS (SELECT w0, w1, b FROM gd WHERE step = 40),
grid AS (SELECT i, lo + i * ((hi - lo) / 49) AS x FROM range(50) t(i), s)
SELECT CAST(i AS BIGINT) AS i, round(round(x, 9), 6) AS x, round(round(-(w0 / w1) * x + (0.5 - b) / w1, 9), 6) AS y FROM grid, last""")
def q_decision_boundary(spark, sf):
    g = MD.gram_sums(synth_points(spark, sf), ["x0", "x1"], "label")
    *_, w0, w1, b = MD.linear_gd_from_sums(g, 0.1, 40)[-1]
    lo, hi = g.low[0], g.high[0]               # from the same pass as the sums
    d = MD.decision_boundary(spark, [w0, w1], b, lo, hi, 50)
    return d.select("i", rnd("x", 6).alias("x"), rnd("y", 6).alias("y"))
