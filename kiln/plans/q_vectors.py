"""Vector-column queries on embeddings (8×8 = 64 floats, label 0-9) and 2-D points from lineitem."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from kiln.functions import vectors as VX
from kiln.operators.products import dot_products
from kiln.plans.fixtures import read
from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import cut_lineage

MAX_CENTROIDS = 4_096    # centroids that travel as literals; more are met block by block


def _long(df, key, arr, out="value", digits=6):
    return df.select(key, F.posexplode(arr).alias("pos", out)).select(
        key, F.col("pos").cast("bigint").alias("pos"),
        rnd(F.col(out).cast("double"), digits).alias(out) if digits is not None else F.col(out))


UNNEST = "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS x FROM embeddings"


@query("vec_rescale", f"SELECT vec_id, pos::BIGINT AS pos, round(round(x::DOUBLE / 255.0, 9), 6) AS value FROM ({UNNEST})")
def q_vec_rescale(spark, sf):
    emb = read(spark, sf, "embeddings")
    return _long(emb.select("vec_id", VX.vec_rescale("embedding", 255.0).alias("v")), "vec_id", "v")


@query("vec_flatten", f"SELECT vec_id, pos::BIGINT AS pos, round(round(x::DOUBLE, 9), 6) AS value FROM ({UNNEST})")
def q_vec_flatten(spark, sf):
    emb = read(spark, sf, "embeddings")
    grid = emb.select("vec_id", VX.vec_reshape("embedding", 8, 8).alias("g"))
    return _long(grid.select("vec_id", VX.vec_flatten("g").alias("v")), "vec_id", "v")


@query("vec_concat", """
SELECT vec_id, CAST(len(embedding) + 64 AS BIGINT) AS n_values,
       round(round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 9), 4) AS total,
       round(round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 9), 4) AS sumsq
FROM embeddings""")
def q_vec_concat(spark, sf):
    emb = read(spark, sf, "embeddings")
    v = emb.select("vec_id", VX.vec_concat("embedding", VX.zeros(64)).alias("v"))
    return v.select("vec_id", F.size("v").cast("bigint").alias("n_values"), rnd(VX.vec_sum("v"), 4).alias("total"),
                    rnd(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 4).alias("sumsq"))


@query("vec_standardize_clip", f"""
WITH u AS ({UNNEST}),
s AS (SELECT vec_id, sum(x::DOUBLE) AS sx, avg(x::DOUBLE) AS m, stddev_pop(x::DOUBLE) AS sd FROM u GROUP BY vec_id)
SELECT u.vec_id, u.pos::BIGINT AS pos,
       CAST(trunc(least(greatest(CASE WHEN s.sx <> 0 THEN (x::DOUBLE - s.m) / s.sd * 64.0 + 128.0 ELSE x::DOUBLE END,
                                 0.0), 255.0)) AS INTEGER) AS value
FROM u JOIN s ON u.vec_id = s.vec_id""")
def q_vec_standardize_clip(spark, sf):
    emb = read(spark, sf, "embeddings")
    return _long(emb.select("vec_id", VX.vec_standardize_clip("embedding").alias("v")), "vec_id", "v", digits=None)


@query("vec_mean", "SELECT vec_id, label, round(round(list_avg(list_transform(embedding, lambda x: x::DOUBLE)), 9), 6) AS mean FROM embeddings")
def q_vec_mean(spark, sf):
    emb = read(spark, sf, "embeddings")
    return emb.select("vec_id", "label", rnd(VX.vec_mean("embedding"), 6).alias("mean"))


def dense_weights(in_dim: int = 64, out_dim: int = 10):
    """Deterministic scoring weights built from a rule: W[i][j] = 0.1*sin(10*i + j), b[j] = 0.01*j."""
    w = [[0.1 * math.sin(10 * i + j) for j in range(out_dim)] for i in range(in_dim)]
    b = [0.01 * j for j in range(out_dim)]
    return w, b


@query("dense_forward", f"""
WITH u AS ({UNNEST}),
w AS (SELECT i, j, 0.1 * sin(10 * i + j) AS w FROM range(64) t(i), range(10) s(j)),
z AS (SELECT u.vec_id, w.j, sum(u.x::DOUBLE * w.w) + 0.01 * w.j AS z FROM u JOIN w ON u.pos = w.i GROUP BY u.vec_id, w.j),
p AS (SELECT vec_id, j, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
q AS (SELECT vec_id, j, e / sum(e) OVER (PARTITION BY vec_id) AS prob FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, j) AS rk FROM q)
SELECT vec_id, CAST(j AS INTEGER) AS pred_class, round(round(prob, 9), 6) AS top_prob FROM r WHERE rk = 1""")
def q_dense_forward(spark, sf):
    emb = read(spark, sf, "embeddings")
    w, b = dense_weights()
    p = emb.select("vec_id", VX.dense_forward("embedding", w, b, "softmax").alias("p"))
    return p.select("vec_id", VX.argmax("p").alias("pred_class"), rnd(F.array_max("p"), 6).alias("top_prob"))


# Rotation angle, translation and scale of the 2-D point transforms (fixed values).
THETA = math.pi / 6
SHIFT = (1.0, -2.0)
SCALE = (2.0, 0.5)
AFFINE_M = ((1.0, 0.5), (-0.5, 1.0))


@query("geom_transform", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice / 1000.0 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(round(x + {SHIFT[0]!r}, 9), 6) AS tx, round(round(y + {SHIFT[1]!r}, 9), 6) AS ty,
       round(round(x * {math.cos(THETA)!r} - y * {math.sin(THETA)!r}, 9), 6) AS rx,
       round(round(x * {math.sin(THETA)!r} + y * {math.cos(THETA)!r}, 9), 6) AS ry,
       round(round(x * {SCALE[0]!r}, 9), 6) AS sx, round(round(y * {SCALE[1]!r}, 9), 6) AS sy,
       round(round(x * {AFFINE_M[0][0]!r} + y * {AFFINE_M[0][1]!r} + {SHIFT[0]!r}, 9), 6) AS ax,
       round(round(x * {AFFINE_M[1][0]!r} + y * {AFFINE_M[1][1]!r} + {SHIFT[1]!r}, 9), 6) AS ay
FROM p""")
def q_geom_transform(spark, sf):
    li = read(spark, sf, "lineitem")
    x, y = F.col("l_quantity"), F.col("l_extendedprice") / F.lit(1000.0)
    tx, ty = VX.translate(x, y, *SHIFT)
    rx, ry = VX.rotate(x, y, THETA)
    sx, sy = VX.scale(x, y, *SCALE)
    ax, ay = VX.linear_map(x, y, AFFINE_M, SHIFT)
    r = lambda c, n: rnd(c, 6).alias(n)
    return li.select("l_orderkey", "l_linenumber", r(tx, "tx"), r(ty, "ty"), r(rx, "rx"), r(ry, "ry"),
                     r(sx, "sx"), r(sy, "sy"), r(ax, "ax"), r(ay, "ay"))


CENTROIDS_SQL = f"""
u AS ({UNNEST}),
lab AS (SELECT vec_id, label FROM embeddings),
cent AS (SELECT label AS centroid, pos, avg(x::DOUBLE) AS c FROM u JOIN lab USING (vec_id) GROUP BY label, pos)
"""


@query("pairwise_dot", "WITH " + CENTROIDS_SQL + """
SELECT u.vec_id, CAST(cent.centroid AS INTEGER) AS centroid, round(round(sum(u.x::DOUBLE * cent.c), 9), 4) AS dot
FROM u JOIN cent ON u.pos = cent.pos GROUP BY u.vec_id, cent.centroid""")
def q_pairwise_dot(spark, sf):
    """A·Bᵀ with A = every embedding and B = the per-label centroids (one row per label, size-checked)."""
    emb = read(spark, sf, "embeddings")
    cents = _centroids(emb)
    if cents.limit(MAX_CENTROIDS + 1).count() > MAX_CENTROIDS:      # a right side of any size: block by block
        d = dot_products(emb, "vec_id", "embedding", cents, "label", "c")
        return d.select(F.col("a").alias("vec_id"), F.col("b").cast("int").alias("centroid"), rnd("dot", 4).alias("dot"))
    rows = cents.orderBy("label").collect()   # B is one vector per class: bounded by the class count
    labels = [r["label"] for r in rows]
    d = VX.dot_rows(emb.select("vec_id", "embedding"), "embedding", [r["c"] for r in rows])
    return d.select("vec_id", F.posexplode("dots").alias("i", "dot")).select(
        "vec_id", F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("i") + 1).cast("int").alias("centroid"),
        rnd("dot", 4).alias("dot"))


def _centroids(emb):
    """Mean vector per label: posexplode + avg per (label, pos), regrouped in position order."""
    per = (emb.select("label", F.posexplode("embedding").alias("pos", "x"))
           .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m")))
    cents = per.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("s")).select(
        "label", F.transform("s", lambda t: t["m"]).alias("c"))
    return cut_lineage(cents)                  # one vector per class, read twice


@query("top_dot", f"""
WITH u AS ({UNNEST}), d AS (SELECT a.vec_id AS a, b.vec_id AS b, sum(a.x::DOUBLE * b.x::DOUBLE) AS dot FROM u a JOIN u b ON a.pos = b.pos GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(dot, 9) DESC, b) AS rank FROM d)
SELECT a AS vec_id, b AS other, CAST(rank AS INTEGER) AS rank, round(round(dot, 9), 6) AS dot FROM r WHERE rank <= 3""")
def q_top_dot(spark, sf):
    """The three largest products of every embedding with all embeddings (its own included)."""
    emb = read(spark, sf, "embeddings")
    d = dot_products(emb, "vec_id", "embedding", emb, "vec_id", "embedding", k=3)
    return d.select(F.col("a").alias("vec_id"), F.col("b").alias("other"), "rank", rnd("dot", 6).alias("dot"))


@query("argmax_class", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings")
def q_argmax_class(spark, sf):
    emb = read(spark, sf, "embeddings")
    return emb.select("vec_id", VX.argmax("embedding").alias("argmax"))


@query("threshold_class", """
SELECT vec_id, round(round(1.0 / (1.0 + exp(-embedding[1]::DOUBLE)), 9), 6) AS score,
       CAST(1.0 / (1.0 + exp(-embedding[1]::DOUBLE)) > 0.5 AS INTEGER) AS pred FROM embeddings""")
def q_threshold_class(spark, sf):
    emb = read(spark, sf, "embeddings")
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.element_at("embedding", 1).cast("double")))
    return emb.select("vec_id", rnd(s, 6).alias("score"), VX.threshold_class(s, 0.5).alias("pred"))

