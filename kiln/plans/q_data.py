"""Sources, sinks, slices, shuffles and batches."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from kiln.operators import split as SP
from kiln.plans.fixtures import DOCS_LABELLED_SQL, ORDERS_SPLIT_SQL, docs_labelled, orders_split, read
from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import io as IO
from kiln.sources import sinks as SK

PART_SCHEMA = ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
               "p_retailprice double")


@query("src_csv", "SELECT * FROM part")
def q_src_csv(spark, sf):
    path = scratch_path(spark, "part-csv")
    read(spark, sf, "part").write.option("header", True).csv(path)
    return IO.read_table(spark, path, PART_SCHEMA)


# Declared laptop feature spec (raw names and types of the laptop table).
LAPTOP_SPEC = {"Unname": "int64", "Company": "string", "TypeName": "string", "Inches": "float32",
               "Gpu": "string", "Price": "float32"}


@query("src_typed_parse", """
SELECT TRY_CAST(trim(' ' || CAST(p_partkey AS VARCHAR) || ' ') AS BIGINT) AS Unname,
       trim('  ' || p_brand || ' ') AS Company, trim(p_type) AS TypeName,
       TRY_CAST(trim(CAST((110 + p_size) // 10 AS VARCHAR) || '.' || CAST((110 + p_size) % 10 AS VARCHAR)) AS FLOAT) AS Inches,
       trim(' ' || p_name) AS Gpu,
       TRY_CAST(trim(CASE WHEN p_partkey % 23 = 0 THEN ' ' ELSE CAST(CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS VARCHAR)
            || '.' || lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END) AS FLOAT) AS Price
FROM part""")
def q_src_typed_parse(spark, sf):
    p = read(spark, sf, "part")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    raw = p.select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("Unname"),
        F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")).alias("Company"),
        F.col("p_type").alias("TypeName"),
        F.concat(F.floor((F.lit(110) + F.col("p_size")) / 10).cast("string"), F.lit("."),
                 ((F.lit(110) + F.col("p_size")) % 10).cast("string")).alias("Inches"),
        F.concat(F.lit(" "), F.col("p_name")).alias("Gpu"),
        F.when(F.col("p_partkey") % 23 == 0, F.lit(" ")).otherwise(
            F.concat(F.floor(cents / 100).cast("string"), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))).alias("Price"))
    return IO.apply_feature_spec(raw, LAPTOP_SPEC)


@query("src_labelled_files", """
SELECT lang AS class, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS class_index,
       (sum(strlen(text)) + count(*))::BIGINT AS total_bytes
FROM documents GROUP BY lang""")
def q_src_labelled_files(spark, sf):
    root = scratch_path(spark, "labelled")
    read(spark, sf, "documents").select("lang", "text").write.partitionBy("lang").text(root)
    files = IO.read_labelled_files(spark, root, glob="*.txt")
    return files.groupBy("class", "class_index").agg(F.sum("length").cast("bigint").alias("total_bytes"))


# quality -1 marks a document without a label (kept out of nullable integer columns).
@query("src_paired_files", """
SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality,
       CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'paired' END AS status
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
UNION ALL
SELECT l.doc_id, NULL, l.quality, 'right_only' FROM labels l WHERE l.doc_id NOT IN (SELECT doc_id FROM documents)""")
def q_src_paired_files(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "lang")
    labs = read(spark, sf, "labels").select("doc_id", "quality")
    return IO.pair_table(docs, labs, "doc_id").withColumn("quality", F.coalesce("quality", F.lit(-1)))


def _box_muller_sql(key: str, seed: int, mean, cov) -> tuple[str, str]:
    u = lambda s: f"((('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{s}'), 1, 8))::BIGINT + 1) / 4294967296.0)"
    r = f"sqrt(-2.0 * ln({u(seed)}))"
    z0 = f"({r} * cos({2 * math.pi!r} * {u(seed + 1)}))"
    z1 = f"({r} * sin({2 * math.pi!r} * {u(seed + 1)}))"
    l00 = math.sqrt(cov[0][0])
    l10 = cov[0][1] / l00
    l11 = math.sqrt(cov[1][1] - l10 * l10)
    return (f"({mean[0]!r} + {l00!r} * {z0})", f"({mean[1]!r} + {l10!r} * {z0} + {l11!r} * {z1})")


# Two-class correlated normal sample (fixed values): class means and shared covariance.
CLASS_MEANS = {0: (0.0, 3.0), 1: (3.0, 0.0)}
CLASS_COV = ((1.0, 0.5), (0.5, 1.0))


def synth_points(spark, sf):
    """One 2-D point per lineitem row; class from the line number's parity."""
    li = read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_id"),
        (F.col("l_linenumber") % 2).alias("label"))
    # one pass for both classes: the mean is picked per row
    of = lambda i: F.when(F.col("label") == 0, CLASS_MEANS[0][i]).otherwise(CLASS_MEANS[1][i])
    return IO.synth_normal(li, "point_id", (of(0), of(1)), CLASS_COV, seed=7)


def _synth_sql(rounded: bool = True) -> str:
    sel = []
    for cls, mean in CLASS_MEANS.items():
        x0, x1 = _box_muller_sql("point_id", 7, mean, CLASS_COV)
        if rounded:
            x0, x1 = f"round(round({x0}, 9), 6)", f"round(round({x1}, 9), 6)"
        sel.append(f"SELECT point_id, label, {x0} AS x0, {x1} AS x1 FROM li WHERE label = {cls}")
    return ("WITH li AS (SELECT l_orderkey * 8 + l_linenumber AS point_id, l_linenumber % 2 AS label FROM lineitem) "
            + " UNION ALL ".join(sel))


@query("src_synth_normal", _synth_sql())
def q_src_synth_normal(spark, sf):
    pts = synth_points(spark, sf)
    return pts.select("point_id", "label", rnd("x0", 6).alias("x0"), rnd("x1", 6).alias("x1"))


@query("src_synth_uniform", """
SELECT o_orderkey,
       round((('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|11'), 1, 8))::BIGINT) / 4294967296.0, 9) AS u0,
       round((('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|12'), 1, 8))::BIGINT) / 4294967296.0, 9) AS u1,
       CAST((('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|21'), 1, 8))::BIGINT) / 4294967296.0 < 0.5 AS INTEGER) AS t0
FROM orders""")
def q_src_synth_uniform(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey")
    u = IO.synth_uniform(o, "o_orderkey", 2, seed=11, prefix="u")
    t = IO.synth_uniform(u, "o_orderkey", 1, seed=21, prefix="t", binary=True)
    return t.select("o_orderkey", rnd("u0", 9).alias("u0"), rnd("u1", 9).alias("u1"), "t0")


# ------------------------------------------------------------------------------------ sinks

@query("sink_splits", "WITH " + ORDERS_SPLIT_SQL + "SELECT o_orderkey, o_totalprice, split FROM osplit")
def q_sink_splits(spark, sf):
    path = scratch_path(spark, "splits")
    SK.write_splits(orders_split(spark, sf).select("o_orderkey", "o_totalprice", "split"), path)
    return SK.read_splits(spark, path).select("o_orderkey", "o_totalprice", "split")


@query("sink_features", """
SELECT vec_id, label, round(round(list_avg(embedding)::DOUBLE, 9), 6) AS mean_activation FROM embeddings""")
def q_sink_features(spark, sf):
    from kiln.functions.vectors import vec_mean
    emb = read(spark, sf, "embeddings")
    feats = emb.select("vec_id", "label", vec_mean("embedding").alias("mean_activation"))
    stored = SK.write_features(feats, scratch_path(spark, "features"))
    return stored.select("vec_id", "label", rnd("mean_activation", 6).alias("mean_activation"))


# ------------------------------------------------------------------------------------ slices

@query("slice_head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def q_slice_head(spark, sf):
    return SP.slice_head(read(spark, sf, "orders"), "o_orderkey", 10)


@query("slice_range_by_class", """
SELECT vec_id, label, class_pos FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS class_pos FROM embeddings)
WHERE class_pos >= 5 AND class_pos < 15""")
def q_slice_range_by_class(spark, sf):
    emb = read(spark, sf, "embeddings").select("vec_id", "label")
    return SP.slice_range_by_class(emb, "label", "vec_id", 5, 15)


@query("slice_holdout_head", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < 100 THEN 'val' ELSE 'train' END AS role
FROM documents""")
def q_slice_holdout_head(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id")
    return SP.holdout_head(docs, "doc_id", 100).select("doc_id", "role")


@query("slice_holdout_tail", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 >= count(*) OVER ()
                             - CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT) THEN 'val' ELSE 'train' END AS role
FROM orders""")
def q_slice_holdout_tail(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey")
    return SP.holdout_tail(o, "o_orderkey", fraction=0.2).select("o_orderkey", "role")


@query("null_counts", "WITH " + DOCS_LABELLED_SQL + """
SELECT 'doc_id' AS column, count(*) FILTER (WHERE doc_id IS NULL) AS n_null FROM docs
UNION ALL SELECT 'text', count(*) FILTER (WHERE text IS NULL) FROM docs
UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM docs
UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE n_chars IS NULL) FROM docs
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM docs
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM docs""")
def q_null_counts(spark, sf):
    return SP.null_counts(docs_labelled(spark, sf))


@query("concat_rows", """
SELECT c_custkey AS party_key, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def q_concat_rows(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_acctbal").alias("acctbal"),
                                          F.lit("customer").alias("kind"))
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_acctbal").alias("acctbal"),
                                          F.lit("supplier").alias("kind"))
    return SP.concat_rows(c, s)


@query("shuffle_seeded", """
SELECT o_orderkey, o_totalprice, row_number() OVER (
  ORDER BY ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8))::BIGINT, o_orderkey) - 1 AS shuffle_pos
FROM orders""")
def q_shuffle_seeded(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SP.shuffle_seeded(o, "o_orderkey", seed=42)


@query("batch_assign", """
SELECT vec_id, label, (row_number() OVER (ORDER BY vec_id) - 1) // 32 AS batch_id FROM embeddings""")
def q_batch_assign(spark, sf):
    emb = read(spark, sf, "embeddings").select("vec_id", "label")
    return SP.batch_assign(emb, "vec_id", 32).select("vec_id", "label", "batch_id")
