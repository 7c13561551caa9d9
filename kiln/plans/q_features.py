"""Feature-engineering queries: string parsers, analyzers and the full laptop flow (part stand-in)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import scalar as X
from kiln.operators.analyze import analyze, vocab_apply, vocab_build, zscore_expr
from kiln.operators.split import split_hash, splits_of
from kiln.plans.fixtures import LAPTOP_RAW_SQL, laptop_raw, read
from kiln.plans.flows import INCH_EDGES, SCREEN_FLAGS, laptop_analyze, laptop_flow
from kiln.plans.present import rnd
from kiln.plans.registry import query

L = "WITH " + LAPTOP_RAW_SQL


def _storage_sql(kind: str) -> str:
    return ("coalesce(list_sum(list_transform(string_split(lower(trim(Memory)), ' + '), lambda p: "
            f"CASE WHEN contains(p, '{kind}') THEN coalesce(TRY_CAST(regexp_extract(p, '([0-9.]+)', 1) AS DOUBLE), 0.0)"
            " * CASE WHEN contains(p, 'tb') THEN 1024.0 ELSE 1.0 END ELSE 0.0 END)), 0.0)")


# DuckDB twins of the parsers, on the raw laptop columns.
SQLX = {
    "company": "CASE WHEN length(trim(lower(Company))) > 0 THEN trim(lower(Company)) ELSE 'UNKNOWN_COMPANY' END",
    "ssd": _storage_sql("ssd"),
    "hdd": _storage_sql("hdd"),
    "flash": _storage_sql("flash"),
    "ram": "TRY_CAST(trim(replace(lower(Ram), 'gb', '')) AS DOUBLE)",
    "opsys": ("CASE WHEN contains(trim(lower(OpSys)), 'windows') THEN 'windows' "
              "WHEN contains(trim(lower(OpSys)), 'mac') THEN 'macos' ELSE trim(lower(OpSys)) END"),
    "typename": "trim(lower(TypeName))",
    "width": r"TRY_CAST(regexp_extract(trim(lower(ScreenResolution)), '(\d{3,5})x(\d{3,5})', 1) AS DOUBLE)",
    "height": r"TRY_CAST(regexp_extract(trim(lower(ScreenResolution)), '(\d{3,5})x(\d{3,5})', 2) AS DOUBLE)",
    "cpu_brand": "CASE WHEN contains(trim(lower(Cpu)), 'intel') THEN 'intel' ELSE 'amd' END",
    "cpu_family": r"regexp_replace(regexp_replace(trim(lower(Cpu)), '^(intel|amd)\s+', ''), '\s+\d.*', '')",
    "clock": r"TRY_CAST(regexp_extract(trim(lower(Cpu)), '([\d.]+)\s*ghz', 1) AS FLOAT)",
    "gpu_brand": "coalesce(string_split(trim(lower(Gpu)), ' ')[1], '')",
    "gpu_model": "coalesce(string_split(trim(lower(Gpu)), ' ')[2], '')",
    "inches_bucket": ("CAST(CASE WHEN Inches::DOUBLE < 14.0 THEN 0.0 WHEN Inches::DOUBLE < 15.6 THEN 1.0 "
                      "ELSE 2.0 END AS FLOAT)"),
    "weight": "TRY_CAST(trim(replace(lower(Weight), 'kg', '')) AS DOUBLE)",
    "price": "Price::DOUBLE",
}
SQLX["total"] = f"({SQLX['ssd']} + {SQLX['hdd']} + {SQLX['flash']})"
FLAG_SQL = {k: f"CAST(contains(trim(lower(ScreenResolution)), '{v}') AS FLOAT)" for k, v in SCREEN_FLAGS.items()}


def _r(c, d=6):
    return rnd(F.col(c), d).alias(c)


# ------------------------------------------------------------------------------------ parsers

@query("str_lower_trim", L + f"SELECT Unname, {SQLX['typename']} AS typename, trim(lower(Company)) AS company FROM laptop")
def q_str_lower_trim(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", X.lower_trim("TypeName").alias("typename"), X.lower_trim("Company").alias("company"))


@query("str_default", L + f"SELECT Unname, {SQLX['company']} AS company FROM laptop")
def q_str_default(spark, sf):
    return laptop_raw(spark, sf).select("Unname", X.default_if_empty("Company").alias("company"))


@query("parse_storage", L + f"""SELECT Unname, Memory, {SQLX['ssd']} AS ssd_gb, {SQLX['hdd']} AS hdd_gb,
       {SQLX['flash']} AS flash_gb, {SQLX['total']} AS total_storage_gb FROM laptop""")
def q_parse_storage(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", "Memory", X.parse_storage(F.trim("Memory")).alias("s")).select("Unname", "Memory", "s.*")


@query("parse_unit", L + f"SELECT Unname, {SQLX['ram']} AS ram_gb, {SQLX['weight']} AS weight_kg FROM laptop")
def q_parse_unit(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", X.parse_unit("Ram", "gb").alias("ram_gb"), X.parse_unit("Weight", "kg").alias("weight_kg"))


@query("map_os", L + f"SELECT Unname, {SQLX['opsys']} AS opsys FROM laptop")
def q_map_os(spark, sf):
    return laptop_raw(spark, sf).select("Unname", X.map_os("OpSys").alias("opsys"))


@query("parse_resolution", L + f"SELECT Unname, {SQLX['width']} AS width, {SQLX['height']} AS height FROM laptop")
def q_parse_resolution(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", X.parse_resolution("ScreenResolution").alias("r")).select("Unname", "r.*")


@query("flag_contains", L + "SELECT Unname, " + ", ".join(f"{v} AS {k}" for k, v in FLAG_SQL.items()) + " FROM laptop")
def q_flag_contains(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", *[X.flag_contains("ScreenResolution", kw).alias(k) for k, kw in SCREEN_FLAGS.items()])


@query("parse_cpu", L + f"""SELECT Unname, {SQLX['cpu_brand']} AS brand, {SQLX['cpu_family']} AS family,
       {SQLX['clock']} AS clock_ghz FROM laptop""")
def q_parse_cpu(spark, sf):
    return laptop_raw(spark, sf).select("Unname", X.parse_cpu("Cpu").alias("c")).select("Unname", "c.*")


@query("token_at", L + f"""SELECT Unname, {SQLX['gpu_brand']} AS gpu_brand, {SQLX['gpu_model']} AS gpu_model,
       coalesce(string_split(trim(lower(Gpu)), ' ')[3], '') AS gpu_extra FROM laptop""")
def q_token_at(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", X.token_at("Gpu", 0).alias("gpu_brand"), X.token_at("Gpu", 1).alias("gpu_model"),
                      X.token_at("Gpu", 2).alias("gpu_extra"))


@query("bucketize", L + f"SELECT Unname, Inches, {SQLX['inches_bucket']} AS inches_bucket FROM laptop")
def q_bucketize(spark, sf):
    lap = laptop_raw(spark, sf)
    return lap.select("Unname", "Inches", X.bucketize(F.col("Inches"), INCH_EDGES).alias("inches_bucket"))


@query("affine_remap", """
SELECT p_partkey, p_size::DOUBLE / 255 AS rescaled, p_size - 1 AS shifted, (p_size - 1) * 127 AS stretched FROM part""")
def q_affine_remap(spark, sf):
    p = read(spark, sf, "part")
    return p.select("p_partkey", (F.col("p_size").cast("double") / F.lit(255.0)).alias("rescaled"),
                    X.affine(F.col("p_size"), shift=-1).cast("int").alias("shifted"),
                    X.affine(F.col("p_size"), shift=-1, scale=127).cast("int").alias("stretched"))


# ------------------------------------------------------------------------------------ analyzers

SPLIT_SQL = """
sp AS (SELECT *, CASE WHEN u < 0.70 THEN 'train' WHEN u < 0.85 THEN 'eval' ELSE 'test' END AS split
       FROM (SELECT *, ('0x' || substr(md5(CAST(Unname AS VARCHAR) || '|42'), 1, 8))::BIGINT / 4294967296.0 AS u
             FROM laptop))
"""


@query("split_hash", L + ", " + SPLIT_SQL + "SELECT Unname, split FROM sp")
def q_split_hash(spark, sf):
    return split_hash(laptop_raw(spark, sf), "Unname", seed=42).select("Unname", "split")


def _vocab_sql(name: str, expr: str, src: str = "px") -> str:
    return (f"v_{name} AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term DESC) - 1 AS id, cnt FROM "
            f"(SELECT {expr} AS term, count(*) AS cnt FROM {src} WHERE split = 'train' AND {expr} IS NOT NULL "
            f"GROUP BY 1))")


@query("vocab_build", L + ", " + SPLIT_SQL + ", px AS (SELECT * FROM sp), "
       + _vocab_sql("g", SQLX["gpu_model"]) + " SELECT term, cnt AS count, id FROM v_g")
def q_vocab_build(spark, sf):
    train = splits_of(split_hash(laptop_raw(spark, sf), "Unname"), names=("train",))["train"]
    return vocab_build(train, X.token_at("Gpu", 1))


@query("vocab_apply", L + ", " + SPLIT_SQL + ", px AS (SELECT * FROM sp), " + _vocab_sql("c", SQLX["cpu_family"]) + f"""
SELECT Unname, split, coalesce(v_c.id, -1) AS cpu_family_xf
FROM sp LEFT JOIN v_c ON {SQLX['cpu_family']} = v_c.term""")
def q_vocab_apply(spark, sf):
    tagged = split_hash(laptop_raw(spark, sf), "Unname")
    train = tagged.filter(F.col("split") == "train")
    v = vocab_build(train, X.parse_cpu("Cpu")["family"])
    return vocab_apply(tagged, X.parse_cpu("Cpu")["family"], v, "cpu_family_xf").select("Unname", "split", "cpu_family_xf")


def _z(x: str, m: str, s: str) -> str:
    return (f"round(round(CASE WHEN {s} IS NULL OR {s} = 0 THEN CASE WHEN {x} IS NULL THEN NULL ELSE 0.0 END "
            f"ELSE ({x} - {m}) / {s} END, 9), 6)")


@query("zscore", L + ", " + SPLIT_SQL + f""",
st AS (SELECT avg({SQLX['weight']}) AS mw, stddev_pop({SQLX['weight']}) AS sw,
              avg(Inches::DOUBLE) AS mi, stddev_pop(Inches::DOUBLE) AS si FROM sp WHERE split = 'train')
SELECT Unname, split, {_z(SQLX['weight'], 'mw', 'sw')} AS scaled_weight, {_z('Inches::DOUBLE', 'mi', 'si')} AS scaled_inches
FROM sp, st""")
def q_zscore(spark, sf):
    tagged = split_hash(laptop_raw(spark, sf), "Unname")
    w = X.parse_unit("Weight", "kg")
    row = tagged.filter(F.col("split") == "train").agg(
        F.avg(w).alias("mw"), F.stddev_pop(w).alias("sw"),
        F.avg(F.col("Inches").cast("double")).alias("mi"), F.stddev_pop(F.col("Inches").cast("double")).alias("si")).first()
    return tagged.select("Unname", "split",
                         rnd(zscore_expr(w, row["mw"], row["sw"]), 6).alias("scaled_weight"),
                         rnd(zscore_expr(F.col("Inches"), row["mi"], row["si"]), 6).alias("scaled_inches"))


@query("impute_mean", L + ", " + SPLIT_SQL + """,
st AS (SELECT avg(Price::DOUBLE) AS m FROM sp WHERE split = 'train')
SELECT Unname, split, Price IS NULL AS was_missing, round(round(coalesce(Price::DOUBLE, st.m), 9), 6) AS price_imputed
FROM sp, st""")
def q_impute_mean(spark, sf):
    tagged = split_hash(laptop_raw(spark, sf), "Unname")
    tf = analyze(tagged.filter(F.col("split") == "train"),
                 lambda i, ctx: {"price_imputed": ctx.impute_mean(i["Price"])}, keep=["Unname", "split", "Price"])
    out = tf.apply(tagged)
    return out.select("Unname", "split", F.col("Price").isNull().alias("was_missing"), _r("price_imputed"))


NUMERIC_ANALYZERS = [("scaled_ssd", "ssd"), ("scaled_hdd", "hdd"), ("scaled_flash", "flash"),
                     ("scaled_total", "total"), ("ram_scaled", "ram"), ("scaled_width", "width"),
                     ("scaled_height", "height"), ("scaled_cpu_clock_speed_ghz", "clock"),
                     ("scaled_weight", "weight")]
VOCABS = [("company_xf", "company"), ("opsys_xf", "opsys"), ("typename_xf", "typename"),
          ("cpu_brand_xf", "cpu_brand"), ("cpu_family_xf", "cpu_family"), ("gpu_brand_xf", "gpu_brand"),
          ("gpu_model_xf", "gpu_model")]


def _flow_sql(where: str = "") -> str:
    # Derived columns carry an x_ prefix: SQL identifiers are case-insensitive (ram vs Ram).
    px_cols = ", ".join(f"{SQLX[k]} AS x_{k}" for k in ["company", "ssd", "hdd", "flash", "total", "ram", "opsys",
                                                        "typename", "width", "height", "cpu_brand", "cpu_family",
                                                        "clock", "gpu_brand", "gpu_model", "weight", "price"])
    st_cols = ", ".join(f"avg(x_{k}::DOUBLE) AS m_{k}, stddev_pop(x_{k}::DOUBLE) AS s_{k}" for _, k in NUMERIC_ANALYZERS)
    vocabs = ", ".join(_vocab_sql(k, "x_" + k, "px2") for _, k in VOCABS)
    outs = [f"coalesce(v_{k}.id, -1) AS {name}" for name, k in VOCABS]
    outs += [f"{_z('x_' + k + '::DOUBLE', 'st.m_' + k, 'st.s_' + k)} AS {name}" for name, k in NUMERIC_ANALYZERS]
    outs += [f"{v} AS {k}" for k, v in FLAG_SQL.items()]
    outs += [f"{SQLX['inches_bucket']} AS inches_bucket", f"{_z('price_imp', 'st2.m_pi', 'st2.s_pi')} AS scaled_price"]
    joins = " ".join(f"LEFT JOIN v_{k} ON px2.x_{k} = v_{k}.term" for _, k in VOCABS)
    return (L + ", " + SPLIT_SQL + f""",
px AS (SELECT *, {px_cols} FROM sp),
st AS (SELECT {st_cols}, avg(x_price) AS m_price FROM px WHERE split = 'train'),
px2 AS (SELECT px.*, coalesce(x_price, st.m_price) AS price_imp FROM px, st),
st2 AS (SELECT avg(price_imp) AS m_pi, stddev_pop(price_imp) AS s_pi FROM px2 WHERE split = 'train'),
{vocabs}
SELECT px2.Unname, px2.split, {', '.join(outs)}
FROM px2 CROSS JOIN st CROSS JOIN st2 {joins} {where}""")


def _round_flow(df):
    zs = [n for n, _ in NUMERIC_ANALYZERS] + ["scaled_price"]
    return df.select(*[rnd(F.col(c), 6).alias(c) if c in zs else F.col(c) for c in df.columns])


@query("preprocess_flow", _flow_sql())
def q_preprocess_flow(spark, sf):
    return _round_flow(laptop_flow(spark, sf))


@query("transform_apply", _flow_sql("WHERE px2.split = 'eval'"))
def q_transform_apply(spark, sf):
    tf, parts = laptop_analyze(spark, sf)
    return _round_flow(tf.apply(parts["eval"]).withColumn("split", F.lit("eval")))


def _analyzer_stats_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS output, round(round(avg(x_{k}::DOUBLE), 9), 6) AS mean, round(round(stddev_pop(x_{k}::DOUBLE), 9), 6) AS std "
        f"FROM px WHERE split = 'train'" for name, k in NUMERIC_ANALYZERS)
    px_cols = ", ".join(f"{SQLX[k]} AS x_{k}" for _, k in NUMERIC_ANALYZERS)
    return L + ", " + SPLIT_SQL + f", px AS (SELECT *, {px_cols} FROM sp) " + rows


@query("analyze_transform", _analyzer_stats_sql())
def q_analyze_transform(spark, sf):
    """Frozen z-score statistics of the laptop flow, one row per numeric output (computed in
    Spark from the train split; this small table is what the transform carries)."""
    tf, parts = laptop_analyze(spark, sf)
    names = [n for n, _ in NUMERIC_ANALYZERS]
    zs = [a for a in tf.ctx.analyzers if a.kind == "zscore"][:len(names)]
    rows = [(n, round(round(a.result[0], 9), 6), round(round(a.result[1], 9), 6)) for n, a in zip(names, zs)]
    return spark.createDataFrame(rows, "output string, mean double, std double")

