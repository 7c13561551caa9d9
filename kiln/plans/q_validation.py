"""Validation flow queries: split, profile, infer, edit, validate, skew and drift (orders stand-in)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import profile_store as PS
from kiln.operators import rules as R
from kiln.operators import schema as S
from kiln.operators import stats as ST
from kiln.operators import validate as V
from kiln.operators.split import count_rows, splits_of
from kiln.plans.fixtures import (DOCS_LABELLED_SQL, ORDER_LABEL, ORDERS_SPLIT_SQL, docs_labelled, orders_split,
                                 read)
from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import scratch_path

W = "WITH " + ORDERS_SPLIT_SQL
REMOVE = {"o_orderkey", "pos", "split"}


def _parts(spark, sf):
    return splits_of(orders_split(spark, sf), label=ORDER_LABEL)


def _prof(df):
    return ST.profile(df, remove=REMOVE)


SPLITS = ("train", "eval", "serving")


def _schema_with_profiles(spark, sf):
    """Schema inferred from the train split, the parts, and the profiles of all three splits –
    taken in ONE pass over the tagged table (the serving profile leaves out the label)."""
    tagged = orders_split(spark, sf)
    profs = ST.profile_splits(tagged, SPLITS, remove={"o_orderkey", "pos"}, exclude={"serving": {ORDER_LABEL}})
    return S.infer_schema(profs["train"]), splits_of(tagged, label=ORDER_LABEL), profs


def _schema(spark, sf):
    schema, parts, _ = _schema_with_profiles(spark, sf)
    return schema, parts


def _r(c, d=6):
    return rnd(F.col(c), d).alias(c)


# ------------------------------------------------------------------------------------ splits

@query("split_positional", W + "SELECT o_orderkey, pos, split, o_orderpriority FROM osplit")
def q_split_positional(spark, sf):
    return orders_split(spark, sf, with_positions=True).select("o_orderkey", "pos", "split", "o_orderpriority")


@query("count_rows", W + "SELECT split, count(*) AS n_rows FROM osplit GROUP BY split")
def q_count_rows(spark, sf):
    return count_rows(orders_split(spark, sf))


@query("proj_allowlist", W + """
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_clerk FROM osplit WHERE split = 'train'""")
def q_proj_allowlist(spark, sf):
    train = _parts(spark, sf)["train"]
    return train.select(*ST.allowed(train, remove={"o_orderkey"}))


@query("proj_drop_label", W + """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_clerk FROM osplit WHERE split = 'serving'""")
def q_proj_drop_label(spark, sf):
    return _parts(spark, sf)["serving"]


# ------------------------------------------------------------------------------------ profiles

@query("stats_summary", W + """
SELECT 5::BIGINT AS num_features, count(*) AS num_examples, 'o_custkey' AS first_feature,
       'o_clerk' AS last_feature
FROM osplit WHERE split = 'train'""")
def q_stats_summary(spark, sf):
    train = _parts(spark, sf)["train"]
    return ST.stats_summary(train, ST.allowed(train, remove=REMOVE))


def _numeric_sql(src: str, cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"""
SELECT '{c}' AS feature, {i} AS ordinal, count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS missing,
       round(round(avg({c}::DOUBLE), 9), 6) AS mean, round(round(stddev_pop({c}::DOUBLE), 9), 6) AS std_dev,
       count(*) FILTER (WHERE {c} = 0) AS zeros, min({c})::DOUBLE AS min,
       quantile_disc({c}::DOUBLE, 0.5) AS median, max({c})::DOUBLE AS max
FROM {src}""")
    return " UNION ALL ".join(parts)


def _numeric_out(df):
    return df.select("feature", "ordinal", "count", "missing", _r("mean"), _r("std_dev"), "zeros", "min",
                     "median", "max")


@query("stats_numeric", "WITH p AS (SELECT * FROM part) " + _numeric_sql("p", ["p_size", "p_retailprice"]))
def q_stats_numeric(spark, sf):
    part = read(spark, sf, "part")
    return _numeric_out(ST.stats_numeric(part, ["p_size", "p_retailprice"], exact_median=True))


PROBS = [0.01, 0.25, 0.5, 0.9, 1.0]


@query("stats_quantiles", "WITH " + ", ".join(
    f"r{i} AS (SELECT {c}::DOUBLE AS v, row_number() OVER (ORDER BY {c}) - 1 AS k, count(*) OVER () AS n FROM lineitem WHERE {c} IS NOT NULL)"
    for i, c in enumerate(("l_quantity", "l_extendedprice"))) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {p}::DOUBLE AS prob, any_value(v) AS value FROM r{i} WHERE k = CAST(floor({p}::DOUBLE * (n - 1)) AS BIGINT)"
    for i, c in enumerate(("l_quantity", "l_extendedprice")) for p in PROBS))
def q_stats_quantiles(spark, sf):
    """Exact quantiles of a column with 50 values and of one with nearly as many values as rows."""
    return ST.exact_quantiles(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], PROBS)


STR_FEATS = ["o_orderstatus", "o_orderpriority", "o_clerk"]
_MELT = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS ordinal, {c} AS value FROM osplit WHERE split = '{{split}}'"
    for i, c in enumerate(STR_FEATS))
FREQ_SQL = "SELECT feature, value, count(*) AS count FROM ({m}) WHERE value IS NOT NULL GROUP BY feature, value"


def _freq_cte(name: str, split: str) -> str:
    return f"{name} AS ({FREQ_SQL.format(m=_MELT.format(split=split))})"


@query("stats_string", W + ", " + _freq_cte("f", "train") + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value) AS rk FROM f),
per AS (SELECT feature, sum(count)::BIGINT AS count, count(*)::BIGINT AS distinct,
               round(round(sum(count * length(value)) / sum(count), 9), 6) AS avg_length,
               max(count)::BIGINT AS top_freq FROM f GROUP BY feature),
names AS (SELECT * FROM (VALUES ('o_orderstatus', 0), ('o_orderpriority', 1), ('o_clerk', 2)) t(feature, ordinal)),
n AS (SELECT count(*) AS n FROM osplit WHERE split = 'train')
SELECT names.feature, names.ordinal, per.count, (n.n - per.count)::BIGINT AS missing, per.distinct,
       per.avg_length, r.value AS top, per.top_freq
FROM names JOIN per ON names.feature = per.feature JOIN ranked r ON r.feature = names.feature AND r.rk = 1, n""")
def q_stats_string(spark, sf):
    train = _parts(spark, sf)["train"]
    s = ST.stats_string(train, STR_FEATS)
    return s.select("feature", "ordinal", "count", "missing", "distinct", _r("avg_length"), "top", "top_freq")


@query("stats_value_freq", W + ", " + _freq_cte("f", "train") + " SELECT feature, value, count FROM f")
def q_stats_value_freq(spark, sf):
    return ST.stats_value_freq(_parts(spark, sf)["train"], STR_FEATS)


@query("stats_histogram", """
WITH b AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
h AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((p_retailprice - lo) * 10 / (hi - lo)), 9) END AS INTEGER)
               AS bucket, lo, hi FROM part, b WHERE p_retailprice IS NOT NULL)
SELECT 'p_retailprice' AS feature, CAST(i AS INTEGER) AS bucket, round(round(lo + i * (hi - lo) / 10, 9), 6) AS low,
       round(round(lo + (i + 1) * (hi - lo) / 10, 9), 6) AS high, (SELECT count(*) FROM h WHERE bucket = i) AS count
FROM range(10) t(i), b""")
def q_stats_histogram(spark, sf):
    h = ST.stats_histogram(read(spark, sf, "part"), "p_retailprice", 10)
    return h.select("feature", "bucket", _r("low"), _r("high"), "count")


@query("stats_describe", W + """,
f AS (SELECT o_orderpriority AS value, count(*) AS c FROM osplit WHERE split = 'train' GROUP BY 1)
SELECT (SELECT sum(c) FROM f)::BIGINT AS count, (SELECT count(*) FROM f)::BIGINT AS unique,
       (SELECT value FROM f ORDER BY c DESC, value LIMIT 1) AS top, (SELECT max(c) FROM f)::BIGINT AS freq""")
def q_stats_describe(spark, sf):
    return ST.stats_describe(_parts(spark, sf)["train"], "o_orderpriority")


CMP_MEASURES = ["count", "mean", "std_dev", "min", "max"]


def _cmp_sql() -> str:
    def side(split):
        rows = []
        for c in ["o_custkey", "o_totalprice"]:
            rows.append(f"""SELECT '{c}' AS feature, count({c})::DOUBLE AS count, avg({c}::DOUBLE) AS mean,
               stddev_pop({c}::DOUBLE) AS std_dev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
               FROM osplit WHERE split = '{split}'""")
        return " UNION ALL ".join(rows)
    unpivot = lambda t, name: " UNION ALL ".join(
        f"SELECT feature, '{m}' AS measure, {m} AS {name} FROM {t}" for m in CMP_MEASURES)
    return (W + f", l AS ({side('train')}), r AS ({side('eval')}), "
            f"lu AS ({unpivot('l', 'train')}), ru AS ({unpivot('r', 'eval')}) "
            "SELECT coalesce(lu.feature, ru.feature) AS feature, coalesce(lu.measure, ru.measure) AS measure, "
            "round(round(train, 9), 6) AS train, round(round(eval, 9), 6) AS eval "
            "FROM lu FULL OUTER JOIN ru ON lu.feature = ru.feature AND lu.measure = ru.measure")


@query("stats_compare", _cmp_sql())
def q_stats_compare(spark, sf):
    parts = _parts(spark, sf)
    cols = ["o_custkey", "o_totalprice"]
    a = ST.stats_numeric(parts["train"], cols)
    b = ST.stats_numeric(parts["eval"], cols)
    c = ST.stats_compare(a, b, CMP_MEASURES, "train", "eval")
    return c.select("feature", "measure", _r("train"), _r("eval"))


@query("stats_typed", W + ", ev AS (SELECT * FROM osplit WHERE split = 'eval') "
       + _numeric_sql("ev", ["o_custkey", "o_totalprice"]))
def q_stats_typed(spark, sf):
    schema, parts = _schema(spark, sf)
    raw = parts["eval"].withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    types = {r["feature"]: r["type"] for r in schema.features.select("feature", "type").collect()}
    typed = ST.stats_typed(raw, types)
    return _numeric_out(ST.stats_numeric(typed, ["o_custkey", "o_totalprice"], exact_median=True))


# ------------------------------------------------------------------------------------ schema

FEATS_SQL = """
feats AS (
  SELECT feature, ordinal, type,
         CASE WHEN type = 'BYTES' AND d <= 100 AND d > 0 THEN feature END AS domain,
         CASE WHEN missing = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS min_fraction, 1::BIGINT AS min_count
  FROM (
    SELECT 'o_custkey' AS feature, 0 AS ordinal, 'INT' AS type, NULL::BIGINT AS d,
           count(*) FILTER (WHERE o_custkey IS NULL) AS missing FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_orderstatus', 1, 'BYTES', count(DISTINCT o_orderstatus),
           count(*) FILTER (WHERE o_orderstatus IS NULL) FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_totalprice', 2, 'FLOAT', NULL, count(*) FILTER (WHERE o_totalprice IS NULL)
           FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_orderpriority', 3, 'BYTES', count(DISTINCT o_orderpriority),
           count(*) FILTER (WHERE o_orderpriority IS NULL) FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_clerk', 4, 'BYTES', count(DISTINCT o_clerk),
           count(*) FILTER (WHERE o_clerk IS NULL) FROM osplit WHERE split = 'train')),
doms AS (
  SELECT DISTINCT feats.domain, m.value FROM (
    SELECT 'o_orderstatus' AS feature, o_orderstatus AS value FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM osplit WHERE split = 'train'
    UNION ALL SELECT 'o_clerk', o_clerk FROM osplit WHERE split = 'train') m
  JOIN feats ON feats.feature = m.feature WHERE feats.domain IS NOT NULL AND m.value IS NOT NULL)
"""
WS = W + ", " + FEATS_SQL


@query("schema_infer", WS + "SELECT feature, ordinal, type, domain, min_fraction, min_count FROM feats")
def q_schema_infer(spark, sf):
    schema, _ = _schema(spark, sf)
    return schema.features.select("feature", "ordinal", "type", "domain", "min_fraction", "min_count")


@query("schema_domains_omitted", W + ", " + _freq_cte("f", "train") + """
SELECT feature, count(*) AS distinct FROM f GROUP BY feature HAVING count(*) > 100""")
def q_schema_domains_omitted(spark, sf):
    _, _, profs = _schema_with_profiles(spark, sf)
    return S.domains_omitted(profs["train"])


@query("schema_domains", WS + "SELECT domain, value FROM doms")
def q_schema_domains(spark, sf):
    schema, _ = _schema(spark, sf)
    return schema.domains


@query("schema_display", WS + """
SELECT feats.feature, feats.type, feats.domain, count(doms.value)::BIGINT AS n_domain_values
FROM feats LEFT JOIN doms ON feats.domain = doms.domain GROUP BY feats.feature, feats.type, feats.domain""")
def q_schema_display(spark, sf):
    schema, _ = _schema(spark, sf)
    sizes = schema.domains.groupBy("domain").agg(F.count(F.lit(1)).cast("bigint").alias("n_domain_values"))
    return (schema.feature_table().join(sizes, "domain", "left")
            .select("feature", "type", "domain", F.coalesce("n_domain_values", F.lit(0)).cast("bigint")
                    .alias("n_domain_values")))


@query("domain_get", WS + "SELECT domain, value FROM doms WHERE domain = 'o_orderpriority'")
def q_domain_get(spark, sf):
    schema, _ = _schema(spark, sf)
    return S.domain_get(schema, "o_orderpriority")


@query("domain_append", WS + """
SELECT DISTINCT domain, value FROM (
  SELECT domain, value FROM doms WHERE domain = 'o_orderpriority'
  UNION ALL SELECT 'o_orderpriority', '6-UNKNOWN' UNION ALL SELECT 'o_orderpriority', '1-URGENT')""")
def q_domain_append(spark, sf):
    schema, _ = _schema(spark, sf)
    s2 = S.domain_append(S.domain_append(schema, "o_orderpriority", ["6-UNKNOWN", "1-URGENT"]),
                         "o_orderpriority", ["6-UNKNOWN"])
    return S.domain_get(s2, "o_orderpriority")


@query("domain_share", WS + """
SELECT feature, CASE WHEN feature IN ('o_orderstatus', 'o_clerk')
                     THEN (SELECT domain FROM feats WHERE feature = 'o_orderpriority') ELSE domain END AS domain
FROM feats""")
def q_domain_share(spark, sf):
    schema, _ = _schema(spark, sf)
    return S.domain_share(schema, ["o_orderstatus", "o_clerk"], "o_orderpriority").features.select("feature", "domain")


EVAL_FREQ = ", " + _freq_cte("ef", "eval")


@query("validate_domain", WS + EVAL_FREQ + """,
tot AS (SELECT feature, sum(count) AS total FROM ef GROUP BY feature),
outside AS (
  SELECT ef.feature, ef.value, ef.count FROM ef JOIN feats ON ef.feature = feats.feature
  WHERE feats.domain IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM doms WHERE doms.domain = feats.domain AND doms.value = ef.value)),
o2 AS (SELECT outside.feature, value, count / total AS fraction FROM outside JOIN tot ON outside.feature = tot.feature),
flag AS (SELECT feature FROM o2 GROUP BY feature HAVING 1 - sum(fraction) < 1.0)
SELECT feature, 'UNEXPECTED_STRING_VALUES' AS anomaly, value AS detail, round(round(fraction, 9), 6) AS value
FROM o2 WHERE feature IN (SELECT feature FROM flag)""")
def q_validate_domain(spark, sf):
    schema, _, profs = _schema_with_profiles(spark, sf)
    out = V.validate_domain(profs["eval"]["freq"], schema)
    return out.select("feature", "anomaly", "detail", _r("value"))


@query("validate_domain_mass", WS + ", " + _freq_cte("sf", "serving") + """,
j AS (SELECT sf.feature, sf.value, sf.count,
             CASE WHEN EXISTS (SELECT 1 FROM doms WHERE doms.domain = feats.domain AND doms.value = sf.value)
                  THEN 1 ELSE 0 END AS inside,
             CASE WHEN sf.feature = 'o_orderpriority' THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS min_domain_mass
      FROM sf JOIN feats ON sf.feature = feats.feature WHERE feats.domain IS NOT NULL
        AND sf.feature <> 'o_orderstatus')
SELECT feature, min_domain_mass, round(round(sum(CASE WHEN inside = 1 THEN count ELSE 0 END) / sum(count), 9), 6) AS in_domain,
       sum(CASE WHEN inside = 1 THEN count ELSE 0 END) / sum(count) < min_domain_mass AS is_anomaly
FROM j GROUP BY feature, min_domain_mass""")
def q_validate_domain_mass(spark, sf):
    schema, _, profs = _schema_with_profiles(spark, sf)
    schema = S.set_feature(schema, "o_orderpriority", min_domain_mass=0.9)
    out = V.domain_mass(profs["serving"]["freq"], schema)
    return out.select("feature", "min_domain_mass", _r("in_domain"), "is_anomaly")


@query("validate_missing_column", WS + """,
seen AS (SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE (o_orderstatus), '' AS o_clerk FROM orders))
SELECT feature, 'SCHEMA_MISSING_COLUMN' AS anomaly, NULL::VARCHAR AS detail, NULL::DOUBLE AS value
FROM feats WHERE feature NOT IN (SELECT column_name FROM seen)""")
def q_validate_missing_column(spark, sf):
    schema, _, profs = _schema_with_profiles(spark, sf)
    return V.validate_missing_column(profs["serving"], schema)


@query("validate_new_column", WS + """,
seen AS (SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE (o_orderstatus, o_orderkey, o_orderdate), '' AS o_clerk, 'b' || o_totalprice AS tax_band,
                                                  o_totalprice * 0.9 AS discounted FROM orders))
SELECT column_name AS feature, 'SCHEMA_NEW_COLUMN' AS anomaly, NULL::VARCHAR AS detail, NULL::DOUBLE AS value
FROM seen WHERE column_name NOT IN (SELECT feature FROM feats)""")
def q_validate_new_column(spark, sf):
    schema, parts = _schema(spark, sf)
    more = parts["serving"].withColumns({"tax_band": F.concat(F.lit("b"), (F.col("o_totalprice") % 3).cast("int")),
                                         "discounted": F.col("o_totalprice") * 0.9})
    return V.validate_new_column(_prof(more), schema)


@query("validate_type", WS + """,
seen AS (SELECT column_name AS feature, CASE WHEN column_type IN ('DOUBLE', 'FLOAT') OR column_type LIKE 'DECIMAL%' THEN 'FLOAT'
                                             WHEN column_type LIKE '%INT%' THEN 'INT' ELSE 'BYTES' END AS type
         FROM (DESCRIBE SELECT * EXCLUDE (o_orderstatus) REPLACE (CAST(o_totalprice AS VARCHAR) AS o_totalprice), '' AS o_clerk FROM orders))
SELECT feats.feature, 'UNEXPECTED_TYPE' AS anomaly, feats.type || '->' || seen.type AS detail, NULL::DOUBLE AS value
FROM feats JOIN seen ON feats.feature = seen.feature WHERE feats.type <> seen.type""")
def q_validate_type(spark, sf):
    schema, parts = _schema(spark, sf)
    raw = parts["serving"].withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    return V.validate_type(_prof(raw), schema)


DOC_FEATS = ["lang", "n_chars", "quality", "toxic"]


@query("validate_presence", "WITH " + DOCS_LABELLED_SQL + """,
m AS (SELECT 'quality' AS feature, count(quality) AS c, count(*) - count(quality) AS miss FROM docs
      UNION ALL SELECT 'toxic', count(toxic), count(*) - count(toxic) FROM docs
      UNION ALL SELECT 'lang', count(lang), count(*) - count(lang) FROM docs
      UNION ALL SELECT 'n_chars', count(n_chars), count(*) - count(n_chars) FROM docs)
SELECT feature, 'PRESENCE' AS anomaly, CASE WHEN c < 1 THEN 'count' ELSE 'fraction' END AS detail,
       round(round(c / (c + miss), 9), 6) AS value
FROM m WHERE c / (c + miss) < 1.0 OR c < 1""")
def q_validate_presence(spark, sf):
    docs = docs_labelled(spark, sf).select(*DOC_FEATS)
    schema = S.infer_schema(ST.profile(docs.where(F.col("quality").isNotNull())))
    out = V.validate_presence(ST.profile(docs), schema)
    return out.select("feature", "anomaly", "detail", _r("value"))


@query("validate_value_count", """
SELECT 'embedding' AS feature, 'VALUE_COUNT' AS anomaly, 'below_min' AS detail,
       min(CASE WHEN label = 3 THEN 32 ELSE len(embedding) END)::DOUBLE AS value
FROM embeddings HAVING min(CASE WHEN label = 3 THEN 32 ELSE len(embedding) END) < min(len(embedding))""")
def q_validate_value_count(spark, sf):
    emb = read(spark, sf, "embeddings")
    sizes = V.array_sizes(emb, ["embedding"])
    prof = ST.profile(emb, remove={"vec_id"})
    schema = S.infer_schema(prof, array_sizes=sizes)
    served = emb.withColumn("embedding", F.when(F.col("label") == 3, F.slice("embedding", 1, 32))
                            .otherwise(F.col("embedding")))
    return V.validate_value_count(V.array_sizes(served, ["embedding"]), schema)


@query("env_filter", WS + "SELECT feature FROM feats WHERE feature <> 'o_orderstatus'")
def q_env_filter(spark, sf):
    schema, _ = _schema(spark, sf)
    schema = S.not_in_environment(S.add_environment(schema, "TRAINING", "SERVING"), ORDER_LABEL, "SERVING")
    return S.env_filter(schema, "SERVING").select("feature")


def _linf_sql(a: str, b: str, features: list[str], thr: str) -> str:
    return f"""
na AS (SELECT {a}.feature, value, count / sum(count) OVER (PARTITION BY {a}.feature) AS p FROM {a}
       WHERE feature IN ({', '.join("'" + f + "'" for f in features)})),
nb AS (SELECT {b}.feature, value, count / sum(count) OVER (PARTITION BY {b}.feature) AS q FROM {b}
       WHERE feature IN ({', '.join("'" + f + "'" for f in features)})),
j AS (SELECT coalesce(na.feature, nb.feature) AS feature, coalesce(na.value, nb.value) AS value,
             abs(coalesce(p, 0.0) - coalesce(q, 0.0)) AS d
      FROM na FULL OUTER JOIN nb ON na.feature = nb.feature AND na.value = nb.value),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY d DESC, value) AS rk FROM j),
thr AS (SELECT * FROM (VALUES {thr}) t(feature, threshold))
"""


@query("skew_linf", W + ", " + _freq_cte("tf", "train") + ", " + _freq_cte("sv", "serving") + ", "
       + _linf_sql("tf", "sv", ["o_orderpriority", "o_clerk"], "('o_orderpriority', 0.03::DOUBLE), ('o_clerk', 0.002::DOUBLE)") + """
SELECT r.feature, round(round(d, 9), 6) AS distance, value AS at_value, thr.threshold, 'SKEW' AS anomaly,
       d > thr.threshold AS is_anomaly
FROM r JOIN thr ON r.feature = thr.feature WHERE rk = 1""")
def q_skew_linf(spark, sf):
    schema, _, profs = _schema_with_profiles(spark, sf)
    schema = S.set_feature(S.set_feature(schema, "o_orderpriority", skew_threshold=0.03), "o_clerk",
                           skew_threshold=0.002)
    out = V.skew_linf(profs["train"]["freq"], profs["serving"]["freq"], schema)
    return out.select("feature", _r("distance"), "at_value", "threshold", "anomaly", "is_anomaly")


@query("drift_linf", """
WITH f AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS span, event_type AS value, count(*) AS c
           FROM events GROUP BY 1, 2),
n AS (SELECT span, value, c / sum(c) OVER (PARTITION BY span) AS p FROM f),
spans AS (SELECT span, lag(span) OVER (ORDER BY span) AS prev FROM (SELECT DISTINCT span FROM f)),
pairs AS (SELECT s.span, s.prev, v.value FROM spans s,
          (SELECT DISTINCT value FROM f) v WHERE s.prev IS NOT NULL),
j AS (SELECT pairs.span, pairs.prev, pairs.value,
             abs(coalesce(a.p, 0.0) - coalesce(b.p, 0.0)) AS d
      FROM pairs LEFT JOIN n a ON a.span = pairs.span AND a.value = pairs.value
                 LEFT JOIN n b ON b.span = pairs.prev AND b.value = pairs.value
      WHERE a.p IS NOT NULL OR b.p IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY span ORDER BY d DESC, value) AS rk FROM j)
SELECT span, prev AS previous_span, 'event_type' AS feature, round(round(d, 9), 6) AS distance, value AS at_value,
       0.03::DOUBLE AS threshold, d > 0.03 AS is_anomaly
FROM r WHERE rk = 1""")
def q_drift_linf(spark, sf):
    ev = read(spark, sf, "events").select(F.to_date("ts").cast("string").alias("span"), "event_type")
    out = V.drift_by_span(ev, "span", ["event_type"], 0.03)
    return out.select("span", "previous_span", "feature", _r("distance"), "at_value", "threshold", "is_anomaly")


@query("validate_all", W + ", " + _freq_cte("tf", "train") + ", " + _freq_cte("ef", "eval") + ", "
       + _freq_cte("sv", "serving") + """,
lin AS (
  SELECT f, feature, value, abs(coalesce(p, 0.0) - coalesce(q, 0.0)) AS d FROM (
    SELECT 'skew' AS f, coalesce(a.feature, b.feature) AS feature, coalesce(a.value, b.value) AS value,
           a.count / sum(a.count) OVER (PARTITION BY a.feature) AS p, b.count / sum(b.count) OVER (PARTITION BY b.feature) AS q
    FROM (SELECT * FROM tf WHERE feature = 'o_clerk') a FULL OUTER JOIN (SELECT * FROM sv WHERE feature = 'o_clerk') b
      ON a.feature = b.feature AND a.value = b.value
    UNION ALL
    SELECT 'drift', coalesce(a.feature, b.feature), coalesce(a.value, b.value),
           a.count / sum(a.count) OVER (PARTITION BY a.feature), b.count / sum(b.count) OVER (PARTITION BY b.feature)
    FROM (SELECT * FROM tf WHERE feature = 'o_orderpriority') a
    FULL OUTER JOIN (SELECT * FROM ef WHERE feature = 'o_orderpriority') b ON a.feature = b.feature AND a.value = b.value)),
r AS (SELECT *, row_number() OVER (PARTITION BY f, feature ORDER BY d DESC, value) AS rk FROM lin)
SELECT feature, CASE WHEN f = 'skew' THEN 'SKEW' ELSE 'DRIFT' END AS anomaly, value AS detail,
       round(round(d, 9), 6) AS value
FROM r WHERE rk = 1 AND d > CASE WHEN f = 'skew' THEN 0.002 ELSE 0.005 END""")
def q_validate_all(spark, sf):
    schema, _, profs = _schema_with_profiles(spark, sf)
    schema = S.set_feature(schema, "o_clerk", skew_threshold=0.002)
    schema = S.set_feature(schema, "o_orderpriority", drift_threshold=0.005)
    out = V.validate_all(profs["train"], schema, previous=profs["eval"], serving=profs["serving"])
    return out.select("feature", "anomaly", "detail", _r("value"))


# ------------------------------------------------------------------- statistics stored per span

def _event_spans(spark, sf) -> str:
    """Every day of the events is a stored span."""
    ev = read(spark, sf, "events").select(F.to_date("ts").cast("string").alias("span"), "event_type", "value", "user_id")
    path = scratch_path(spark, "profile-store")
    PS.write_spans(ev, path, "span")
    return path


@query("store_drift", """
WITH f AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS span, event_type AS value, count(*) AS c FROM events GROUP BY 1, 2),
n AS (SELECT span, value, c / sum(c) OVER (PARTITION BY span) AS p FROM f),
spans AS (SELECT span, lag(span) OVER (ORDER BY span) AS prev FROM (SELECT DISTINCT span FROM f)),
j AS (SELECT s.span, s.prev, v.value, abs(coalesce(a.p, 0.0) - coalesce(b.p, 0.0)) AS d FROM spans s CROSS JOIN (SELECT DISTINCT value FROM f) v
      LEFT JOIN n a ON a.span = s.span AND a.value = v.value LEFT JOIN n b ON b.span = s.prev AND b.value = v.value WHERE s.prev IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY span ORDER BY d DESC, value) AS rk FROM j)
SELECT span, prev AS previous_span, 'event_type' AS feature, round(round(d, 9), 6) AS distance, value AS at_value, d > 0.03 AS is_anomaly FROM r WHERE rk = 1""")
def q_store_drift(spark, sf):
    """Drift of each day against the day before, from the stored spans alone."""
    out = PS.drift_of_spans(PS.stored(spark, _event_spans(spark, sf)), 0.03)
    return out.select("span", "previous_span", "feature", _r("distance"), "at_value", "is_anomaly")


@query("store_stats", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, count(*) - count({c}) AS missing, round(round(avg({c}), 9), 6) AS mean, round(round(stddev_pop({c}), 9), 6) AS std_dev,
       count(*) FILTER (WHERE {c} = 0) AS zeros, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, true AS median_within
FROM events""" for c in ("value", "user_id")))
def q_store_stats(spark, sf):
    """Statistics of all days merged from the stored spans; the median's rank is checked against the rows."""
    st = PS.statistics(PS.merged(PS.stored(spark, _event_spans(spark, sf)))).where("kind = 'number'")
    ev, n = read(spark, sf, "events"), st.select("feature", F.get("quantiles", F.lit(0)).alias("m"), "count").collect()
    ranks = ev.agg(*[F.count_if(F.col(r["feature"]) < r["m"]).alias(f"lo_{r['feature']}") for r in n],
                   *[F.count_if(F.col(r["feature"]) <= r["m"]).alias(f"hi_{r['feature']}") for r in n]).first()
    most = PS.RANK_ERROR
    good = [(r["feature"], ranks[f"lo_{r['feature']}"] / r["count"] <= 0.5 + most and ranks[f"hi_{r['feature']}"] / r["count"] >= 0.5 - most) for r in n]
    st = st.join(F.broadcast(spark.createDataFrame(good, "feature string, median_within boolean")), "feature")      # a row per feature
    return st.select("feature", "count", "missing", _r("mean"), _r("std_dev"), "zeros", "min", "max", "median_within")


# ------------------------------------------------------------------- all rules, eval and serving

RULES_SQL = W + """,
base AS (SELECT *, string_split(o_orderpriority, '-') AS parts FROM osplit),
ev AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN len(parts) + 1 ELSE len(parts) END AS n_tags FROM base WHERE split = 'eval'),
tr AS (SELECT *, len(parts) AS n_tags FROM base WHERE split = 'train'),
sv AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice), len(parts) AS n_tags FROM base WHERE split = 'serving'),
dom AS (SELECT DISTINCT o_orderpriority AS value FROM tr),
fr AS (SELECT 'train' AS split, o_orderpriority AS value, count(*) / sum(count(*)) OVER () AS p FROM tr GROUP BY 2
       UNION ALL SELECT 'eval', o_orderpriority, count(*) / sum(count(*)) OVER () FROM ev GROUP BY 2
       UNION ALL SELECT 'serving', o_orderpriority, count(*) / sum(count(*)) OVER () FROM sv GROUP BY 2),
dist AS (SELECT s.split, v.value, abs(coalesce(a.p, 0) - coalesce(b.p, 0)) AS d FROM (VALUES ('eval'), ('serving')) s(split)
         CROSS JOIN (SELECT DISTINCT value FROM fr) v LEFT JOIN fr a ON a.split = 'train' AND a.value = v.value LEFT JOIN fr b ON b.split = s.split AND b.value = v.value),
top AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY d DESC, value) AS rk FROM dist),
res AS (
  SELECT 'eval' AS split, 'channel' AS feature, 'SCHEMA_NEW_COLUMN' AS anomaly, NULL::VARCHAR AS detail, NULL::DOUBLE AS value
  UNION ALL SELECT 'serving', 'o_clerk', 'SCHEMA_MISSING_COLUMN', NULL, NULL
  UNION ALL SELECT 'eval', 'o_custkey', 'UNEXPECTED_TYPE', 'INT->BYTES', NULL
  UNION ALL SELECT 'serving', 'o_totalprice', 'PRESENCE', 'fraction', count(o_totalprice) / count(*) FROM sv HAVING count(o_totalprice) < count(*)
  UNION ALL SELECT 'eval', 'tags', 'VALUE_COUNT', 'above_max', max(n_tags) FROM ev HAVING max(n_tags) > (SELECT max(n_tags) FROM tr)
  UNION ALL SELECT split, 'o_orderpriority', 'UNEXPECTED_STRING_VALUES', value, p FROM fr WHERE split <> 'train' AND value NOT IN (SELECT value FROM dom)
  UNION ALL SELECT split, 'o_orderpriority', CASE WHEN split = 'serving' THEN 'SKEW' ELSE 'DRIFT' END, value, d FROM top WHERE rk = 1 AND d > 0.005)
SELECT split, feature, anomaly, detail, round(round(value, 9), 6) AS value FROM res"""


@query("validate_splits", RULES_SQL)
def q_validate_splits(spark, sf):
    """Eval and serving rows against the schema of the training rows, all rules from one count table. Eval
    has a column too many, a changed type and longer lists; serving lacks a column and has missing values;
    both have unseen priorities."""
    t = orders_split(spark, sf).withColumn("tags", F.split("o_orderpriority", "-"))
    part = lambda name: t.where(F.col("split") == name).drop("split")
    longer = F.when(F.col("o_orderkey") % 50 == 0, F.array_append("tags", F.lit("x"))).otherwise(F.col("tags"))
    counts = R.count_table({
        "train": part("train"),
        "eval": part("eval").withColumn("o_custkey", F.col("o_custkey").cast("string")).withColumn("tags", longer).withColumn("channel", F.lit("web")),
        "serving": part("serving").drop("o_clerk", "o_orderstatus").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))),
    }, remove={"o_orderkey", "pos"})
    schema = S.not_in_environment(R.schema_from_counts(counts, "train"), ORDER_LABEL, "SERVING")
    schema = S.set_feature(schema, "o_orderpriority", skew_threshold=0.005, drift_threshold=0.005)
    out = R.validate_splits(counts, schema, {"eval": "TRAINING", "serving": "SERVING"}, skew=("train", "serving"), drift=("eval", "train"))
    return out.select("split", "feature", "anomaly", "detail", _r("value"))


# ------------------------------------------------------------------------------------ freeze

@query("sink_schema", WS + "SELECT domain, value FROM doms")
def q_sink_schema(spark, sf):
    schema, _ = _schema(spark, sf)
    path = scratch_path(spark, "schema")
    S.save_schema(schema, path)
    return S.load_schema(spark, path).domains


@query("src_schema", WS + "SELECT feature, type, domain, min_fraction, min_count FROM feats")
def q_src_schema(spark, sf):
    schema, _ = _schema(spark, sf)
    path = scratch_path(spark, "schema")
    S.save_schema(S.add_environment(schema, "TRAINING"), path)
    return S.load_schema(spark, path).feature_table()
