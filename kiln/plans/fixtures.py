"""Fixture tables derived by Spark from the given test tables (see FIXTURES.md).

Each builder has a SQL twin string (``*_SQL``) used inside the oracle queries, so both engines
derive exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.operators.split import split_positional
from kiln.session import spread, table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; a large single-file table is spread over the cores (see ``spread``)."""
    return spread(spark.read.parquet(table_path(sf_dir, name)))


# ---------------------------------------------------------------------------------------------
# Hospital-visit stand-in: orders with a 70/15/15 positional split and a few recoded values in the
# later parts (unseen domain values), label = o_orderstatus.
# ---------------------------------------------------------------------------------------------

ORDER_FEATURES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_clerk"]
ORDER_LABEL = "o_orderstatus"


def orders_split(spark: SparkSession, sf_dir: str, with_positions: bool = False) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.concat(F.lit("Clerk#"), (F.col("o_custkey") % 1000).cast("string")).alias("o_clerk"))
    t = split_positional(o, "o_orderkey", with_positions=with_positions)
    return t.withColumn(
        "o_orderpriority",
        F.when((F.col("split") != "train") & (F.col("o_orderkey") % 97 == 0), F.lit("6-UNKNOWN"))
        .otherwise(F.col("o_orderpriority")))


ORDERS_SPLIT_SQL = """
o_base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         'Clerk#' || CAST(o_custkey % 1000 AS VARCHAR) AS o_clerk,
         row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n
  FROM orders),
o_sized AS (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS n_train FROM o_base),
o_tagged AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_clerk, pos,
         CASE WHEN pos < n_train THEN 'train'
              WHEN pos < n_train + (n - n_train) // 2 THEN 'eval' ELSE 'serving' END AS split
  FROM o_sized),
osplit AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         CASE WHEN split <> 'train' AND o_orderkey % 97 = 0 THEN '6-UNKNOWN' ELSE o_orderpriority END
           AS o_orderpriority,
         o_clerk, pos, split
  FROM o_tagged)
"""


# ---------------------------------------------------------------------------------------------
# Laptop stand-in: raw strings built from part columns.
# ---------------------------------------------------------------------------------------------

def laptop_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw laptop-like rows (all strings but the key/Inches/Price) built from ``part``."""
    p = read(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    ks = lambda c: c.cast("string")
    return p.select(
        k.alias("Unname"),
        F.when(k % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))).alias("Company"),
        F.col("p_type").alias("TypeName"),
        ((F.lit(110) + s) / F.lit(10)).cast("float").alias("Inches"),
        F.concat(F.element_at(F.array(F.lit("IPS Panel Full HD "), F.lit("Touchscreen 4K Ultra HD "),
                                      F.lit("Quad HD+ "), F.lit("Retina Display "), F.lit("Full HD ")),
                              (k % 5 + 1).cast("int")),
                 ks(F.lit(1000) + s), F.lit("x"), ks(F.lit(700) + s)).alias("ScreenResolution"),
        F.when(k % 3 == 0, F.concat(F.lit("AMD A"), ks(s % 10), F.lit("-Series 9420 "), ks(F.floor(s / 10)),
                                    F.lit("."), ks(s % 10), F.lit("GHz")))
        .otherwise(F.concat(F.lit("Intel Core i"), ks(k % 4 * 2 + 3), F.lit(" "), ks(k), F.lit("U "),
                            ks(F.floor(s / 10)), F.lit("."), ks(s % 10), F.lit("GHz"))).alias("Cpu"),
        F.concat(F.regexp_extract(F.col("p_brand"), r"(\d+)", 1), F.lit("GB")).alias("Ram"),
        F.element_at(F.array(F.concat(ks(s), F.lit("GB SSD +  1TB HDD")), F.concat(ks(s), F.lit("GB Flash Storage")),
                             F.lit("1.0TB Hybrid"), F.concat(ks(s * 4), F.lit("GB SSD"))),
                     (k % 4 + 1).cast("int")).alias("Memory"),
        F.col("p_name").alias("Gpu"),
        F.element_at(F.array(F.lit("Windows 10"), F.lit("macOS"), F.lit("Mac OS X"), F.lit("Linux"), F.lit("No OS")),
                     (k % 5 + 1).cast("int")).alias("OpSys"),
        F.concat(ks(F.floor(s / 10)), F.lit("."), ks(s % 10), F.when(k % 2 == 0, F.lit("kg")).otherwise(F.lit("KG")))
        .alias("Weight"),
        F.when(k % 23 == 0, F.lit(None).cast("float")).otherwise(F.col("p_retailprice").cast("float")).alias("Price"),
    )


LAPTOP_RAW_SQL = """
laptop AS (
  SELECT p_partkey AS Unname,
         CASE WHEN p_partkey % 17 = 0 THEN '' ELSE '  ' || p_brand || ' ' END AS Company,
         p_type AS TypeName,
         CAST((110 + p_size) / 10 AS FLOAT) AS Inches,
         (['IPS Panel Full HD ', 'Touchscreen 4K Ultra HD ', 'Quad HD+ ', 'Retina Display ', 'Full HD '])
           [CAST(p_partkey % 5 + 1 AS INTEGER)]
           || CAST(1000 + p_size AS VARCHAR) || 'x' || CAST(700 + p_size AS VARCHAR) AS ScreenResolution,
         CASE WHEN p_partkey % 3 = 0
              THEN 'AMD A' || CAST(p_size % 10 AS VARCHAR) || '-Series 9420 ' || CAST(p_size // 10 AS VARCHAR)
                   || '.' || CAST(p_size % 10 AS VARCHAR) || 'GHz'
              ELSE 'Intel Core i' || CAST(p_partkey % 4 * 2 + 3 AS VARCHAR) || ' ' || CAST(p_partkey AS VARCHAR)
                   || 'U ' || CAST(p_size // 10 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) || 'GHz'
         END AS Cpu,
         regexp_extract(p_brand, '(\\d+)', 1) || 'GB' AS Ram,
         ([CAST(p_size AS VARCHAR) || 'GB SSD +  1TB HDD', CAST(p_size AS VARCHAR) || 'GB Flash Storage',
           '1.0TB Hybrid', CAST(p_size * 4 AS VARCHAR) || 'GB SSD'])[CAST(p_partkey % 4 + 1 AS INTEGER)] AS Memory,
         p_name AS Gpu,
         (['Windows 10', 'macOS', 'Mac OS X', 'Linux', 'No OS'])[CAST(p_partkey % 5 + 1 AS INTEGER)] AS OpSys,
         CAST(p_size // 10 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR)
           || CASE WHEN p_partkey % 2 = 0 THEN 'kg' ELSE 'KG' END AS Weight,
         CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_retailprice AS FLOAT) END AS Price
  FROM part)
"""


# ---------------------------------------------------------------------------------------------
# Text stand-in: documents with the partial labels (left join gives natural missing values).
# ---------------------------------------------------------------------------------------------

def docs_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = read(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


DOCS_LABELLED_SQL = """
docs AS (
  SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


# ---------------------------------------------------------------------------------------------
# Training-history stand-in: events with epoch = day (1-based), batch = position within the day
# // 32, role = hashed 80/20 train/val, loss = value / 100, correct = value < 250.
# ---------------------------------------------------------------------------------------------

def events_epoch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with epoch, role, loss and correct; no batch, hence no ordering."""
    from kiln.operators.position import hash_unit
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    d0 = ev.agg(F.min(F.to_date("ts"))).first()[0]                # first day (one value)
    return (ev.withColumn("epoch", (F.datediff(F.to_date("ts"), F.lit(d0)) + 1).cast("bigint"))
            .withColumn("role", F.when(hash_unit("event_id", 42) < 0.8, "train").otherwise("val"))
            .withColumn("loss", F.col("value") / F.lit(100.0))
            .withColumn("correct", (F.col("value") < 250).cast("int")))


def events_history_rows(spark: SparkSession, sf_dir: str, batch_size: int = 32) -> DataFrame:
    from kiln.operators.analyze import broadcast_if_small
    from kiln.operators.position import with_position
    ev = events_epoch_rows(spark, sf_dir)
    # Position inside the day = global position in (ts, event_id) order minus the rows of earlier
    # days (a per-day count and a running sum over one row per day); the global index spreads a
    # busy day over many tasks, and the window runs once.
    pos = with_position(ev, ["ts", "event_id"])
    first = (ev.groupBy("epoch").agg(F.count(F.lit(1)).alias("__n"))
             .withColumn("__p0", F.coalesce(F.sum("__n").over(
                 Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("__n"))
    return (pos.join(broadcast_if_small(first), "epoch")
            .withColumn("batch", F.floor((F.col("pos") - F.col("__p0")) / batch_size).cast("bigint"))
            .drop("__p0", "pos"))


EVENTS_HISTORY_SQL = """
ev AS (SELECT event_id, ts, value,
              date_diff('day', (SELECT min(ts::DATE) FROM events), ts::DATE) + 1 AS epoch FROM events),
evb AS (SELECT event_id, epoch, value,
               (row_number() OVER (PARTITION BY epoch ORDER BY ts, event_id) - 1) // 32 AS batch,
               CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|42'), 1, 8))::BIGINT / 4294967296.0 < 0.8
                    THEN 'train' ELSE 'val' END AS role,
               value / 100.0 AS loss, CAST(value < 250 AS INTEGER) AS correct
        FROM ev)
"""
