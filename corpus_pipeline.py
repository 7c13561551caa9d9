"""The corpus pipeline: stages over the documents table, each written as Parquet and read again.

Quality rules drop junk, the Jaccard join keeps one document of each group of near duplicates,
decontamination drops documents that hold a benchmark item, the secret scan masks credentials in
the texts, and packing returns the sequences' pieces.

The join and the decontamination decide by a row's key, a 64-bit hash of its doc_id and text, so rows
that share a doc_id or have none are judged by their own texts. Defined results: null, empty and very
short texts fail the quality rules; of linked rows the one with the smallest doc_id stays (a null one
after all others), of rows equal in doc_id and text the one whose JSON form is smallest; texts without
words are linked with nothing; an empty table gives no rows; extra columns are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, scratch_path, stored, table, whole_row
from kiln.llm.latent_search import contaminated
from kiln.llm.packing import packed_sequences
from kiln.llm.parity_join import near_duplicates
from kiln.llm.q06 import tokenizer_paths
from kiln.llm.quality_mcd import robust_quality
from kiln.llm.secret_links import redacted

MAX_BROADCAST_KEYS = 500_000


def row_key() -> Column:
    """Names a row by its doc_id and text; nulls are told from each other and from values."""
    cols = [F.col("doc_id"), F.col("text")]
    return F.xxhash64(*[c.isNull() for c in cols], *cols)


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows (``_row``, ``_key``) of ``docs`` whose key is in ``keys``, or is not."""
    return docs.select(whole_row(docs), row_key().alias("_key")).join(broadcast_if_small(keys, MAX_BROADCAST_KEYS), "_key", how)


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return robust_quality(docs).filter("kept").select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    found = near_duplicates(docs.select(row_key().alias("doc_id"), "text")).filter("n_shingles > 0")
    keys = stored(found.groupBy(F.col("doc_id").alias("_key"))
                  .agg(F.first("component_id").alias("component_id"), F.count("*").alias("copies")), "stage-groups")
    several = stored(keys.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id"), "stage-several")
    linked = stored(keys.join(broadcast_if_small(several, MAX_BROADCAST_KEYS), "component_id", "left_semi")
                    .select("_key", "component_id"), "stage-linked")
    ids = docs.select("doc_id", row_key().alias("_key")).join(broadcast_if_small(linked, MAX_BROADCAST_KEYS), "_key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    stays = stored(ids.groupBy("component_id").agg(F.min_by("_key", order).alias("stays")), "stage-stays")
    gone = stored(linked.join(broadcast_if_small(stays, MAX_BROADCAST_KEYS), "component_id")
                  .filter("_key <> stays").select("_key"), "stage-copies")
    equal = stored(keys.filter("copies > 1").join(broadcast_if_small(gone, MAX_BROADCAST_KEYS), "_key", "left_anti").select("_key"), "stage-equal")
    single = _by_key(docs, gone.unionByName(equal), "left_anti").select("_row")
    one = _by_key(docs, equal, "left_semi").groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return _columns(single.unionByName(one), docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = contaminated(docs.select(row_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = stored(found.select(F.col("doc_id").alias("_key")).distinct(), "stage-leaks")
    return _columns(_by_key(docs, gone, "left_anti"), docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported spans are masked in the texts; every document stays."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed_sequences(docs, tokenizer_paths())


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", jaccard_join),
          ("benchmark decontamination", benchmark_decontamination), ("secret scans", secret_scans), ("packing", packing)]

#: Robust fits and tokenisation have no SQL form; tests hold the join and the decontamination against
#: brute force on awkward rows, and run() against the stages called one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
