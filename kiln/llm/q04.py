"""Query of the sharding; random orders have no SQL form: the test checks the law, the slots and that
every record arrives once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.sharding import record_size, sharded


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", record_size().alias("size"),
                      F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLES: dict[str, str] = {}
