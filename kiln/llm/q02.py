"""Query of the benchmark decontamination; the test holds it against brute-force subsequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.latent_search import contaminated


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_benchmark_decontamination": op2_benchmark_decontamination}
ORACLES: dict[str, str] = {}
