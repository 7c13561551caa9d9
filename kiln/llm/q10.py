"""Query of the quality rules. Robust fits iterate, so there is no SQL twin: the test holds the
counts against plain Python and the estimates against NumPy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.quality_mcd import robust_quality


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_quality(table(spark, sf_dir, "documents"), carry=["doc_id"])


QUERIES = {"op10_quality_rules": op10_quality_rules}
ORACLES: dict[str, str] = {}
