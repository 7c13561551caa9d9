"""Query of the suffix-array dedup; the test holds it against counts of all 200-byte strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.suffix_dedup import without_repeats


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


QUERIES = {"op8_suffix_array_dedup": op8_suffix_array_dedup}
ORACLES: dict[str, str] = {}
