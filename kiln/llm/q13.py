"""Query of the spelling variants; the test holds it against all pairs by brute force (SQL engines
without the checksum can't state the words)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.trie_variants import spelling_variants


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLES: dict[str, str] = {}
