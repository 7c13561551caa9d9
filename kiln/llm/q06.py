"""Query of the packing; the test holds its pieces against the tokenizers file, text by text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.packing import packed_sequences


def tokenizer_paths() -> tuple[str, str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(table(spark, sf_dir, "documents"), tokenizer_paths())


QUERIES = {"op6_packing": op6_packing}
ORACLES: dict[str, str] = {}
