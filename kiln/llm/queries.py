"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kiln.llm import q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _m in (q01, q02, q03, q04, q05, q06, q07, q08, q09, q10, q11, q12, q13):
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
