"""Registry of named queries and their SQL twins.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables; ``sql`` is the same
result written for a plain SQL engine over views of the same tables (None when the operator
is not expressible in SQL – e.g. model fits and streams).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    """Import every query module (registration happens at import)."""
    from kiln.plans import (q_data, q_features, q_metrics, q_models, q_streaming, q_text,  # noqa: F401
                            q_training, q_user, q_validation, q_vectors)
    return QUERIES, ORACLES
