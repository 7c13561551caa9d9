"""Query of the exact top-k search and its SQL twin (products of whole numbers below 2^53 are exact in doubles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.segment_search import nearest


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


SQL = """
WITH v AS (SELECT vec_id, row_number() OVER () AS rid,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS y
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid AS qid, q.vec_id AS query_id, c.vec_id, c.rid, CAST(list_inner_product(q.y, c.y) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.rid <> q.rid AND len(q.y) = len(c.y)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id NULLS LAST, rid) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

QUERIES = {"op11_exact_top_k": op11_exact_top_k}
ORACLES: dict[str, str] = {"op11_exact_top_k": SQL.strip()}
