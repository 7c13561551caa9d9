"""Query of the archive converter and its SQL twin: payload digests in base 32 are worked out from the
SHA-1 in hexadecimal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.arc_warc import archived
from kiln.llm.common import table


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).drop("record_id")


_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT p.*, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(x, 1 + 10 * CAST(floor(i / 8) AS BIGINT), 10) AS BIGINT) // CAST(pow(32, 7 - i % 8) AS BIGINT)) % 32 AS BIGINT), 1)), '') AS digest
      FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM r"""

QUERIES = {"op5_warc": op5_warc}
ORACLES = {"op5_warc": _SQL}
