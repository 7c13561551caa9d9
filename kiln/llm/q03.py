"""Query of the license scans and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.licenses import LOWER, PHRASES, SHARE, TEMPLATES, UPPER, WORD, key_places, license_report


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def _sql() -> str:
    words = ",".join(f"({n},{k},'{w}',{int(k in key_places(t, keys))})" for n, (t, _, keys) in enumerate(TEMPLATES) for k, w in enumerate(t.split()))
    labels = ",".join(f"({n},'{label}',{len(key_places(t, keys))})" for n, (t, label, keys) in enumerate(TEMPLATES))
    phrase_words = ",".join(f"({n},{k},'{w}')" for n, (t, _) in enumerate(PHRASES) for k, w in enumerate(t.split()))
    phrase_labels = ",".join(f"({n},'{label}',{len(t.split())})" for n, (t, label) in enumerate(PHRASES))
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
tok AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM tok GROUP BY word),
tw AS (SELECT t.tno, t.k, t.word, t.key, ln(((SELECT count(*) FROM w) + 1) / (coalesce(df.n, 0) + 1)) + 0.01 AS wt
       FROM (VALUES {words}) t(tno, k, word, key) LEFT JOIN df USING (word)),
tl AS (SELECT l.tno, l.label, l.keys, (SELECT sum(wt) FROM tw WHERE tw.tno = l.tno) AS total FROM (VALUES {labels}) l(tno, label, keys)),
hits AS (SELECT doc_id, tno, i - k AS o, sum(wt) AS s, sum(key) AS keys FROM tok JOIN tw USING (word) GROUP BY ALL),
own AS (SELECT doc_id, label, max(round(s / total, 6)) AS score FROM hits JOIN tl USING (tno)
        WHERE hits.keys = tl.keys AND round(s / total, 6) >= {SHARE} GROUP BY ALL),
base AS (SELECT doc_id, label, o FROM (SELECT doc_id, pno, i - k AS o, count(*) AS n FROM tok
             JOIN (VALUES {phrase_words}) p(pno, k, word) USING (word) GROUP BY ALL)
         JOIN (VALUES {phrase_labels}) l(pno, label, size) USING (pno) WHERE n = size),
b AS (SELECT doc_id, count(*) AS n, min(o) AS lo, max(o) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
m AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
      FROM (SELECT doc_id, label, score FROM own UNION ALL SELECT doc_id, label, 1.0 FROM base) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(m.labels, '') AS labels, CAST(round(coalesce(m.score, 0), 4) AS DOUBLE) AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)"""


QUERIES = {"op3_license_scans": op3_license_scans}
ORACLES = {"op3_license_scans": _sql()}
