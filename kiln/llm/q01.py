"""Query of the secret scans and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.secret_links import BASE, KINDS, NEEDS, REACH, SCOPE, secret_report


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    ok = {"assign": f"length(regexp_extract(m, {quoted(KINDS[0][2])}, 2)) >= 6",
          "opaque": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"}
    found = "\nUNION ALL\n".join(f"""
    SELECT doc_id, {no} AS no, ends[i] - length(ms[i]) AS s, ends[i] AS e, {ok.get(kind, 'true').replace('(m,', '(ms[i],')} AS ok
    FROM (SELECT doc_id, ms, list_transform(ms, lambda x, i: CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                 + list_sum(list_transform(ms[1:i], lambda g: length(g))) AS BIGINT)) AS ends
          FROM (SELECT doc_id, regexp_extract_all(t, {quoted(p)}, 0) AS ms, string_split_regex(t, {quoted(p)}) AS gaps
                FROM docs WHERE regexp_matches(t, {quoted(p)}))), unnest(range(1, len(ms) + 1)) AS u(i)"""
                                  for no, (kind, _, p) in enumerate([*KINDS, ("scope", "", SCOPE)]))
    roles = {r: ",".join(str(i) for i, k in enumerate(KINDS) if k[1] == r) for r in ("identifier", "secret", "endpoint")}
    near = lambda r: (f"EXISTS (SELECT 1 FROM clean o WHERE o.doc_id = c.doc_id AND o.scope = c.scope AND o.no IN ({roles[r]}) "  # noqa: E731
                      f"AND o.s <= c.e + {REACH} AND o.e >= c.s - {REACH})")
    kept = " OR ".join([f"c.no < {len(BASE)}"] + [f"(c.no = {no} AND ({' OR '.join(near(r) for r in NEEDS[k])}))"
                                                   for no, (k, _, _p) in enumerate(KINDS) if k in NEEDS])
    name = "CASE no " + " ".join(f"WHEN {i} THEN '{k[0]}'" for i, k in enumerate(KINDS)) + " END || ':' || s || ':' || e"
    n = len(KINDS)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (SELECT f.*, (SELECT count(*) FROM found b WHERE b.doc_id = f.doc_id AND b.no = {n} AND b.s <= f.s) AS scope
           FROM found f WHERE ok AND no < {n}),
clean AS (SELECT * FROM placed p WHERE NOT (no = {n - 1} AND EXISTS (
            SELECT 1 FROM placed o WHERE o.doc_id = p.doc_id AND o.scope = p.scope AND o.no <> {n - 1} AND o.s < p.e AND o.e > p.s))),
kept AS (SELECT * FROM clean c WHERE {kept}),
listed AS (SELECT doc_id, {', '.join(f'count(*) FILTER (no = {i}) AS n_{k}' for i, k in enumerate(BASE))},
                  string_agg({name}, ',' ORDER BY s, no, e) FILTER (no < {len(BASE)}) AS base,
                  string_agg({name}, ',' ORDER BY s, no, e) AS spans FROM kept GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs d LEFT JOIN listed USING (doc_id)"""


QUERIES = {"op1_secret_scans": op1_secret_scans}
ORACLES = {"op1_secret_scans": _sql()}
