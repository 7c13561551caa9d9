"""Text-sequence queries on documents (+ labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import text as TX
from kiln.functions.vectors import one_hot
from kiln.plans.fixtures import read
from kiln.plans.registry import query

NUM_WORDS = 10_000

TOK_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

WI_SQL = f"""
wi AS (SELECT word, count, rank FROM (
         SELECT word, count, row_number() OVER (ORDER BY count DESC, word DESC) AS rank FROM (
           SELECT word, count(*) AS count FROM (SELECT unnest({TOK_SQL}) AS word FROM documents) GROUP BY word))
       WHERE rank <= {NUM_WORDS})
"""

ENC_SQL = WI_SQL + f""",
toks AS (SELECT doc_id, unnest(tk) AS word, generate_subscripts(tk, 1) AS pos
         FROM (SELECT doc_id, {TOK_SQL} AS tk FROM documents)),
ids AS (SELECT toks.doc_id, toks.pos,
               CASE WHEN wi.rank IS NOT NULL AND wi.rank + 3 < {NUM_WORDS} THEN wi.rank + 3 ELSE 2 END AS id
        FROM toks LEFT JOIN wi ON toks.word = wi.word),
enc AS (SELECT d.doc_id,
               CASE WHEN count(ids.pos) = 0 THEN '1'
                    ELSE '1,' || string_agg(CAST(ids.id AS VARCHAR), ',' ORDER BY ids.pos) END AS seq,
               count(ids.pos) + 1 AS n_ids
        FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id GROUP BY d.doc_id)
"""


def _index(spark, sf):
    return TX.word_index(read(spark, sf, "documents"), "text", NUM_WORDS)


def _encoded(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return TX.encode(docs, "doc_id", "text", _index(spark, sf), NUM_WORDS, index_rows=NUM_WORDS)


@query("word_index", "WITH " + WI_SQL + " SELECT word, count, rank FROM wi")
def q_word_index(spark, sf):
    return _index(spark, sf)


@query("encode_tokens", "WITH " + ENC_SQL + " SELECT doc_id, n_ids, seq FROM enc")
def q_encode_tokens(spark, sf):
    enc = _encoded(spark, sf)
    return enc.select("doc_id", F.size("sequence").cast("bigint").alias("n_ids"),
                      F.array_join(F.col("sequence").cast("array<string>"), ",").alias("seq"))


@query("decode_tokens", "WITH " + ENC_SQL + """,
dec AS (SELECT d.doc_id, '? ' || coalesce(string_agg(CASE WHEN ids.id >= 3 THEN wi.word ELSE '?' END, ' ' ORDER BY ids.pos), '') AS decoded
        FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id LEFT JOIN wi ON wi.rank = ids.id - 3
        GROUP BY d.doc_id)
SELECT doc_id, rtrim(decoded) AS decoded FROM dec""")
def q_decode_tokens(spark, sf):
    dec = TX.decode(_encoded(spark, sf), "doc_id", "sequence", _index(spark, sf), index_rows=NUM_WORDS)
    return dec.select("doc_id", F.rtrim("decoded").alias("decoded"))


@query("src_sequences", "WITH " + ENC_SQL + """
SELECT enc.doc_id, l.quality AS label, enc.n_ids, enc.seq FROM enc JOIN labels l ON enc.doc_id = l.doc_id""")
def q_src_sequences(spark, sf):
    lab = read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    enc = _encoded(spark, sf).join(lab, "doc_id")
    return enc.select("doc_id", "label", F.size("sequence").cast("bigint").alias("n_ids"),
                      F.array_join(F.col("sequence").cast("array<string>"), ",").alias("seq"))


@query("multi_hot", "WITH " + ENC_SQL + """,
mh AS (SELECT d.doc_id, list_sort(list_distinct(list_concat([1], list(ids.id) FILTER (WHERE ids.id IS NOT NULL)))) AS s
       FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id GROUP BY d.doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_active, array_to_string(s, ',') AS active FROM mh""")
def q_multi_hot(spark, sf):
    enc = _encoded(spark, sf)
    mh = enc.select("doc_id", TX.multi_hot("sequence").alias("s"))
    return mh.select("doc_id", F.size("s").cast("bigint").alias("n_active"),
                     F.array_join(F.col("s").cast("array<string>"), ",").alias("active"))


@query("one_hot", """
SELECT vec_id, label, array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',')
       AS one_hot FROM embeddings""")
def q_one_hot(spark, sf):
    emb = read(spark, sf, "embeddings")
    return emb.select("vec_id", "label", F.array_join(one_hot("label", 10).cast("array<string>"), ",").alias("one_hot"))
