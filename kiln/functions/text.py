"""Text → integer sequences and back, multi-hot sets.

Tokenising is a SQL expression; the word index is a distributed count plus a bounded top-k;
encoding maps each document's tokens through a bounded index inside its own task with Arrow
compute kernels (``mapInArrow``), or – for an unbounded index – explodes tokens, joins and
regroups per document in token order. Sequences stay sparse: multi-hot is the sorted set of active indices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.analyze import vocab_build

# Word tokens: maximal runs of Unicode letters and digits after lower-casing.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# Reserved ids of integer sequences (fixed values): 0 padding, 1 start of sequence, 2 out of
# vocabulary; word ids start after them (rank + 3).
PAD, START, OOV, INDEX_FROM = 0, 1, 2, 3


def tokens(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    # array_remove is a built-in (code-generated); a filter lambda would be interpreted per token.
    return F.array_remove(F.split(F.lower(t), TOKEN_SPLIT), "")


def word_index(df: DataFrame, text: str, num_words: int | None = None) -> DataFrame:
    """(word, count, rank): rank 1 is the most frequent word (ties by word descending), at most
    ``num_words`` ranks when a cap is given."""
    words = df.select(F.explode(tokens(text)).alias("w"))
    v = vocab_build(words, "w", top_k=num_words, term="word")
    return v.select("word", "count", (F.col("id") + 1).cast("bigint").alias("rank"))


# A word index up to this many entries is shipped to the tasks and looked up in place (no shuffle
# of tokens); larger ones go through the explode → join → regroup path.
IN_TASK_LOOKUP_MAX = 250_000
PIECE = 1 << 17          # list entries that a task looks up at a time


def _bounded_rows(index: DataFrame, index_rows: int | None) -> list | None:
    """The index's rows when there are at most ``IN_TASK_LOOKUP_MAX`` (checked, whatever size is
    claimed), else None. Both paths give the same rows; only the plan differs."""
    if index_rows is not None and index_rows > IN_TASK_LOOKUP_MAX:
        return None
    rows = index.select("word", "rank").limit(IN_TASK_LOOKUP_MAX + 1).collect()
    return rows if len(rows) <= IN_TASK_LOOKUP_MAX else None


def _pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Batches of (key, list) in pieces of about ``most`` list entries, one row at least, so that what a task
    makes of one at a time stays small whatever the batch and the texts are like."""
    for b in batches:
        ends = b.column(1).offsets.to_numpy()
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, side="right")) - 1)
            yield b.slice(i, j - i)
            i = j


def encode(df: DataFrame, key: str, text: str, index: DataFrame, num_words: int, out: str = "sequence",
           index_rows: int | None = None) -> DataFrame:
    """Text → [START] + word ids (rank + 3, or OOV when rank + 3 >= num_words).

    ``index_rows`` is the index's expected size (e.g. the cap it was built with). A bounded index is
    collected once (model-sized) and every task maps its rows' tokens through it, batch by batch,
    so documents are never exploded and regrouped. Otherwise tokens are exploded, joined with the
    index and regrouped per document in token order.
    """
    rows = _bounded_rows(index, index_rows)
    if rows is not None:
        pairs = [(r["word"], int(r["rank"]) + INDEX_FROM) for r in rows]
        pairs = [(w, i) for w, i in pairs if i < num_words]
        words = pa.array([w for w, _ in pairs], type=pa.string())
        ids = pa.array([i for _, i in pairs], type=pa.int64())
        toks = "__kiln_toks"
        src = df.select(key, F.coalesce(tokens(text), F.array().cast("array<string>")).alias(toks))

        def _encode(batches):
            # Arrow kernels end to end: one hash lookup for all tokens of a batch, lists rebuilt
            # from the original offsets; no Python object per token.
            import pyarrow.compute as pc
            for b in _pieces(batches):
                lists = b.column(1)
                pos = pc.index_in(lists.flatten(), value_set=words)
                mapped = pc.fill_null(pc.take(ids, pos), OOV)
                offsets = pc.subtract(lists.offsets, lists.offsets[0])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, mapped)],
                                                 names=[key, out])

        schema = T.StructType([df.schema[key], T.StructField(out, T.ArrayType(T.LongType()))])
        coded = src.mapInArrow(_encode, schema)
        return coded.select(key, F.concat(F.array(F.lit(START).cast("bigint")), F.col(out)).alias(out))

    # rows are regrouped by an id of their own: a key may repeat
    pos, word, wid, tid, row = "__kiln_pos", "__kiln_word", "__kiln_wid", "__kiln_tid", "__kiln_row"
    toks = (df.select(key, text, F.monotonically_increasing_id().alias(row))
            .select(row, key, F.posexplode_outer(tokens(text)).alias(pos, word)))
    ids = index.select(F.col("word").alias(word), (F.col("rank") + INDEX_FROM).alias(wid))
    j = toks.join(ids, word, "left").withColumn(
        tid, F.when(F.col(pos).isNull(), F.lit(None))
        .when(F.col(wid).isNotNull() & (F.col(wid) < num_words), F.col(wid)).otherwise(F.lit(OOV)))
    per_doc = j.groupBy(row, key).agg(
        F.array_sort(F.collect_list(F.when(F.col(pos).isNotNull(),
                                           F.struct(F.col(pos).alias("p"), F.col(tid).alias("i"))))).alias("__p"))
    return per_doc.select(key, F.concat(F.array(F.lit(START).cast("bigint")),
                                        F.transform("__p", lambda s: s["i"].cast("bigint"))).alias(out))


def decode(df: DataFrame, key: str, seq: str, index: DataFrame, out: str = "decoded",
           index_rows: int | None = None) -> DataFrame:
    """Integer sequence → words joined by spaces; id i maps to the word of rank i-3, else '?'. A null
    sequence decodes to null, an empty one to ''."""
    rows = _bounded_rows(index, index_rows)
    if rows is not None:
        inverse = {int(r["rank"]) + INDEX_FROM: r["word"] for r in rows}
        top = max(inverse, default=0)
        by_id = ["?"] * (top + 2)                                  # last slot: ids outside the index
        for i, w in inverse.items():
            by_id[i] = w
        by_id = pa.array(by_id, type=pa.string())
        ids = "__kiln_ids"
        src = df.select(key, F.col(seq).cast("array<bigint>").alias(ids))

        def _decode(batches):
            import pyarrow.compute as pc
            for b in _pieces(batches):
                lists = b.column(1)
                flat = lists.flatten()
                inside = pc.and_(pc.greater_equal(flat, 0), pc.less_equal(flat, top))
                words = pc.take(by_id, pc.if_else(inside, flat, top + 1))
                offsets = pc.subtract(lists.offsets, lists.offsets[0])
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")
                joined = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), joined)
                yield pa.RecordBatch.from_arrays([b.column(0), joined], names=[key, out])

        schema = T.StructType([df.schema[key], T.StructField(out, T.StringType())])
        return src.mapInArrow(_decode, schema)

    pos, tid, word, row, none = "__kiln_pos", "__kiln_tid", "__kiln_word", "__kiln_row", "__kiln_none"
    items = (df.select(key, seq, F.col(seq).isNull().alias(none), F.monotonically_increasing_id().alias(row))
             .select(row, key, none, F.posexplode_outer(seq).alias(pos, tid)))
    inv = index.select((F.col("rank") + INDEX_FROM).alias(tid), F.col("word").alias(word))
    j = items.join(inv, tid, "left").withColumn(word, F.coalesce(word, F.lit("?")))
    per_doc = j.groupBy(row, key, none).agg(
        F.array_sort(F.collect_list(F.when(F.col(pos).isNotNull(),
                                           F.struct(F.col(pos).alias("p"), F.col(word).alias("w"))))).alias("__p"))
    text = F.coalesce(F.array_join(F.transform("__p", lambda s: s["w"]), " "), F.lit(""))
    return per_doc.select(key, F.when(~F.col(none), text).alias(out))


def multi_hot(seq: Column | str) -> Column:
    """Set of active columns (each index once, sorted) – the sparse form of a 0/1 row."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.array_sort(F.array_distinct(s))


def multi_hot_vector(df: DataFrame, seq: str, dim: int, out: str = "features") -> DataFrame:
    """Multi-hot as an ML sparse vector of width ``dim`` (indices >= dim are dropped).

    A binary ``CountVectorizerModel`` whose vocabulary is the index strings "0".."dim-1" maps each
    index to its own column, JVM-side and sparse (the vocabulary is model-sized, not data-sized).
    """
    from pyspark.ml.feature import CountVectorizerModel
    tmp = "__kiln_idx"
    cv = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol=tmp, outputCol=out,
                                              binary=True)
    return cv.transform(df.withColumn(tmp, F.transform(multi_hot(seq), lambda x: x.cast("string")))).drop(tmp)
