"""Suffix-array dedup: column-wise construction over many documents.

Every byte goes that a ``LENGTH``-byte string covers which also starts anywhere else.

1. Grouping. A ``LENGTH``-byte string is dealt by its smallest ``GRAM``-byte hash (leftmost), so equal
   strings meet and lie at the same place relative to that gram. Consecutive starts with the same gram
   form one string of at most 2·LENGTH-GRAM bytes. A gram that occurs once repeats nowhere; strings that
   occur twice as a whole repeat at all their starts; both need no further work. Of the others, those
   that share neither the ``CONTEXT`` bytes before nor those after their gram with another string of
   the group cannot share ``LENGTH`` bytes, as these hold the gram and one of the two.
2. Construction. What is left is, per gram, a collection of distinct aligned strings. From the last
   column to the first one symbol of every string is inserted per round: the order of the suffixes
   that begin one column further right, stably sorted by the new symbols, is their order now (the
   transform's last-to-first step, kept per column, since equal strings begin in the same one), and
   common prefixes of neighbours grow from the minimum between them. Where a neighbour shares
   ``LENGTH`` bytes, the start is marked. A round reads and writes its arrays in sequence.
3. Removal. Marked starts travel to their texts as ranges; the covered bytes go.

Hashes are counted by aggregates that combine before the shuffle; texts are joined by a 64-bit hash of the
text, so copies cost one construction. A gram with more than ``MAX_GROUP`` candidate strings is not
built in one task: its strings' ``LENGTH``-byte hashes are counted by a grouped aggregate instead.

Defined results: null and empty texts have 0 bytes; texts shorter than ``LENGTH`` stay whole; repeated
rows repeat each other, so all their strings go; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, slices, stored
from kiln.llm.hashing import mix, prefix_hashes, span_hashes
from kiln.llm.repeat_index import super_grams

LENGTH, GRAM = 200, 40
CONTEXT = (LENGTH - GRAM) // 2
MAX_GROUP = 50_000
AT_ONCE = 8_000            # strings that one construction takes together
MAX_BROADCAST_TEXTS = 500_000


def _strings(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            parts, keys = [], []
            for key, text in zip(b.column("tk").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                x = super_grams(text, length, gram, (length - gram) // 2)
                if len(x["start"]):
                    parts.append(x)
                    keys.append(np.full(len(x["start"]), key, np.int64))
            if parts:
                x = {k: np.concatenate([y[k] for y in parts]) for k in parts[0]}
                at = x["start"] << 24 | (x["size"] - length) << 12 | x["col"]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(at), *[pa.array(x[k].view(np.int64)) for k in "gslr"]],
                                                 names=["tk", "at", "g", "s", "l", "r"])
    return run


def _cut_strings(length: int):
    """Texts with the list of wanted strings -> (g, s, col, bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows, size = [], 0
            for text, wanted in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("wanted").to_pylist(), strict=True):
                for w in wanted:
                    start, more, col = w["at"] >> 24, w["at"] >> 12 & 0xFFF, w["at"] & 0xFFF
                    rows.append((w["g"], w["s"], col, text[start:start + more + length]))
                    size += more + length
                if size > 4 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                      names=["g", "s", "col", "bytes"])


def repeated_starts(group: np.ndarray, col: np.ndarray, strings: list[bytes], length: int) -> np.ndarray:
    """``out[i, k]``: whether the ``length`` bytes at byte k of string i stand at the same place, relative
    to its column ``col``, in another string of its group."""
    m, size = len(strings), np.array([len(x) for x in strings])
    left = int(col.max())
    width = left + int((size - col).max())
    table = np.full((width, m), 256, np.int16)          # a column is one round's symbols
    flat = np.frombuffer(b"".join(strings), np.uint8)
    string = np.repeat(np.arange(m), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(left - col, size)
    table[place, string] = flat
    starts = size - length + 1
    out = np.zeros((m, int(starts.max())), bool)
    _, rank = np.unique(group, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    levels = int(np.bincount(rank).max()).bit_length()
    common = np.zeros(m, np.int16)                      # with the neighbour before, in bytes
    for j in range(width - 1, -1, -1):
        symbol = table[j][order]
        old = np.argsort(rank[order].astype(np.int32) * 512 + symbol, kind="stable")
        new_symbol, new_rank = symbol[old], rank[order][old]
        same = np.zeros(m, bool)
        same[1:] = (new_symbol[1:] == new_symbol[:-1]) & (new_rank[1:] == new_rank[:-1]) & (new_symbol[1:] < 256)
        # least common prefix between the two places that the neighbours had before
        at = np.flatnonzero(same)
        lo, hi = old[at - 1] + 1, old[at]
        least, span = np.full(len(at), 32000, np.int16), hi - lo + 1
        row, depth = common, np.log2(span).astype(np.int64) if len(at) else span
        for k in range(levels + 1):
            mine = depth == k
            if mine.any():
                least[mine] = np.minimum(row[lo[mine]], row[hi[mine] - (1 << k) + 1])
            if not (depth > k).any():
                break
            row = np.minimum(row[:len(row) - (1 << k)], row[1 << k:])
        common = np.zeros(m, np.int16)
        common[at] = np.minimum(least + 1, length)
        order = order[old]
        hit = common >= length
        if hit.any():
            hit[:-1] |= hit[1:]
            i = order[hit]
            k = j - (left - col[i])
            ok = (k >= 0) & (k < starts[i])
            out[i[ok], k[ok]] = True
    return out


def _construct(length: int):
    """Strings of whole groups -> (g, s, lo, hi): ranges of starts that repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables)
        g, s, col = (t.column(c).to_numpy() for c in ("g", "s", "col"))
        order = np.lexsort((s, g))
        keep = np.ones(len(g), bool)
        keep[1:] = (g[order][1:] != g[order][:-1]) | (s[order][1:] != s[order][:-1])
        order = order[keep]
        g, s, col, strings = g[order], s[order], col[order], t.column("bytes").take(pa.array(order))
        ends = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g))
        i = 0
        while i < len(g):
            j = int(ends[max(np.searchsorted(ends, i + AT_ONCE, side="right") - 1, np.searchsorted(ends, i, side="right"))])
            marks = repeated_starts(g[i:j], col[i:j], strings[i:j].to_pylist(), length)
            edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, lo = np.nonzero(edge == 1)
            hi = np.nonzero(edge == -1)[1]
            yield pa.RecordBatch.from_arrays([pa.array(g[i:j][row]), pa.array(s[i:j][row]), pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64))],
                                             names=["g", "s", "lo", "hi"])
            i = j
    return run


def _windows(length: int):
    """Strings -> (g, s, place, lo, h): the hash of every ``length`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, s, col, x in zip(*[b.column(c).to_pylist() for c in ("g", "s", "col", "bytes")], strict=True):
                p = prefix_hashes(np.frombuffer(x, np.uint8))
                lo = np.arange(len(x) - length + 1)
                h = mix(span_hashes(p, lo, lo + length)).view(np.int64)
                n = len(lo)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, g)), pa.array(np.full(n, s)), pa.array(lo - col), pa.array(lo), pa.array(h)],
                                                 names=["g", "s", "place", "lo", "h"])
    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for doc_id, text, spans in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
                kept, at, removed, n_spans = hashlib.sha256(), 0, 0, 0
                if spans:
                    lo = np.array([x["lo"] for x in spans])
                    hi = np.array([x["hi"] for x in spans]) - 1 + length
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
                    for i, j in zip(lo[new].tolist(), hi[np.append(new[1:] - 1, len(hi) - 1)].tolist(), strict=True):
                        kept.update(text[at:i])
                        at, removed, n_spans = j, removed + j - i, n_spans + 1
                kept.update(text[at:])
                rows.append((doc_id, len(text), removed, n_spans, kept.hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """(tk, spans) per text that has any: ranges [lo, hi) of starts of repeated ``length``-byte strings.
    ``docs``: tk, text."""
    spark = docs.sparkSession
    found = docs.filter(F.octet_length("text") >= length).select("tk", "text").mapInArrow(
        _strings(length, gram), "tk long, at long, g long, s long, l long, r long")
    grams = found.groupBy("g").agg(F.count("*").alias("n"), F.min("s").alias("x"), F.max("s").alias("y")).filter("n > 1")
    grams = stored(grams.select("g", (F.col("x") != F.col("y")).alias("mixed")), "suffix-grams")
    again = stored(found.join(grams, "g"), "suffix-strings")

    one = again.filter("mixed").groupBy("g", "s").agg(
        F.count("*").alias("n"), F.first("l").alias("l"), F.first("r").alias("r"), F.min(F.struct("tk", "at")).alias("first"))
    one = stored(one, "suffix-distinct")
    shared = lambda c: one.filter(f"{c} <> 0").groupBy("g", c).agg(F.count("*").alias("k")).filter("k > 1").select("g", c, F.lit(True).alias(f"in_{c}"))
    some = one.join(shared("l"), ["g", "l"], "left").join(shared("r"), ["g", "r"], "left").filter("in_l OR in_r")
    some = stored(some.select("g", "s", "n", "first"), "suffix-candidates")

    wanted = stored(some.groupBy(F.col("first.tk").alias("tk")).agg(F.collect_list(F.struct("g", "s", F.col("first.at").alias("at"))).alias("wanted")), "suffix-wanted")
    texts = docs.join(broadcast_if_small(wanted.select("tk"), MAX_BROADCAST_TEXTS), "tk", "left_semi").groupBy("tk").agg(F.first("text").alias("text"))
    strings = texts.join(wanted, "tk").select("text", "wanted").mapInArrow(_cut_strings(length), "g long, s long, col int, bytes binary")
    large = some.groupBy("g").agg(F.count("*").alias("k")).filter(F.col("k") > max_group).select("g")
    large = stored(large, "suffix-large")
    plain = "g long, s long, lo long, hi long"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # at most AT_ONCE strings and one group of max_group are in a task's memory beyond its share
    parts = max(parts, some.count() // 100_000)
    if large.limit(1).count():
        strings = stored(strings, "suffix-cut")
        ranges = strings.join(F.broadcast(large), "g", "left_anti").repartition(parts, "g").mapInArrow(_construct(length), plain)
        spread = strings.join(F.broadcast(large), "g").dropDuplicates(["g", "s"]).mapInArrow(_windows(length), "g long, s long, place long, lo long, h long")
        twice = spread.groupBy("g", "place", "h").agg(F.count("*").alias("k")).filter("k > 1")
        ranges = ranges.unionByName(spread.join(twice, ["g", "place", "h"]).select("g", "s", "lo", (F.col("lo") + 1).alias("hi")))
    else:
        ranges = strings.repartition(parts, "g").mapInArrow(_construct(length), plain)

    start, starts = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(0xFFF).cast("long")) + 1
    whole = again.filter("NOT mixed").select("tk", "at").unionByName(
        again.filter("mixed").join(one.filter("n > 1").select("g", "s"), ["g", "s"]).select("tk", "at"))
    whole = whole.select("tk", start.alias("lo"), (start + starts).alias("hi"))
    partly = some.filter("n = 1").select("g", "s", "first.*").join(ranges, ["g", "s"])
    partly = partly.select("tk", (start + F.col("lo")).alias("lo"), (start + F.col("hi")).alias("hi"))
    spans = whole.unionByName(partly).distinct()
    return stored(spans.groupBy("tk").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tk"))
    spans = repeated_ranges(docs.select("tk", "text"), length, gram, max_group)
    return docs.join(spans, "tk", "left").select("doc_id", "text", "spans").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
