"""Packing: shortest-pack-first over the length histogram.

Every document is its token ids and an end id. Ids are cut into whole sequences of ``LENGTH`` and a
rest; the rests are packed. Lengths (at most ``LENGTH`` different ones) are counted; the histogram
alone goes to the driver. Lengths are placed longest first, each into the open pack with the most
room – the shortest pack – or into a new one; what is stored is patterns (lists of lengths) with
counts, not packs, so the work depends on the histogram's size only. A pattern that takes part of a
count is split. Finally the patterns are joined back to the documents by rank: the pieces of a length
are numbered, and each place of a pattern owns a range of these numbers.

Ranks are exact and need no single large window: the pieces of a length are dealt by a stored row
number into sub-groups, as many as its count asks for, and a window numbers each sub-group.

Ids. ``encode`` gives the ids of the ``tokenizers`` file. Texts of plainly spaced words go word by
word through a bounded cache (a single space before a non-space always begins a new pre-token), with
``tiktoken`` on the same vocabulary for words not seen; all other texts go through ``tokenizers`` whole.

Defined results: null or empty texts are the end id alone; repeated rows are packed each; an empty
table gives no rows; extra columns are ignored; texts of any length are cut, never shortened.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, slices, stored

LENGTH = 2048
END_ID = 1
CACHE_BYTES = 64 << 20    # words and ids that a task keeps
CACHED_WORD = 64          # code points of the longest word that is kept
MAX_BROADCAST_GROUPS = 200_000
_UNEVEN = re.compile(r" \s| \Z|<\|")


class Encoder:
    """Ids as little-endian 32-bit bytes."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = _Words(tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)

    def encode(self, text: str) -> bytes:
        if _UNEVEN.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, _, rest = text.partition(" ")
        ids = array("I", self.words.ids(first)).tobytes()
        return ids + b"".join([self.words[w] for w in rest.split(" ")]) if rest else ids


class _Words(dict):
    """Ids of words; the short ones are kept until their objects take ``CACHE_BYTES``."""

    def __init__(self, ids):
        super().__init__()
        self.ids, self.held = ids, 0

    def __missing__(self, word: str) -> bytes:
        out = array("I", self.ids(" " + word)).tobytes()
        if len(word) <= CACHED_WORD:
            size = sys.getsizeof(word) + sys.getsizeof(out)
            if self.held + size > CACHE_BYTES:
                self.clear()
                self.held = 0
            self[word] = out
            self.held += size
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def _pieces(paths: tuple[str, str, str], length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if paths not in _ENCODERS:
            _ENCODERS[paths] = Encoder(*paths)
        enc, tail = _ENCODERS[paths], array("I", [end_id]).tobytes()
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = enc.encode(text or "") + tail
                n = len(ids) // 4
                for start in range(0, n, length):
                    stop = min(start + length, n)
                    rows.append((doc_id, start, stop - start, zlib.crc32(ids[4 * start:4 * stop]), n))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def pack_histogram(counts: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first: (lengths, how many packs) for a histogram of lengths."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}   # open patterns by the room left
    done: list[tuple[tuple[int, ...], int]] = []
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            most = max(room, default=0)
            if most < size:                       # no open pack takes it: new packs
                pattern, have = (), left
            else:
                pattern, have = room[most].pop()
                if not room[most]:
                    del room[most]
            use = min(left, have)
            if use < have:                        # the rest of this pattern stays open
                room.setdefault(most, []).append((pattern, have - use))
            new, space = (*pattern, size), (most if pattern else length) - size
            (room.setdefault(space, []) if space else done).append((new, use))
            left -= use
    return done + [x for xs in room.values() for x in xs]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Ranges of ranks per length: rank r of ``size`` in [first, first + count) is at ``offset`` of
    the sequence base + r - first."""
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for lengths, count in patterns:
        offset = 0
        for size in lengths:
            first = next_rank.get(size, 0)
            rows.append((size, first, base, offset))
            next_rank[size] = first + count
            offset += size
        base += count
    rows.sort()
    return dict(zip(("size", "first", "base", "offset"), np.array(rows, np.int64).reshape(-1, 4).T, strict=True))


def _placed(places: dict[str, np.ndarray]):
    key = (places["size"] << 48) + places["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank, size = (b.column(c).to_numpy() for c in ("_rank", "length"))
            at = np.searchsorted(key, (size << 48) + rank, side="right") - 1
            keep = [i for i, c in enumerate(b.schema.names) if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in keep], pa.array(places["base"][at] + rank - places["first"][at]), pa.array(places["offset"][at])],
                names=[*[b.schema.names[i] for i in keep], "sequence_id", "offset"])
    return run


def packed_sequences(docs: DataFrame, paths: tuple[str, str, str], length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``paths``: the tokenizers file, the same vocabulary as ranks, the pre-token pattern."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(paths, length, end_id), schema)
    pieces = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(pack_histogram(counts, length))

    groups = 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(sum(counts.values()) // groups, 1)
    salts = F.lit(1)
    if heavy := [(n, c) for n, c in counts.items() if c > most]:
        shares = F.create_map(*[F.lit(x).cast("long") for n, c in heavy for x in (n, -(-c // most))])
        salts = F.coalesce(F.try_element_at(shares, F.col("length")), F.lit(1))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_row"), salts.cast("long")))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    offsets = stored(offsets.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "pack-offsets")
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1
    ranked = salted.withColumn("_at", rank).join(broadcast_if_small(offsets, MAX_BROADCAST_GROUPS), ["length", "_salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_before") + F.col("_at")).alias("_rank"))
    return ranked.mapInArrow(_placed(places), schema + ", sequence_id long, offset long")
