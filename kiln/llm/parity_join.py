"""N-gram Jaccard join with parity sketches.

A text is the set of its distinct 5-word shingles; two texts link when 100·|A∩B| >= 75·|A∪B|.

Sketch. For a size band, tokens are dealt to ``m`` words of 64 bits and each token XORs its hash
into its word, so every bit is a parity. A token that only one of two sets has changes one word, so
the number of words that differ is at most |AΔB|, which for a link is at most (|A|+|B|)/7. Bands
grow by 4/3, hence linked sets lie in the same or in neighbouring bands; each set is sketched for
its own band and for the next one.

Pigeonhole. Of ``m`` words at least m-d agree. Under one order of (place, value) that both sets
share, the first d+1 words of the two sketches must then have a common one, so only these are
joined. The order goes by the frequency of a word's rarest token, in steps of a factor of two, so a
passage that many texts share is joined on only by texts with too few rarer words of their own; words
without tokens come last. Frequencies come from a count sketch over the shingles of all texts, whose
size follows the corpus (up to ``MAX_CELLS``); it only steers the order, the guarantee holds for any.

Candidates and verification. Sets that are equal are one class. Words travel packed (8 bytes each)
to the partition of their hash, and words that the same classes share become one. Two rounds verify each class against one centre: of each word's
classes the centre is the one whose words are shared most (an original before its copies), in round
2 the best one outside the first centre's component; what links is contracted. Then, for words whose
classes are still in several components, pairs from different components are joined under the size
and parity bounds. Near copies share hundreds of words, so there the words that have most classes in the
same component count as one if that makes no more pairs. So a large group of copies costs as many pairs as it has texts. Every candidate
first compares parity bits (2 to 4 a token), whose Hamming distance bounds |AΔB| from below as well,
and is then verified on the whole sets. Words made of frequent tokens only, which very many texts may
share, are split over ``SALTS`` sub-groups; centres are grouped maxima, so no word's classes meet in
one task.

Defined results: null or empty texts and texts of white space have no shingles and are their own
component; texts of fewer than five words are one shingle; a null doc_id stays null and never names
a component that has another id; repeated rows get equal results; an empty table gives no rows.
Classes are named by 64-bit set hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, slices, stored
from kiln.llm.components import connected_components
from kiln.llm.hashing import mix, shingle_sets

MIN_CELLS, MAX_CELLS = 1 << 18, 1 << 24  # cells of the count sketch; half a byte each where it is shipped
BYTES_PER_CELL = 64       # text bytes behind one cell, between these bounds
CHUNK = 1 << 16           # cells in a row of the sketch
BYTES_PER_PART = 12 << 20  # text bytes behind one partition of packed words
SALTS = 64
MAX_LIST = 4096           # classes in one row; words with more take a row for each
MAX_BROADCAST_IDS = 500_000

_U = np.uint64


def band_bounds(top: int = 160) -> np.ndarray:
    """bounds[j] = least size of band j, exactly (4/3)^j rounded up."""
    return np.array([-(-(4 ** j) // (3 ** j)) for j in range(top) if 4 ** j // 3 ** j < 2 ** 60], np.int64)


BOUNDS = band_bounds()


def _class_of(s: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    if not len(s):
        return 0
    x = mix(mix(s) + _U(0x51ED270B)).sum(dtype=np.uint64) ^ mix(np.array([len(s)], _U))[0]
    return int(x.astype(np.int64)) or 1


def parity_bits(s: np.ndarray) -> bytes:
    """Parities of the set's tokens over 2 to 4 bits a token (a power of two, 256 at least)."""
    size = max(256, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & _U(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def parity_words(s: np.ndarray) -> list[int]:
    """Parities over ``8 * 64`` bits as signed words, for the bound inside the pair join."""
    b = (np.bincount((s & _U(511)).astype(np.int64), minlength=512) & 1).astype(np.uint8)
    return np.packbits(b).view(np.int64).tolist()


def parity_distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the longer folded to the shorter's size: never more than
    the number of tokens that one set has and the other lacks."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _texts(col: pa.Array) -> list[bytes]:
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def _classes(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc rows -> (doc_id, n, class, parity bits, parity words), and at the end the task's count sketch in rows
    of (null, -1 - chunk, null, packed counts, null)."""
    shift = _U(65 - cells.bit_length())
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("bits", pa.binary()),
                        ("words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in slices(batches):
            sets = shingle_sets(_texts(batch.column("text")))
            for s in sets:
                np.add.at(counts, (s >> shift).astype(np.int64), np.uint32(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([parity_bits(s) for s in sets], pa.binary()),
                 pa.array([parity_words(s) for s in sets], pa.list_(pa.int64()))], schema=schema)
        for i in range(0, cells, CHUNK):
            if (part := counts[i:i + CHUNK]).any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.array([-1 - i // CHUNK], pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([zlib.compress(np.minimum(part, 255).astype(np.uint8).tobytes(), 1)], pa.binary()),
                     pa.nulls(1, pa.list_(pa.int64()))], schema=schema)
    return run


def _grades(mean: float, unit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of chunks -> (n, grades): 0 for a cell that holds at most ``unit`` texts beyond the mean,
    one more for each doubling (at most 14), two to a byte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, part in zip(batch.column("n").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(part), np.uint8)
                sums[n] = sums[n] + counts if n in sums else counts.astype(np.int64)
        for n, counts in sums.items():
            beyond = np.maximum(counts - int(mean), 0) // unit
            grade = np.minimum(np.frexp(beyond.astype(float))[1], 14).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(grade[::2] << 4 | grade[1::2]).tobytes()], pa.binary())],
                                             names=["n", "grades"])
    return run


NO_TOKEN = 15             # the grade of a word without tokens


def sketch_words(s: np.ndarray, band: int, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of ``s`` that the join of ``band`` needs, and the grade of the rarest token of
    each. ``grades``: per token, how frequent it is (0 to 14)."""
    low, high = int(BOUNDS[band]), int(BOUNDS[band + 1]) - 1
    n = len(s)
    d = (n + min(high, 4 * n // 3)) // 7
    m = max(int(low * 0.55) + 1, 2 * high // 7 + 1, d + 1)
    t = mix(s + _U((band + 1) * 0xD1B54A32D192ED03 % 2**64))
    place = ((t >> _U(32)) * _U(m)) >> _U(32)
    order = np.argsort(place, kind="stable")
    at, first, size = np.unique(place[order], return_index=True, return_counts=True)
    words, many, rares, rarest = np.zeros(m, _U), np.zeros(m, _U), np.zeros(m, _U), np.full(m, NO_TOKEN, _U)
    words[at] = np.bitwise_xor.reduceat(mix(t)[order], first)
    rarest[at] = np.minimum.reduceat(grades[order], first)
    many[at], rares[at] = size, np.add.reduceat((grades[order] == 0).astype(np.int64), first)
    key = mix(words ^ mix(np.arange(m, dtype=_U) + _U(band) * _U(1 << 32)))
    rank = rarest << _U(59) | (_U(1023) - np.minimum(rares, _U(1023))) << _U(49)
    rank |= (_U(1023) - np.minimum(many, _U(1023))) << _U(39) | key >> _U(25)
    take = np.argpartition(rank, d)[:d + 1] if d + 1 < m else np.arange(m)
    return key[take], rarest[take]


def _packed_words(parts: int, packed: bytes, frequent: int):
    """docs -> (part, keys, owners, classes): the words of a batch of texts, packed by partition.
    keys: the upper 32 bits of each word; owners: the class's index in ``classes``, its highest
    bit set for words whose tokens all have the grade ``frequent`` or more, which are dealt by class as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.frombuffer(packed, np.uint8)
        cells = np.stack((pairs >> 4, pairs & 15), axis=1).ravel()
        shift = _U(65 - len(cells).bit_length())
        for batch in slices(batches, 1_000):
            keys, owners, common, names, seen = [], [], [], [], {}
            for s in shingle_sets(_texts(batch.column("text"))):
                if not len(s) or (c := _class_of(s)) in seen:
                    continue
                seen[c] = len(names)
                names.append(c)
                grades = cells[(s >> shift).astype(np.int64)]
                home = int(np.searchsorted(BOUNDS, len(s), side="right")) - 1
                for band in (home, home + 1):
                    k, rarest = sketch_words(s, band, grades)
                    keys.append(k)
                    common.append(rarest >= frequent)
                    owners.append(np.full(len(k), seen[c], np.uint32))
            if not names:
                continue
            key, own, plain = np.concatenate(keys), np.concatenate(owners), np.concatenate(common)
            salt = np.where(plain, mix(np.array(names, np.int64).view(_U))[own] % _U(SALTS) + _U(1), _U(0))
            part = ((key & _U(0xFFFFFFFF)) + salt * _U(7919)) % _U(parts)
            own = own | (plain.astype(np.uint32) << np.uint32(31))
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=_U))
            key32, own, all_names = (key >> _U(32)).astype(np.uint32)[order], own[order], np.array(names, np.int64)
            rows = []
            for p in range(parts):
                i, j = cut[p], cut[p + 1]
                if i < j:
                    local, index = np.unique(own[i:j] & np.uint32(0x7FFFFFFF), return_inverse=True)
                    o = index.astype(np.uint32) | (own[i:j] & np.uint32(0x80000000))
                    rows.append((p, key32[i:j].tobytes(), o.tobytes(), all_names[local].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                names=["part", "keys", "owners", "classes"])
    return run


def _grouped(cls: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the groups ``cls[first[i]:first[i] + size[i]]`` (sorted) one of each equal several: (first, size, how many).
    Groups are compared by two 64-bit sums of their members' hashes."""
    if not len(first):
        return first, size, size
    at = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    names = cls[at].view(_U)
    x, y = (np.add.reduceat(mix(names ^ _U(seed)), starts) for seed in (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15))
    order = np.lexsort((size, y, x))
    x, y, first, size = x[order], y[order], first[order], size[order]
    new = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (size[1:] != size[:-1]))))
    return first[new], size[new], np.diff(np.append(new, len(x)))


def _shared_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed words of some partitions -> (word, classes, weight). Words that the same two or more classes
    share are one row (null, those classes, number of words). Rows (word, one class, size) stand for words
    with over ``MAX_LIST`` classes and for words of frequent tokens, which other sub-groups may share too."""
    part, key, cls, flag = [], [], [], []
    for b in batches:
        for p, k, o, c in zip(*(b.column(x).to_pylist() for x in ("part", "keys", "owners", "classes")), strict=True):
            o = np.frombuffer(o, np.uint32)
            key.append(np.frombuffer(k, np.uint32))
            part.append(np.full(len(o), p, np.int32))
            cls.append(np.frombuffer(c, np.int64)[o & np.uint32(0x7FFFFFFF)])
            flag.append((o >> np.uint32(31)).astype(bool))
    if not key:
        return
    key, part, cls, flag = map(np.concatenate, (key, part, cls, flag))
    word = (part.astype(np.int64) << 32) | key.astype(np.int64)
    order = np.lexsort((cls, word))
    word, cls, flag = word[order], cls[order], flag[order]
    keep = np.ones(len(word), bool)
    keep[1:] = (word[1:] != word[:-1]) | (cls[1:] != cls[:-1])
    word, cls, flag = word[keep], cls[keep], flag[keep]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    size = np.diff(np.append(first, len(word)))
    single = np.logical_or.reduceat(flag, first)
    listed = ~single & (size > 1) & (size <= MAX_LIST)
    names = ["word", "classes", "weight"]
    start, length, weight = _grouped(cls, first[listed], size[listed])
    for i in range(0, len(start), 1 << 14):
        z = length[i:i + (1 << 14)]
        ends = np.concatenate(([0], np.cumsum(z)))
        at = np.repeat(start[i:i + (1 << 14)] - ends[:-1], z) + np.arange(ends[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(z), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cls[at])),
             pa.array(weight[i:i + (1 << 14)], pa.int64())], names=names)
    # sub-groups of one word differ in the partition; the key alone names them
    rest = np.flatnonzero(flag | np.repeat(~listed & (size > 1), size))
    size = np.repeat(size, size)
    for i in range(0, len(rest), 1 << 16):
        at = rest[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(flag[at], -1 - (word[at] & 0xFFFFFFFF), word[at])),
             pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1), pa.int32()), pa.array(cls[at])),
             pa.array(size[at], pa.int64())], names=names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        sets = shingle_sets(_texts(b.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "tokens"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        a, b = [], []
        cols = [batch.column(x).to_pylist() for x in ("a", "b", "ta", "tb")]
        for x, y, s, t in zip(*cols, strict=True):
            s, t = np.frombuffer(s, _U), np.frombuffer(t, _U)
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= 75 * (len(s) + len(t) - both):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities do not rule out a link."""
    for batch in batches:
        a, b = [], []
        for x, y, n, m, s, t in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb")], strict=True):
            if 4 * min(n, m) >= 3 * max(n, m) and 7 * parity_distance(s, t) <= n + m:
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verify(docs: DataFrame, members: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of classes whose sets link: first the parity bits, then the whole sets, built
    again from the text of one document of each class that is left in a pair."""
    side = lambda x: members.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"s{x}"))
    pairs = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_close, "a long, b long"), f"{name}-pairs")
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    ids = stored(members.join(wanted, "class", "left_semi").select(F.col("rep").alias("doc_id"), F.col("class").alias("_c")), f"{name}-ids")
    # one row of each document, whichever of its texts has the class that is wanted
    some = docs.join(broadcast_if_small(ids.select(F.col("doc_id").alias("_id")), MAX_BROADCAST_IDS),
                     F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets = some.mapInArrow(_sets, "class long, tokens binary").join(
        broadcast_if_small(ids.select(F.col("_c").alias("class")), MAX_BROADCAST_IDS), "class", "left_semi")
    sets = stored(sets.groupBy("class").agg(F.first("tokens").alias("tokens")), f"{name}-sets")
    full = (pairs.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return stored(full.mapInArrow(_verified, "a long, b long"), f"{name}-edges")


def _open(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows (with ``comp``) of the words whose classes are in more than one component."""
    named = rows.join(comp.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("comp", F.coalesce("component", "class")).drop("component")
    words = named.groupBy("word").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("word")
    return named.join(words, "word", "left_semi")


def _merged(rows: DataFrame) -> DataFrame:
    """Rows (word, class, comp) with the words that have most classes in the same component made one, where
    that leaves no more pairs of different components than the words have each for itself. All pairs that share
    a word still do, and near copies that share hundreds are one pair."""
    apart = F.pow(F.sum("k"), F.lit(2)) - F.sum(F.col("k") * F.col("k"))          # twice the pairs
    words = rows.groupBy("word", "comp").agg(F.count("*").cast("double").alias("k")).groupBy("word")
    words = stored(words.agg(F.max_by("comp", F.struct("k", "comp")).alias("top"), apart.alias("pairs")), "parity-tops")
    named = rows.join(words.select("word", "top"), "word")
    once = named.select("top", "class", "comp").distinct().groupBy("top", "comp").agg(F.count("*").cast("double").alias("k"))
    fewer = once.groupBy("top").agg(apart.alias("merged")).join(
        words.groupBy("top").agg(F.sum("pairs").alias("pairs"), F.min("word").alias("to")), "top")
    fewer = fewer.filter("merged <= pairs").select("top", "to")
    return named.join(fewer, "top", "left").select(F.coalesce("to", "word").alias("word"), "class", "comp").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = min(max(MIN_CELLS, 1 << (chars // BYTES_PER_CELL).bit_length()), MAX_CELLS)
    both = stored(docs.mapInArrow(_classes(cells), "doc_id long, n long, class long, bits binary, words array<long>"), "parity-classes")
    own = both.filter("n >= 0").select("doc_id", "n", "class")
    total, texts = own.agg(F.sum("n"), F.count("*")).first()
    # a grade above 0 means four standard deviations of chance beyond the mean of a cell, or 4 texts
    mean = (total or 0) / cells
    unit = max(4, int(4 * mean ** 0.5) + 1)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = cells // CHUNK
    grades = np.zeros((chunks, CHUNK // 2), np.uint8)     # cells / 2 bytes, 8 MB at most
    sketch = both.filter("n < 0").select("n", "bits").repartition(min(chunks, default), "n")
    for n, row in sketch.mapInArrow(_grades(mean, unit), "n long, grades binary").collect():
        grades[-1 - n] = np.frombuffer(row, np.uint8)
    # words are split over sub-groups when their tokens stand in about 0.2 % of the texts
    frequent = min((max(texts // 500, 8 * unit) // unit).bit_length(), NO_TOKEN)

    parts = max(default, chars // BYTES_PER_PART)
    packed = docs.mapInArrow(_packed_words(parts, grades.tobytes(), frequent),
                             "part int, keys binary, owners binary, classes binary")
    words = stored(packed.repartition(parts, "part").mapInArrow(_shared_words, "word long, classes array<long>, weight long"), "parity-words")
    # words that the same classes share, as copies of a long text do by the hundred, are one word with a weight
    lists = words.filter("word is null").groupBy("classes").agg(F.sum("weight").alias("weight"))
    lists = lists.select(F.xxhash64("classes").alias("word"), F.explode("classes").alias("class"), "weight",
                         (F.size("classes") * F.col("weight")).alias("size"))
    shared = lists.unionByName(words.filter("word is not null").select(
        "word", F.col("classes")[0].alias("class"), F.lit(1).cast("long").alias("weight"), F.col("weight").alias("size")))
    shared = stored(shared, "parity-shared")

    members = stored(both.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"),
                                                                     F.first("words").alias("words")),
                     "parity-members")
    degree = shared.groupBy("class").agg(F.sum("size").alias("degree"))
    rows = stored(shared.select("word", "class", "weight").join(degree, "class"), "parity-rows")

    edges = comp = None
    for turn in (1, 2):
        if turn == 1:
            of = rows.withColumn("comp", F.col("class"))
            centre = of.groupBy("word").agg(F.max(F.struct("degree", "class", "comp")).alias("c"))
        else:                                     # the best centre outside the first one's component
            of = _open(rows, comp)
            of = of.join(of.groupBy("word").agg(F.max_by("comp", F.struct("degree", "class")).alias("top")), "word")
            centre = of.filter("comp <> top").groupBy("word").agg(F.max(F.struct("degree", "class", "comp")).alias("c"))
        stars = of.join(centre, "word").filter("comp <> c.comp")
        stars = stars.groupBy("class", F.col("c.class").alias("centre")).agg(F.sum("weight").alias("k"), F.max("c.degree").alias("g"))
        best = stars.groupBy("class").agg(F.max_by("centre", F.struct("k", "g", "centre")).alias("centre"))
        pairs = best.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
        more = _verify(docs, members, pairs, f"parity-{turn}")
        edges = more if edges is None else edges.unionByName(more)
        comp = stored(connected_components(edges), f"parity-cc{turn}")

    # what is left: pairs of different components that share a word and pass the bounds
    left = _merged(stored(_open(rows, comp).select("word", "class", "comp").distinct(), "parity-open"))
    left = left.join(members.select("class", "n", *[F.get("words", F.lit(i)).alias(f"w{i}") for i in range(8)]), "class")
    left = stored(left, "parity-left")
    other = left.select(*[F.col(c).alias(f"o_{c}") for c in left.columns])
    apart = sum((F.bit_count(F.col(f"w{i}").bitwiseXOR(F.col(f"o_w{i}"))) for i in range(1, 8)),
                F.bit_count(F.col("w0").bitwiseXOR(F.col("o_w0"))))
    close = ((F.col("word") == F.col("o_word")) & (F.col("class") < F.col("o_class")) & (F.col("comp") != F.col("o_comp"))
             & (4 * F.least("n", "o_n") >= 3 * F.greatest("n", "o_n")) & (7 * apart <= F.col("n") + F.col("o_n")))
    pairs = left.join(other, close).select(F.col("class").alias("a"), F.col("o_class").alias("b")).distinct()
    more = _verify(docs, members, pairs, "parity-3")
    comp = connected_components(edges.unionByName(more))

    named = members.join(comp.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("class", "rep", F.coalesce("component", "class").alias("comp"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = stored(named.join(least, "comp").select("class", "component_id"), "parity-components")
    return (own.join(named, "class", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
