"""Spelling variants: words one edit apart, found by a frontier that walks a trie held as tables.

Words. Maximal letter runs, A-Z lower-cased; where 31 divides the checksum of ``<doc_id>:<run>`` one
letter of the run is left out (the planted misspellings). Distinct words of 7 letters or more that occur
twice or more are compared; two are near if one letter is inserted, deleted or replaced.

Trie. Each word ends in ``END``. A node is a prefix that more than ``BUCKET`` words share, extended to
the longest prefix of all of them; its edges are rows (node, letter, label, child, next letters), and an
edge below which at most ``BUCKET`` words lie carries these words instead of a child. Nodes of one depth
are made by one grouped count of the words that are still in larger groups, so the number of rounds
follows the branchings on a path, not the length of a word.

Frontier. States (word, position, node, edits) are joined with the edges of their depth: an unchanged
label goes on with the same edits, a label one edit away with one, and only if the next letter of the
word is among the child's. At words, what is left is compared and the one-edit terminal states are the
neighbours. Either the first half of a word or its second half is unchanged, so the trie holds every word
twice, forwards behind one mark and reversed behind another, and the walk branches only beyond the
unchanged half: states start at the last node inside it. The many edges near the root are thus walked without edits, and states per word stay
few. A node has at most one edge per letter, so no state meets an unbounded group, and no group's words
are paired; hot nodes are split by adaptive execution, as the rows of a node are few on the edges' side.

Forms. A word's form is its near word of largest count, if 10 times its own; the last word on the path
of forms is its root, found by doubling: counts grow tenfold along it, so five doublings suffice.

Defined results: null and empty texts have no words; a null id counts as an empty one in the checksum;
repeated rows count each time; equal counts go to the smaller word in code-point order; an empty table
gives no rows; other columns are ignored; words of any length are compared whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import broadcast_if_small, stored

LETTERS = "A-Za-zÀ-ÿ"
END, AHEAD, BACK = "$", ">", "<"
BUCKET = 16
MAX_BROADCAST_EDGES = 20_000


def counted_words(docs: DataFrame, least_letters: int = 7, least_count: int = 2, one_in: int = 31) -> DataFrame:
    """(word, n): the words that are compared. Runs shorter than ``least_letters`` never become one."""
    runs = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least_letters},}})"), F.lit(1))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    rows = rows.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % one_in == 0, shorter).otherwise(F.col("run"))
    words = rows.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.filter((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _with_child(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the longest common prefix of the group's first and last word."""
    for b in batches:
        child = [os.path.commonprefix([x, y]) for x, y in zip(b.column("first").to_pylist(), b.column("last").to_pylist(), strict=True)]
        yield b.append_column("child", pa.array(child, pa.string()))


def _next(word: Column, pos: Column) -> Column:
    """The letter of ``word`` at 0-based ``pos``."""
    return F.substring(word, pos + 1, F.lit(1))


def build_trie(words: DataFrame, start: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per depth the edges (node, letter, label, child, nexts: letters that follow the label, words) and
    the states that start there. ``words``: (word, unchanged), words ending in END, the letters at the
    front that no edit touches; the first nodes are the prefixes of ``start`` letters."""
    alive, levels, at, unchanged = words.withColumn("at", F.lit(start)), [], F.col("at"), F.col("unchanged")
    while True:
        node, letter = F.substring("word", F.lit(1), at).alias("node"), _next(F.col("word"), at).alias("letter")
        rows = alive.select("word", "unchanged", "at", node, letter)
        groups = rows.groupBy("node", "letter").agg(F.count("*").alias("k"), F.min("word").alias("first"), F.max("word").alias("last"))
        groups = stored(groups.mapInArrow(_with_child, "node string, letter string, k long, first string, last string, child string"), "trie-groups")
        small = broadcast_if_small(groups.select("node", "letter", "k", F.length("child").alias("to")), MAX_BROADCAST_EDGES)
        placed = stored(rows.join(small, ["node", "letter"]), "trie-words")
        leaf = F.col("k") <= BUCKET
        starts = placed.filter((at <= unchanged) & (leaf | (F.col("to") > unchanged)))
        starts = starts.select("word", F.col("at").alias("pos"), "node", F.lit(0).alias("edits"))
        buckets = placed.filter(leaf).groupBy("node", "letter").agg(
            F.collect_list("word").alias("words"), F.array_join(F.collect_set(_next(F.col("word"), at + 1)), "").alias("nexts"))
        inner = groups.filter(~leaf).select("node", "letter", "child", F.substring("child", F.length("node") + 1, F.length("child")).alias("label"))
        levels.append((buckets, inner, starts))
        if not inner.limit(1).count():
            break
        alive = placed.filter(~leaf).select("word", "unchanged", F.col("to").alias("at"))
    out = []
    for i, (buckets, inner, starts) in enumerate(levels):
        if i + 1 < len(levels):
            below, deeper, _ = levels[i + 1]
            kids = below.select("node", "letter").unionByName(deeper.select("node", "letter"))
            nexts = kids.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_list("letter"), "").alias("nexts"))
            inner = inner.join(nexts, "child")
        else:
            inner = inner.withColumn("nexts", F.lit(""))
        edges = buckets.select("node", "letter", F.lit(None).cast("string").alias("child"), F.col("letter").alias("label"), "nexts", "words")
        edges = edges.unionByName(inner.select("node", "letter", "child", "label", "nexts"), allowMissingColumns=True)
        out.append((stored(edges, "trie-edges"), starts))
    return out


def walk(levels: list[tuple[DataFrame, DataFrame]]) -> list[DataFrame]:
    """Neighbours (word, near), with END, as one table per depth; a pair can come several times. Each
    branch below is a small expression of its own: one large one would be too long for the JVM to compile."""
    found, frontier = [], None
    word, pos, edits, letter = (F.col(c) for c in ("word", "pos", "edits", "letter"))
    rest = lambda shift: F.substring(word, pos + 1 + shift, F.length(word))
    after = lambda at: F.contains(F.col("nexts"), _next(word, at))
    for edges, starts in levels:
        states = starts if frontier is None else starts.unionByName(frontier)
        met = states.join(broadcast_if_small(edges, MAX_BROADCAST_EDGES), "node")
        on = letter == _next(word, pos)
        # edges to words: without an edit so far the words on the path are compared, of the others one letter may differ here
        at_words = met.filter("words IS NOT NULL")
        on_path = at_words.filter((edits == 0) & on).select("word", F.explode("words").alias("near"))
        on_path = on_path.filter((F.abs(F.length("near") - F.length("word")) <= 1) & (F.levenshtein("near", "word", 1) == 1))
        exact = at_words.filter((edits == 1) & on).select("word", "words", F.concat("node", rest(0)).alias("near"))
        inside = _next(word, pos) != END
        off_path = at_words.filter((edits == 0) & (letter != _next(word, pos)) & (after(pos) | after(pos + 1) | (letter == _next(word, pos + 1))))
        off_path = off_path.select("word", "words", F.explode(F.array(
            F.when(inside & (letter != END), F.concat("node", "letter", rest(1))), F.when(letter != END, F.concat("node", "letter", rest(0))),
            F.when(inside, F.concat("node", rest(1))))).alias("near"))
        matched = exact.unionByName(off_path).filter(F.expr("array_contains(words, near)"))
        found.append(stored(on_path.unionByName(matched.select("word", "near")), "trie-near"))
        # edges to nodes: the label itself, or one edit away from it
        size = F.length("label")
        inner = met.filter(F.col("child").isNotNull() & ((edits == 0) | on))
        kept = inner.filter((F.substring(word, pos + 1, size) == F.col("label")) & ((edits == 0) | after(pos + size)))
        kept = kept.select("word", (pos + size).alias("pos"), F.col("child").alias("node"), "edits")
        changed = inner.filter((edits == 0) & (after(pos + size - 1) | after(pos + size) | after(pos + size + 1)))
        changed = changed.select("word", "pos", "child", "label", "nexts", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("shift"))
        to = pos + size + F.col("shift")
        changed = changed.filter(after(to) & (to < F.length(word)) & (F.levenshtein(F.substring(word, pos + 1, size + F.col("shift")), "label", 1) == 1))
        changed = changed.select("word", to.alias("pos"), F.col("child").alias("node"), F.lit(1).alias("edits"))
        frontier = stored(kept.unionByName(changed), "trie-frontier")
    return found


def near_words(words: DataFrame, least_letters: int) -> DataFrame:
    """(word, near): every ordered pair of words one edit apart; no word has fewer letters."""
    length = F.length("word")
    both = words.select(F.explode(F.array(F.struct(F.concat(F.lit(AHEAD), "word", F.lit(END)).alias("word"), F.floor(length / 2).alias("unchanged")),
                                          F.struct(F.concat(F.lit(BACK), F.reverse("word"), F.lit(END)).alias("word"),
                                                   (length - F.floor(length / 2)).alias("unchanged"))))).select("col.word", (F.col("col.unchanged") + 1).alias("unchanged"))
    parts = walk(build_trie(both, least_letters // 2 + 1))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    bare = lambda c: F.substring(c, F.lit(2), F.length(c) - 2)
    read = lambda c: F.when(F.startswith(F.col(c), F.lit(AHEAD)), bare(F.col(c))).otherwise(F.reverse(bare(F.col(c)))).alias(c)
    out = out.select(read("word"), read("near"))
    return out.distinct()


def spelling_variants(docs: DataFrame, factor: int = 10, least_letters: int = 7) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every compared word of ``docs`` (doc_id, text)."""
    words = stored(counted_words(docs, least_letters), "variant-words")
    pairs = near_words(words, least_letters).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("top"))
    best = best.select("word", "n_near", F.col("top.near").alias("near"), (-F.col("top.col1")).alias("near_n"))
    rows = words.join(best, "word", "left")
    enough = F.col("near_n") >= factor * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("near")).alias("form"),
                              F.when(enough, F.col("near_n")).alias("form_n")), "variant-forms")
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):                                              # counts grow tenfold: at most 18 steps
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variant-roots")
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
