"""Benchmark decontamination by latent semantic retrieval.

1. Texts are cut into blocks of ``BLOCK`` words; a passage is ``SPAN`` consecutive blocks. The terms
   are the benchmark's words; one pass over all documents counts in how many blocks each occurs. Terms
   in more than ``MAX_SHARE`` of the blocks carry no weight in the latent space (unless an item has fewer
   than three others), the rest their inverse document frequency.
2. Distributed randomised SVD: one more pass sums Z = AᵀAΩ over all passages A (term frequency times
   idf) for a seeded Gaussian Ω, task by task; the single-pass (Nyström) decomposition of the sum gives
   the leading right singular vectors. Benchmark passages are rows of A too, weighted so that their
   terms are not lost among the documents'.
3. Cosine search: every passage of every document against all items in the latent space; those of
   cosine ``COSINE`` or more are candidates.
4. Exact candidates, whatever the rank and the weights: an item's rarest words by block count, frequent
   ones too if it has no others, are its signature. As a match lacks at most the share
   1 - ``LCS_PARAPHRASE`` of the words, a part of the signature must stand in the text around a match;
   every passage whose surroundings hold it is a candidate, so that no match is lost. For the same
   reason candidates of step 3 whose surroundings lack it are left out of step 5.
5. Candidates are checked on the words: the longest common subsequence of the item and the document
   around the passage must hold ``LCS_SURE`` of the item's words, or ``LCS_PARAPHRASE`` together with
   the answer – the item's ``answer`` column, else its last ``ANSWER`` share of words – found to
   ``LCS_SURE`` there. The second rule also asks for ``COSINE``, in the latent space or in the full
   one, where all words have their inverse document frequency: scattered frequent words are no match.

The benchmark is the stated query set: it is taken in blocks of ``ITEMS`` items, each with its own
pass, so what travels to the tasks is bounded. Terms times rank numbers reach the driver, never
passages.

Defined results: null or empty texts hold nothing; an item without words, or with fewer than
``LEAST_WORDS``, matches nothing; repeated rows of a doc_id give one result; ties keep the first
place; an empty benchmark or table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import slices, stored
from kiln.llm.hashing import mix, prefix_hashes, span_hashes, text_groups

BLOCK, SPAN = 24, 3
MAX_SHARE = 0.005
RANK, EXTRA = 224, 16
COSINE = 0.25
LCS_SURE, LCS_PARAPHRASE, ANSWER = 0.75, 0.6, 0.25
LEAST_WORDS = 5
HELD = 0.35       # share of an item's words that its signature has beyond those a match may lack
MAX_EXPANDED = 1 << 22   # counts that the signature search holds at a time
ITEMS = 5_000

_WORD = np.zeros(256, bool)
_WORD[0x80:] = _WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = True


def hashed_words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of texts as (index of the first, word hashes, first word of each text and the end)."""
    for first, group in text_groups(texts):
        lens = np.array([len(t) + 1 for t in group])
        a = np.frombuffer(b"\n".join(group).lower() + b"\n", np.uint8)
        edge = np.diff(np.concatenate(([0], _WORD[a].view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        h = mix(span_hashes(prefix_hashes(a), start, end))
        yield first, h, np.concatenate(([0], np.searchsorted(start, np.cumsum(lens))))


class Terms:
    """Index of term hashes: a bit table first, then a search in the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of known words, their term numbers)."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.bits[(words >> np.uint64(44)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.hashes, words[at]), len(self.hashes) - 1)
        same = self.hashes[term] == words[at]
        return at[same], term[same]


def _blocks(first_word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block of each of the words at ``at``, first block of each text and the end)."""
    count = -(-np.diff(first_word) // BLOCK)
    first_block = np.concatenate(([0], np.cumsum(count)))
    doc = np.searchsorted(first_word, at, side="right") - 1
    return first_block[doc] + (at - first_word[doc]) // BLOCK, first_block


def _lower(texts: pa.Array) -> list[bytes]:
    """Lower-cased texts (all scripts: copies may stand in capitals) as UTF-8; null is empty."""
    return [x or b"" for x in pc.utf8_lower(texts.cast(pa.string())).cast(pa.binary()).to_pylist()]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return _lower(batch.column("text"))


def _term_counts(hashes: np.ndarray) -> Callable:
    """docs -> (term, blocks that hold it) per task; term -1 counts all blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts, total = Terms(hashes), np.zeros(len(hashes), np.int64), 0
        for batch in slices(batches):
            for _, h, first in hashed_words(_texts(batch)):
                at, term = terms.find(h)
                block, first_block = _blocks(first, at)
                total += int(first_block[-1])
                pairs = np.unique(block * len(hashes) + term)
                counts += np.bincount(pairs % max(len(hashes), 1), minlength=len(hashes))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], total))], names=["term", "n"])
    return run


def _passage_sums(rows: np.ndarray, block: np.ndarray, first_block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of term rows per passage: (first block of each passage, sums)."""
    n = int(first_block[-1])
    sums = np.zeros((n + SPAN, rows.shape[1]), np.float32)
    if len(block):
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        sums[block[starts]] = np.add.reduceat(rows, starts, axis=0)
    index = np.arange(n)
    doc = np.searchsorted(first_block, index, side="right") - 1
    end = first_block[doc + 1]
    own = index[(index == first_block[doc]) | (index + SPAN <= end)]
    out = sums[own]
    for k in range(1, SPAN):
        out += sums[own + k] * ((own + k) < end[own])[:, None]
    return own, out


def _products(hashes: np.ndarray, omega: np.ndarray, idf: np.ndarray) -> Callable:
    """docs -> the task's share of AᵀAΩ, in chunks of terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, table = Terms(hashes), (omega * idf[:, None]).astype(np.float32)
        z = np.zeros((len(hashes), omega.shape[1]))
        for batch in slices(batches):
            for _, h, first in hashed_words(_texts(batch)):
                at, term = terms.find(h)
                if not len(at):
                    continue
                block, first_block = _blocks(first, at)
                own, y = _passage_sums(table[term], block, first_block)
                # a block's terms get the products of all passages over it
                per_block = np.zeros((int(first_block[-1]) + SPAN, y.shape[1]), np.float32)
                ends = first_block[np.searchsorted(first_block, own, side="right")]
                for k in range(SPAN):
                    inside = own + k < ends
                    per_block[own[inside] + k] += y[inside]
                order = np.argsort(term, kind="stable")
                starts = np.flatnonzero(np.concatenate(([True], np.diff(term[order]) != 0)))
                z[term[order][starts]] += np.add.reduceat(per_block[block[order]], starts, axis=0)
        z = (z * idf[:, None]).astype(np.float32)
        step = 512
        for i in range(0, len(z), step):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([z[i:i + step].tobytes()], pa.binary())], names=["chunk", "z"])
    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(pdf["z"].iloc[0], np.float32).astype(np.float64)
    for z in pdf["z"].iloc[1:]:
        total = total + np.frombuffer(z, np.float32)
    return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "z": [total.tobytes()]})


def singular_vectors(z: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of M = AᵀA from Z = MΩ alone: M ≈ Z (ΩᵀZ)⁻¹ Zᵀ."""
    c = omega.T @ z
    w, u = np.linalg.eigh((c + c.T) / 2)
    keep = w > max(w.max(), 0) * 1e-9
    if not keep.any():
        return np.zeros((len(z), 0))
    left, s, _ = np.linalg.svd(z @ (u[:, keep] / np.sqrt(w[keep])), full_matrices=False)
    return left[:, :rank][:, s[:rank] > 0]


def lcs_length(item: dict[int, int], words: list[int]) -> int:
    """Longest common subsequence; ``item`` maps each word to the bits of its places."""
    v = full = (1 << item[-1]) - 1
    for m in filter(None, map(item.get, words)):
        u = v & m
        v = ((v + u) | (v - u)) & full
    return item[-1] - v.bit_count()


def _places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out | {-1: len(words)}


class Signatures:
    """Exact candidates: segments of documents that hold so many signature words of an item that its
    longest common subsequence with some passage's surroundings can reach ``LCS_PARAPHRASE``.

    The surroundings of a passage lie in one of the segments of twice ``size`` blocks that begin at
    every multiple of ``size``; items are searched together by ``size``, a power of two.
    """

    def __init__(self, items: list[tuple[int, list[int], list[int]]], hashes: np.ndarray, df: np.ndarray):
        postings: dict[int, list[tuple[np.ndarray, np.ndarray, int, int]]] = {}
        for i, (_, ws, _) in enumerate(items):
            n = len(ws)
            own, times = np.unique(np.searchsorted(hashes, np.array(ws, np.uint64)), return_counts=True)
            order = np.lexsort((own, df[own]))
            held = np.cumsum(times[order])
            lacking = n - math.ceil(LCS_PARAPHRASE * n)
            last = int(np.searchsorted(held, lacking + max(1, math.ceil(HELD * n))))
            size = 1 << (SPAN + 2 * -(-n // BLOCK) - 1).bit_length()
            chosen = order[:last + 1]
            postings.setdefault(size, []).append((own[chosen], times[chosen], i, int(held[last]) - lacking))
        self.classes = []
        self.reach = np.array([-(-len(ws) // BLOCK) for _, ws, _ in items], np.int64)
        self.size = np.zeros(len(items), np.int64)
        for size, rows in sorted(postings.items()):
            self.size[[i for _, _, i, _ in rows]] = size
            term = np.concatenate([t for t, _, _, _ in rows])
            order = np.argsort(term, kind="stable")
            item = np.repeat(np.arange(len(rows)), [len(t) for t, _, _, _ in rows])[order]
            times = np.concatenate([m for _, m, _, _ in rows])[order].astype(np.float64)
            known, start = np.unique(term[order], return_index=True)
            number = np.full(len(hashes), -1)
            number[known] = np.arange(len(known))
            self.classes.append((size, number, np.append(start, len(term)), item, times,
                                 np.array([i for _, _, i, _ in rows]), np.array([k for _, _, _, k in rows])))

    def find(self, term: np.ndarray, block: np.ndarray, first_block: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, first block of the segment in it, size, item) for each candidate segment."""
        doc = np.searchsorted(first_block, block, side="right") - 1
        for size, number, start, item, times, items, need in self.classes:
            first = np.concatenate(([0], np.cumsum(-(-np.diff(first_block) // size))))
            mine = np.flatnonzero(number[term] >= 0)
            t, d = number[term[mine]], doc[mine]
            at = (block[mine] - first_block[d]) // size
            seg, back = first[d] + at, at > 0
            pairs = np.unique(np.concatenate((seg * len(start) + t, (seg[back] - 1) * len(start) + t[back])))
            seg, t = pairs // len(start), pairs % len(start)
            count = start[t + 1] - start[t]
            upto = np.concatenate(([0], np.cumsum(count)))
            step = max(1, MAX_EXPANDED // len(items))
            for low in range(0, int(first[-1]) if len(t) else 0, step):
                a, b = np.searchsorted(seg, (low, low + step))
                found = np.zeros(min(step, int(first[-1]) - low) * len(items))
                while a < b:
                    # as many pairs as stand for MAX_EXPANDED postings, but one at least
                    stop = min(b, max(a + 1, int(np.searchsorted(upto, upto[a] + MAX_EXPANDED, side="right")) - 1))
                    n = count[a:stop]
                    post = np.arange(int(n.sum())) + np.repeat(start[t[a:stop]] - (np.cumsum(n) - n), n)
                    found += np.bincount(np.repeat(seg[a:stop] - low, n) * len(items) + item[post], times[post], len(found))
                    a = stop
                for s, i in zip(*np.nonzero(found.reshape(-1, len(items)) >= need), strict=True):
                    doc_at = int(np.searchsorted(first, low + s, side="right")) - 1
                    yield doc_at, int(low + s - first[doc_at]) * size, size, int(items[i])


    def possible(self, segments: list[tuple[int, int, int, int]], first_block: np.ndarray, own: np.ndarray,
                 passage: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which of the pairs (passage, item) have their surroundings in one of ``segments``, as ``find``
        gave them: no other pair can reach ``LCS_PARAPHRASE``."""
        doc = np.searchsorted(first_block, own[passage], side="right") - 1
        begin = np.maximum(own[passage] - first_block[doc] - self.reach[item], 0) // self.size[item] * self.size[item]
        held = np.array([(first_block[d] + at) * len(self.size) + i for d, at, _, i in segments], np.int64)
        return np.isin((first_block[doc] + begin) * len(self.size) + item, held)


def _exact(segments: list[tuple[int, int, int, int]], places: list, items: list, first_block: np.ndarray,
           own: np.ndarray, first: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int]]:
    """(passage, item) for the passages whose surroundings may hold the item, from the segments
    that do: a segment's longest common subsequence is no shorter than that of any part of it."""
    for doc, at, size, i in segments:
        n = len(items[i][1])
        segment = h[first[doc] + at * BLOCK:min(first[doc] + (at + 2 * size) * BLOCK, first[doc + 1])].tolist()
        if lcs_length(places[i][0], segment) < LCS_PARAPHRASE * n:
            continue
        reach = -(-n // BLOCK)
        begin = first_block[doc] + (at + reach if at else 0)
        end = min(first_block[doc] + at + size + reach, first_block[doc + 1])
        for p in range(*np.searchsorted(own, (begin, end))):
            yield p, i


def full_cosine(one: np.ndarray, other: np.ndarray, idf: np.ndarray) -> float:
    """Cosine of two lists of term numbers, weighted by term count times ``idf``."""
    (a, m), (b, n) = (np.unique(x, return_counts=True) for x in (one, other))
    _, i, j = np.intersect1d(a, b, return_indices=True)
    size = np.linalg.norm(m * idf[a]) * np.linalg.norm(n * idf[b])
    return float((m[i] * n[j] * idf[a[i]] ** 2).sum() / size) if size else 0.0


def _search(hashes: np.ndarray, idf: np.ndarray, row: np.ndarray, table: np.ndarray, latent: np.ndarray,
            items: list[tuple[int, list[int], list[int]]], signatures: Signatures, cosine: float) -> Callable:
    """``row`` is the row of a term in ``table``, -1 for a term without weight in the latent space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(hashes)
        places = [(_places(w), _places(a)) for _, w, a in items]
        for batch in slices(batches):
            ids, out = batch.column("doc_id").to_pylist(), []
            for base, h, first in hashed_words(_texts(batch)):
                at, term = terms.find(h)
                if not len(at):
                    continue
                block, first_block = _blocks(first, at)
                weighted = row[term] >= 0
                own, y = _passage_sums(table[row[term[weighted]]], block[weighted], first_block)
                size = np.sqrt(np.einsum("ij,ij->i", y, y))
                score = (y / np.maximum(size, 1e-6)[:, None]) @ latent.T
                # a passage whose surroundings lack an item's signature needs no comparison word by word
                segments = list(signatures.find(term, block, first_block))
                p, i = np.nonzero((score >= cosine) & (size > 1e-6)[:, None])
                held = signatures.possible(segments, first_block, own, p, i)
                near = zip(p[held], i[held], strict=True)
                exact = _exact(segments, places, items, first_block, own, first, h)
                for p, i in sorted({(int(p), int(i)) for both in (near, exact) for p, i in both}):
                    doc = int(np.searchsorted(first_block, own[p], side="right")) - 1
                    item, words, answer = items[i]
                    start = int(first[doc] + (own[p] - first_block[doc]) * BLOCK)
                    around = h[max(start - len(words), first[doc]):min(start + SPAN * BLOCK + len(words), first[doc + 1])].tolist()
                    found = lcs_length(places[i][0], around)
                    if found < LCS_PARAPHRASE * len(words):
                        continue
                    if found < LCS_SURE * len(words):
                        if lcs_length(places[i][1], around) < LCS_SURE * len(answer):
                            continue
                        passage = term[slice(*np.searchsorted(at, (start, min(start + SPAN * BLOCK, first[doc + 1]))))]
                        if score[p, i] < cosine and full_cosine(passage, terms.find(np.array(words, np.uint64))[1], idf) < cosine:
                            continue
                    out.append((ids[base + doc], item, start - int(first[doc]), float(score[p, i]), found / len(words)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
                                             names=["doc_id", "item_id", "word", "cosine", "lcs"])
    return run


def _block_of_items(docs: DataFrame, rows: list, rank: int, cosine: float) -> DataFrame | None:
    items = []
    for r in rows:
        (_, h, _), = hashed_words(_lower(pa.array([r["text"]], pa.string())))
        own = r.get("answer")
        answer = list(hashed_words(_lower(pa.array([own], pa.string()))))[0][1] if own else h[len(h) - max(3, int(len(h) * ANSWER)):]
        if len(h) >= LEAST_WORDS and r["item_id"] is not None:
            items.append((r["item_id"], [int(x) for x in h], [int(x) for x in answer]))
    if not items:
        return None
    hashes = np.unique(np.array([w for _, ws, _ in items for w in ws], np.uint64))
    counted = docs.mapInArrow(_term_counts(hashes), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(len(hashes), np.int64), 0
    for term, n in counted:
        if term < 0:
            total = n
        else:
            df[term] = n
    idf = np.log((1 + total) / (1 + df)) + 1
    weight = np.where(df <= max(MAX_SHARE * total, 20), idf, 0.0)
    # an item made of frequent words only keeps their weight: it could not be found otherwise
    for _, ws, _ in items:
        own = np.searchsorted(hashes, np.unique(np.array(ws, np.uint64)))
        if (weight[own] > 0).sum() < 3:
            weight[own] = idf[own]
    known, full_idf, row = hashes, idf, np.where(weight > 0, np.cumsum(weight > 0) - 1, -1)
    signatures = Signatures(items, hashes, df)
    hashes, idf = hashes[weight > 0], weight[weight > 0]
    a = np.zeros((len(items), len(hashes)))
    terms = Terms(hashes)
    for i, (_, ws, _) in enumerate(items):
        np.add.at(a[i], terms.find(np.array(ws, np.uint64))[1], 1)
    a *= idf
    width = min(rank + EXTRA, len(hashes))
    omega = np.random.default_rng(7).standard_normal((len(hashes), width))
    z = np.zeros((len(hashes), width))
    chunks = docs.mapInArrow(_products(hashes, omega, idf), "chunk long, z binary").groupBy("chunk").applyInPandas(_added, "chunk long, z binary")
    for chunk, part in chunks.collect():
        part = np.frombuffer(part, np.float64).reshape(-1, width)
        z[chunk:chunk + len(part)] = part
    energy = np.trace(omega.T @ z) / width
    z += max(1.0, energy / max((a * a).sum(), 1e-9)) * (a.T @ (a @ omega))
    basis = singular_vectors(z, omega, rank)
    latent = a @ basis
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return docs.mapInArrow(_search(known, full_idf, row, (idf[:, None] * basis).astype(np.float32), latent.astype(np.float32), items, signatures, cosine),
                           "doc_id long, item_id long, word long, cosine double, lcs double")


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, word, cosine, lcs) for every document that holds a benchmark item; ``word``
    is where the best passage begins, ``cosine`` its own (exact candidates may lie below ``cosine``)."""
    docs = docs.select("doc_id", "text")
    cols = [c for c in ("item_id", "text", "answer") if c in benchmark.columns]
    benchmark = benchmark.select(*cols)
    blocks = -(-benchmark.count() // ITEMS)
    found = None
    for b in range(blocks):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else benchmark
        rows = [r.asDict() for r in part.sort("item_id", "text").collect()]
        one = _block_of_items(docs, rows, rank, cosine)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, word long, cosine double, lcs double")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs", "cosine", (-F.col("word")).alias("w"))).alias("b"))
    return stored(best.select("doc_id", "item_id", (-F.col("b.w")).alias("word"), F.round("b.cosine", 4).alias("cosine"), F.round("b.lcs", 4).alias("lcs")), "contaminated")
