"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and counts of the whole text (no label, language, source or id). Each is cut into
at most ``BINS`` bins at training quantiles. Boosting is cyclic: in every round each feature in turn
gets a shallow tree (at most ``LEAVES`` leaves, found on the histogram of gradients per bin) whose
leaf values, shrunk by ``RATE``, are added to the feature's lookup table. Then the ``PAIRS`` feature pairs
whose joint histogram of residuals gains most are boosted likewise, with one cut per feature and tree.
What is learnt is lookup tables; a score is the sum of one entry per feature and pair.

Training uses at most ``MAX_TRAIN`` labelled rows (a documented bound; those with the smallest hash of
their id), from rows whose crc32(doc_id as text) mod 3 is not 1. Features and scores cover all texts.

Defined results: null and empty texts get the features of no words and a score like any other; without
training rows every score is 0.5, with one class only the score is that class's clipped share; rows
with a null doc_id are scored, never trained on; repeated labels of a document are averaged; repeated
rows get equal results; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import slices, stored
from kiln.llm.hashing import mix, prefix_hashes, span_hashes, word_spans

FEATURES = ["log_words", "word_bytes", "symbols", "digits", "upper", "marks", "bars", "high_bytes", "distinct_words",
            "top_word", "repeated_triples", "short_words", "duplicate_lines", "line_bytes", "shouts"]
BINS, LEAVES, RATE = 32, 4, 0.1
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 50, 6
MAX_TRAIN = 50_000

_CLASS = np.zeros((6, 256), np.float64)
_CLASS[0, list(b"#*$%&<>@^~{}[]\\")] = 1
_CLASS[1, 0x30:0x3A] = 1
_CLASS[2, 0x41:0x5B] = 1
_CLASS[3, list(b".,;:?'\"()-")] = 1
_CLASS[4, list(b"|=_/")] = 1
_CLASS[5, 0x80:] = 1


def text_features(text: bytes) -> list[float]:
    a = np.frombuffer(text, np.uint8)
    start, end = word_spans(a)
    n = len(start)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(a, minlength=256).astype(np.float64)
    size = end - start
    chars = float(size.sum())
    shares = (_CLASS @ count) / chars
    h = mix(span_hashes(prefix_hashes(a), start, end))
    _, times = np.unique(h, return_counts=True)
    repeated = 0.0
    if n >= 3:
        triple = h[:-2] + h[1:-1] * np.uint64(3) + h[2:] * np.uint64(7)
        repeated = 1 - len(np.unique(triple)) / len(triple)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [float(np.log1p(n)), chars / n, *shares[:3].tolist(), shares[3], shares[4], shares[5], len(times) / n, float(times.max()) / n, repeated,
            float((size <= 3).mean()), 1 - len(set(lines)) / len(lines), float(np.log1p(len(text) / len(lines))), count[0x21] / chars]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows = np.array([text_features(x or b"") for x in b.column("text").cast(pa.binary()).to_pylist()]).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *[pa.array(rows[:, i]) for i in range(len(FEATURES))]],
                                         names=["doc_id", *FEATURES])


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf value per bin of the greedy tree with at most ``leaves`` leaves on a histogram."""
    parts = [(0, len(g))]
    score = lambda x, y: x * x / (y + 1.0)

    def best(i: int, j: int) -> tuple[float, int]:
        cg, ch = np.cumsum(g[i:j]), np.cumsum(h[i:j])
        if j - i < 2:
            return 0.0, 0
        gain = score(cg[:-1], ch[:-1]) + score(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - score(cg[-1], ch[-1])
        k = int(np.argmax(gain))
        return float(gain[k]), i + k + 1

    while len(parts) < leaves:
        found = [(best(i, j), (i, j)) for i, j in parts]
        (gain, cut), (i, j) = max(found, key=lambda x: x[0][0])
        if gain <= 1e-9:
            break
        parts.remove((i, j))
        parts += [(i, cut), (cut, j)]
    out = np.zeros(len(g))
    for i, j in parts:
        out[i:j] = g[i:j].sum() / (h[i:j].sum() + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best cross of one cut per feature on a joint histogram."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total, best, out = cg[-1, -1], 0.0, np.zeros_like(g)
    if min(g.shape) < 2:
        return 0.0, out
    a, b, c = cg[:-1, :-1], cg[:-1, -1:], cg[-1:, :-1]
    u, v, w, t = ch[:-1, :-1], ch[:-1, -1:], ch[-1:, :-1], ch[-1, -1]
    gain = a**2 / (u + 1) + (b - a)**2 / (v - u + 1) + (c - a)**2 / (w - u + 1) + (total - b - c + a)**2 / (t - v - w + u + 1) - total**2 / (t + 1)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    best = float(gain[i, j])
    for x in (slice(0, i + 1), slice(i + 1, None)):
        for y in (slice(0, j + 1), slice(j + 1, None)):
            out[x, y] = g[x, y].sum() / (h[x, y].sum() + 1.0)
    return best, out


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        p = x.shape[1]
        share = float(np.clip(y.mean(), 0.02, 0.98)) if len(y) else 0.5
        self.start = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(p)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if not len(y) or y.min() == y.max():
            return self
        bins = self.binned(x)
        f = np.full(len(y), self.start)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            q = 1 / (1 + np.exp(-f))
            return y - q, q * (1 - q)

        for _ in range(ROUNDS):
            for j in range(p):
                g, h = slopes()
                size = len(self.tables[j])
                step = RATE * _tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
                self.tables[j] += step
                f += step[bins[j]]

        def joint(i: int, j: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int], np.ndarray]:
            shape = (len(self.tables[i]), len(self.tables[j]))
            cell = bins[i] * shape[1] + bins[j]
            g, h = slopes()
            return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape), shape, cell

        gains = sorted(((_quadrants(*joint(i, j)[:2])[0], i, j) for i in range(p) for j in range(i)), reverse=True)[:PAIRS]
        self.pairs = [(i, j, np.zeros((len(self.tables[i]), len(self.tables[j])))) for _, i, j in gains]
        for _ in range(PAIR_ROUNDS):
            for i, j, values in self.pairs:
                g, h, _, cell = joint(i, j)
                step = RATE * _quadrants(g, h)[1]
                values += step
                f += step.ravel()[cell]
        return self

    def binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        f = np.full(len(x), self.start)
        for t, b in zip(self.tables, bins, strict=True):
            f += t[b]
        for i, j, values in self.pairs:
            f += values[bins[i], bins[j]]
        return 1 / (1 + np.exp(-f))


def _scored(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(np.column_stack([b.column(c).to_numpy() for c in FEATURES]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])
    return run


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, for every row."""
    features = stored(docs.select("doc_id", "text").mapInArrow(_features, "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES)), "gam-features")
    known = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("_y"))
    train = features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), *FEATURES).limit(max_train)
    t = train.select(*FEATURES, "_y").toPandas()
    model = AdditiveModel().fit(t[FEATURES].to_numpy(np.float64).reshape(-1, len(FEATURES)), t["_y"].to_numpy(np.float64))
    out = features.mapInArrow(_scored(model), "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
