"""Super-grams of texts: the strings that hold all places of equal minimisers (NumPy, inside tasks)."""

from __future__ import annotations

import numpy as np

from kiln.llm.hashing import mix, powers, prefix_hashes, span_hashes

SEGMENT = 1 << 22   # starts handled at a time; their place must fit 24 bits


def window_minima(order: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values: block-wise minima from both sides."""
    n = len(order) - width + 1
    pad = -len(order) % width
    x = np.concatenate((order, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def super_grams(text: bytes, length: int, gram: int, context: int) -> dict[str, np.ndarray]:
    """Maximal runs of starts whose ``length``-byte strings have the same (leftmost) smallest gram.

    Per run: ``start``, ``size`` (of the string over all its starts), ``col`` (the gram's place in it), ``g`` (its hash),
    ``s`` (the string's hash), ``l`` and ``r`` (hashes of the ``context`` bytes before and after the gram;
    0 where the string does not reach so far)."""
    names = ("start", "size", "col", "g", "s", "l", "r")
    a = np.frombuffer(text, np.uint8)
    starts = len(a) - length + 1
    if starts < 1:
        return {k: np.zeros(0, np.uint64 if k in "gslr" else np.int64) for k in names}
    width, parts = length - gram + 1, []
    for lo in range(0, starts, SEGMENT):
        hi = min(lo + SEGMENT, starts)
        b = a[lo:hi + length - 1]
        p = prefix_hashes(b)
        h = mix((p[gram:] - p[:-gram]) * powers(len(p))[1][:len(b) - gram + 1])
        order = h & np.uint64(0xFFFFFFFFFF000000)
        order |= np.arange(len(h), dtype=np.uint64)
        low = window_minima(order, width)
        place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        end = np.append(first[1:], len(place)) - 1 + length
        pos = place[first]
        s = mix(span_hashes(p, first, end) + (end - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (pos - first).astype(np.uint64)
        left = np.where(pos - context >= first, mix(span_hashes(p, np.maximum(pos - context, 0), pos)) | np.uint64(1), np.uint64(0))
        stop = pos + gram + context
        right = np.where(stop <= end, mix(span_hashes(p, pos + gram, np.minimum(stop, len(b)))) | np.uint64(1), np.uint64(0))
        parts.append((first + lo, end - first, pos - first, h[pos], s, left, right))
    return {k: np.concatenate(x) for k, x in zip(names, zip(*parts, strict=True), strict=True)}
