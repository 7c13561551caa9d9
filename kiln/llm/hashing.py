"""Vectorised 64-bit hashes of bytes, words and shingles (NumPy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hashes(a: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of the first i bytes' codes times powers of the base."""
    up, _ = powers(len(a) + 1)
    s = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[:-1], out=s[1:])
    return s


def span_hashes(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end): equal spans get equal hashes wherever they stand."""
    _, down = powers(len(s))
    return (s[end] - s[start]) * down[start]


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space."""
    inside = ~_SPACE[a]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def text_groups(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes together, with the index of the first."""
    at, size, first = [], 0, 0
    for i, t in enumerate(texts):
        if at and size + len(t) > most:
            yield first, at
            at, size, first = [], 0, i
        at.append(t)
        size += len(t) + 1
    if at:
        yield first, at


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Per text (UTF-8): sorted distinct hashes of its runs of ``width`` lower-cased words; with
    fewer words one hash of the whole sequence; none without words."""
    out: list[np.ndarray] = []
    factor = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for _, group in text_groups(texts):
        a = np.frombuffer(b"\n".join(group).lower() + b"\n", np.uint8)
        start, end = word_spans(a)
        h = mix(span_hashes(prefix_hashes(a), start, end)) + (end - start).astype(np.uint64)
        stops = np.cumsum([len(t) + 1 for t in group])
        first = np.searchsorted(start, stops - [len(t) + 1 for t in group])
        last = np.searchsorted(start, stops)
        n = max(len(h) - width + 1, 0)
        full = np.zeros(n, np.uint64)
        for k in range(width):
            full += h[k:k + n] * factor[k]
        full = mix(full)
        for i, j in zip(first.tolist(), last.tolist(), strict=True):
            if j - i >= width:
                out.append(np.unique(full[i:j - width + 1]))
            elif j > i:
                out.append(mix(np.array([(h[i:j] * factor[:j - i]).sum() + np.uint64(j - i)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
