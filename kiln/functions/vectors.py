"""Array-column (vector) expressions: rescale, reshape, concatenate, standardise, score.

Element-wise maps and reductions are higher-order SQL functions evaluated inside the row's task –
no explode/regroup shuffle. Matrix products (scoring layers, dot products against a small set of
vectors) and per-row standardisation run as NumPy kernels over Arrow batches: Spark's lambdas are
interpreted per element, while one ``batch @ W`` per batch is vectorised. The weights shipped with
a kernel are model-sized, not data-sized.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def vec_rescale(arr: Column | str, divisor: float = 255.0) -> Column:
    return F.transform(_c(arr), lambda x: x.cast("double") / F.lit(float(divisor)))


def vec_reshape(arr: Column | str, rows: int, cols: int) -> Column:
    """Flat vector → rows × cols grid (array of arrays)."""
    a = _c(arr)
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.slice(a, r * cols + 1, cols))


def vec_flatten(grid: Column | str) -> Column:
    return F.flatten(_c(grid))


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def noise(key: Column | str, n: int, seed: int = 3) -> Column:
    """n reproducible uniform [0,1) values per row, from a hash of (key, index, seed)."""
    k = _c(key)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.pmod(F.xxhash64(k, i, F.lit(seed)), F.lit(4294967296)) / F.lit(4294967296.0))


def vec_concat(*arrs: Column | str) -> Column:
    return F.concat(*[F.transform(_c(a), lambda x: x.cast("double")) for a in arrs])


def vec_sum(arr: Column | str) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def vec_mean(arr: Column | str) -> Column:
    """Global average over the vector's axis."""
    return vec_sum(arr) / F.size(_c(arr))


def vec_std(arr: Column | str) -> Column:
    """Population standard deviation over the vector, in one pass (sum and sum of squares)."""
    a = _c(arr)
    acc0 = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    n = F.size(a)
    return F.aggregate(a, acc0,
                       lambda acc, x: F.struct((acc["s"] + x.cast("double")).alias("s"),
                                               (acc["q"] + x.cast("double") * x.cast("double")).alias("q")),
                       lambda acc: F.sqrt(F.greatest(acc["q"] / n - (acc["s"] / n) * (acc["s"] / n), F.lit(0.0))))


def vec_standardize_clip(arr: Column | str, scale: float = 64.0, center: float = 128.0) -> Column:
    """Centre and scale by the vector's own mean/std, ×64 +128, clip to 0..255, as integers.

    A vector whose values sum to 0 is left unscaled (only clipped), as an all-zero channel would be;
    a constant vector (std 0) becomes ``center``; a null vector stays null. Vectors of one length
    are stacked and standardised as one matrix per Arrow batch.
    """
    @F.pandas_udf("array<int>")
    def _std_clip(col: pd.Series) -> pd.Series:
        out: list = [None] * len(col)
        sizes = col.map(lambda v: -1 if v is None else len(v))
        for size in sizes[sizes >= 0].unique():
            at = np.flatnonzero(sizes == size)
            x = np.array([np.asarray(v, np.float64) for v in col.iloc[at]]) if size else np.zeros((len(at), 0))
            std = x.std(axis=1, keepdims=True) if size else np.ones((len(at), 1))
            mean = x.mean(axis=1, keepdims=True) if size else std
            spread = std > 1e-12 * np.abs(mean)       # rounding leaves a constant vector a tiny std
            z = np.where(spread, (x - mean) / np.where(spread, std, 1.0), 0.0) * scale + center
            z = np.where(x.sum(axis=1, keepdims=True) != 0, z, x)
            for i, row in zip(at, np.trunc(np.clip(z, 0.0, 255.0)).astype(np.int32)):
                out[i] = row
        return pd.Series(out, dtype=object)
    return _std_clip(_c(arr))


def _matmul_udf(weights: np.ndarray, bias: np.ndarray, activation: str):
    """Vectorised scoring kernel: stacks an Arrow batch of vectors and multiplies once. A null
    vector scores null; one of another length than the layer's input is an error."""
    @F.pandas_udf("array<double>")
    def _score(col: pd.Series) -> pd.Series:
        out: list = [None] * len(col)
        some = np.flatnonzero(col.notna())
        if len(some) == 0:
            return pd.Series(out, dtype=object)
        rows = [np.asarray(v, dtype=np.float64) for v in col.iloc[some]]
        if bad := {len(v) for v in rows} - {weights.shape[0]}:
            raise ValueError(f"the layer takes vectors of length {weights.shape[0]}, not {sorted(bad)}")
        x = np.vstack(rows)
        z = x @ weights + bias
        if activation == "relu":
            z = np.maximum(z, 0.0)
        elif activation == "sigmoid":
            z = 1.0 / (1.0 + np.exp(-z))
        elif activation == "softmax":
            e = np.exp(z - z.max(axis=1, keepdims=True))
            z = e / e.sum(axis=1, keepdims=True)
        for i, row in zip(some, z):
            out[i] = row
        return pd.Series(out, dtype=object)
    return _score


def dense_forward(arr: Column | str, weights: list[list[float]], bias: list[float], activation: str = "linear") -> Column:
    """act(x · W + b) for one dense layer; ``weights`` is in_dim × out_dim (row-major lists).

    The layer (model-sized) ships with the function; each task multiplies a whole Arrow batch of
    rows in one NumPy call. Softmax subtracts the row maximum before exponentiating.
    """
    if activation not in ("linear", "relu", "sigmoid", "softmax"):
        raise ValueError(activation)
    return _matmul_udf(np.asarray(weights, dtype=np.float64), np.asarray(bias, dtype=np.float64), activation)(_c(arr))


def activate(z: Column, activation: str) -> Column:
    if activation == "linear":
        return z
    if activation == "relu":
        return F.transform(z, lambda v: F.greatest(v, F.lit(0.0)))
    if activation == "sigmoid":
        return F.transform(z, lambda v: F.lit(1.0) / (F.lit(1.0) + F.exp(-v)))
    if activation == "softmax":
        mx = F.array_max(z)
        ex = F.transform(z, lambda v: F.exp(v - mx))
        total = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
        return F.transform(ex, lambda v: v / total)
    raise ValueError(activation)


def argmax(arr: Column | str) -> Column:
    """0-based index of the largest value; the first one wins on ties."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def threshold_class(score: Column | str, threshold: float = 0.5) -> Column:
    return (_c(score) > F.lit(threshold)).cast("int")


def one_hot(label: Column | str, k: int) -> Column:
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == lab).cast("int"))


def dot_rows(df: DataFrame, vec: str, others: list[list[float]], out: str = "dots") -> DataFrame:
    """A·Bᵀ for a small B given as rows: one array of |B| dot products per row of A.

    B ships with the scoring function (the caller checks its size), so no join or shuffle is needed.
    """
    b = np.asarray(others, dtype=np.float64)
    return df.withColumn(out, _matmul_udf(b.T, np.zeros(b.shape[0]), "linear")(F.col(vec)))


# ------------------------------------------------------------------------------ 2-D geometry

def translate(x: Column, y: Column, dx: float, dy: float) -> tuple[Column, Column]:
    return x + F.lit(dx), y + F.lit(dy)


def rotate(x: Column, y: Column, theta: float) -> tuple[Column, Column]:
    c, s = math.cos(theta), math.sin(theta)
    return x * F.lit(c) - y * F.lit(s), x * F.lit(s) + y * F.lit(c)


def scale(x: Column, y: Column, sx: float, sy: float) -> tuple[Column, Column]:
    return x * F.lit(sx), y * F.lit(sy)


def linear_map(x: Column, y: Column, m: tuple[tuple[float, float], tuple[float, float]],
               t: tuple[float, float] = (0.0, 0.0)) -> tuple[Column, Column]:
    """Affine map [x', y'] = M·[x, y] + t (a linear map when t = 0)."""
    return (x * F.lit(m[0][0]) + y * F.lit(m[0][1]) + F.lit(t[0]),
            x * F.lit(m[1][0]) + y * F.lit(m[1][1]) + F.lit(t[1]))
