"""Model fitting as distributed jobs.

* :func:`linear_gd` – full-batch gradient descent for square loss. One aggregate builds the
  (d+1)×(d+1) Gram matrix XᵀX, Xᵀy, Σy² and n; every step's loss and gradient follow from those
  model-sized numbers, so 40 steps cost one pass over the data.
* MLlib estimators (logistic regression, multilayer perceptron) for the classifiers; their
  iterations aggregate with ``treeAggregate`` over the cached feature table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import cut_lineage


@dataclass
class GramSums:
    names: list[str]          # feature names; the last coefficient is the intercept
    a: list[list[float]]      # XᵀX with a column of ones appended
    c: list[float]            # Xᵀy
    syy: float
    n: float
    low: list[float | None] = field(default_factory=list)     # least and greatest value of each feature
    high: list[float | None] = field(default_factory=list)


def gram_sums(df: DataFrame, xs: list[str], y: str) -> GramSums:
    """ONE aggregate over the rows; only (d+1)² + (d+1) + 2 numbers reach the driver. Rows with a
    null feature or target take no part, in the sums or in the count."""
    cols = [F.col(x).cast("double") for x in xs] + [F.lit(1.0)]
    yy = F.col(y).cast("double")
    d = len(cols)
    # rows are left out inside the aggregate: a filter would compute generated columns a second time
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*xs, y)])
    aggs = []
    for i in range(d):
        for j in range(i, d):
            aggs.append(F.sum(F.when(whole, cols[i] * cols[j])).alias(f"a_{i}_{j}"))
        aggs.append(F.sum(F.when(whole, cols[i] * yy)).alias(f"c_{i}"))
        aggs += [F.min(F.when(whole, cols[i])).alias(f"lo_{i}"), F.max(F.when(whole, cols[i])).alias(f"hi_{i}")]
    aggs += [F.sum(F.when(whole, yy * yy)).alias("syy"), F.count_if(whole).alias("n")]
    r = df.agg(*aggs).first()
    a = [[0.0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            a[i][j] = a[j][i] = float(r[f"a_{i}_{j}"] or 0.0)
    return GramSums(list(xs), a, [float(r[f"c_{i}"] or 0.0) for i in range(d)], float(r["syy"] or 0.0), float(r["n"]),
                    [r[f"lo_{i}"] for i in range(d - 1)], [r[f"hi_{i}"] for i in range(d - 1)])


def linear_gd_from_sums(g: GramSums, lr: float = 0.1, steps: int = 40,
                        init: list[float] | None = None) -> list[tuple]:
    """(step, loss before the update, coefficients after it) for each step, from the sums alone.

    loss(w) = (wᵀAw - 2wᵀc + Σy²)/n;  gradient = 2(Aw - c)/n. Without rows the loss is null and the
    coefficients stay as they start.
    """
    d = len(g.c)
    w = list(init) if init else [0.0] * d
    out = []
    for step in range(1, steps + 1):
        if not g.n:
            out.append((step, None, *w))
            continue
        aw = [sum(g.a[i][j] * w[j] for j in range(d)) for i in range(d)]
        loss = (sum(w[i] * aw[i] for i in range(d)) - 2 * sum(w[i] * g.c[i] for i in range(d)) + g.syy) / g.n
        grad = [2 * (aw[i] - g.c[i]) / g.n for i in range(d)]
        w = [w[i] - lr * grad[i] for i in range(d)]
        out.append((step, loss, *w))
    return out


def linear_gd(df: DataFrame, xs: list[str], y: str, lr: float = 0.1, steps: int = 40) -> DataFrame:
    """Per-step loss and coefficients (w_<feature>..., b) as a small DataFrame."""
    g = gram_sums(df, xs, y)
    rows = linear_gd_from_sums(g, lr, steps)
    schema = "step int, loss double, " + ", ".join(f"w_{x} double" for x in xs) + ", b double"
    return df.sparkSession.createDataFrame(rows, schema)


def decision_boundary(spark: SparkSession, w: list[float], b: float, lo: float | None, hi: float | None, n: int = 50) -> DataFrame:
    """Points on the line W·x + b = 0.5 for a grid of n x-values in [lo, hi]:
    y = -W0/W1·x + (0.5 - b)/W1. Without a range there are no points; a vertical line (W1 = 0) has no y."""
    if lo is None or hi is None:
        return spark.createDataFrame([], "i long, x double, y double")
    if not w[1]:
        grid = spark.range(n).select(F.col("id").alias("i"), (F.lit(lo) + F.col("id") * F.lit((hi - lo) / (n - 1))).alias("x"))
        return grid.withColumn("y", F.lit(None).cast("double"))
    step = (hi - lo) / (n - 1)
    grid = spark.range(n).select(F.col("id").alias("i"), (F.lit(lo) + F.col("id") * F.lit(step)).alias("x"))
    return grid.withColumn("y", -F.lit(w[0] / w[1]) * F.col("x") + F.lit((0.5 - b) / w[1]))


def assemble(df: DataFrame, array_cols: list[str] = (), scalar_cols: list[str] = (), out: str = "features") -> DataFrame:
    """One feature vector from array columns (as dense vectors) and scalar columns."""
    if len(array_cols) == 1 and not scalar_cols:
        return df.withColumn(out, array_to_vector(F.col(array_cols[0])))
    tmp = []
    cur = df
    for c in array_cols:
        cur = cur.withColumn(f"__v_{c}", array_to_vector(F.col(c)))
        tmp.append(f"__v_{c}")
    va = VectorAssembler(inputCols=tmp + list(scalar_cols), outputCol=out, handleInvalid="error")
    return va.transform(cur).drop(*tmp)


def training_table(df: DataFrame) -> DataFrame:
    """Store a feature table for iterative fitting, then cache it at one partition per core.

    Every optimizer iteration is a job over all partitions; a table left with hundreds of small
    shuffle partitions would pay that task overhead on every step. The features are computed and
    checkpointed at their own partitioning first, so that merging partitions limits the parallelism
    of the re-read only. Call ``unpersist()`` on the result when the fit is done.
    """
    stored = cut_lineage(df)
    return stored.coalesce(df.sparkSession.sparkContext.defaultParallelism).persist()


def fit_logistic(train: DataFrame, label: str, features: str = "features", multinomial: bool = False,
                 max_iter: int = 50, reg: float = 0.0):
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                            family="multinomial" if multinomial else "auto")
    return lr.fit(train)


def fit_mlp(train: DataFrame, label: str, layers: list[int], features: str = "features", max_iter: int = 100,
            block_size: int = 128, seed: int = 42):
    """Dense network (sigmoid hidden layers, softmax output) – MLlib's multilayer perceptron,
    trained with L-BFGS over the distributed rows; ``block_size`` rows are stacked per matrix op."""
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers, maxIter=max_iter,
                                         blockSize=block_size, seed=seed)
    return mlp.fit(train)


def probabilities(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """Class probabilities per row, long form (keep..., class, prob)."""
    p = model.transform(df).select(*keep, vector_to_array("probability").alias("__p"))
    return p.select(*keep, F.posexplode("__p").alias("class", "prob"))
