"""Quality rules: robust multivariate outliers per language and source.

Every text gets a vector of transformed statistics (log word count, mean word length, square roots
of the shares of symbols, duplicate lines, repeated words and capitals). Per (language, source) a
minimum-covariance-determinant estimate is fitted. It has ``STARTS`` + 1 starts: medians and absolute
deviations, and the moments of a few rows each, picked by seeded hashes of their statistics. All go
through concentration steps – keep the share ``H`` of rows with the smallest distance, take their mean
and covariance, measure again; of each group's estimates the one of least determinant goes on to the
last steps and one reweighting step. All of it is SQL expressions and grouped aggregates; the inverse is
applied by forward substitution with the Cholesky factor, one column expression per entry.

A row is rejected if its squared Mahalanobis distance lies beyond the chi-square quantile that a normal
row passes with probability 1 - ``ALPHA``. Distances are divided by the group's consistency factor: its
median distance over the chi-square median, at least 1.

Groups with fewer than ``MIN_GROUP`` rows that pass the base rule are judged by an estimate from all such
rows of their language, and languages that small by one from all such rows of the table. A ridge
(``FLOOR`` squared on the diagonal) stands for the least spread a statistic is believed to have, so that
a statistic which is 0 in nearly all clean texts does not reject the few clean ones that have a little of it.

Defined results: a null text counts as empty (all counts 0, base rule fails, not kept); null lang or
source form a group of their own; repeated rows stay separate rows; an empty table gives no rows;
texts without words have the zero vector. Extra columns are carried unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import SPACE, broadcast_if_small, stored, unpack, whole_row

STATS = ["x_len", "x_word", "x_symbol", "x_line", "x_repeat", "x_upper"]
#: Least standard deviation of each statistic (ridge of the covariance).
FLOOR = [0.3, 0.35, 0.045, 0.22, 0.15, 0.06]
H = 0.75          # share of rows that a concentration step keeps
STARTS = 4        # starts from few rows, beside the one from medians
START_ROWS = 7    # rows that such a start has on average, one more than statistics
TRIALS = 2        # concentration steps of every start
STEPS = 2         # further ones of the start of least determinant
MIN_GROUP = 60    # rows that an estimate needs
ALPHA = 1e-6      # share of normal rows that the cutoff rejects
MAX_BROADCAST_GROUPS = 20_000

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "distance2"]


def chi2_quantile(q: float, freedom: int = len(STATS)) -> float:
    """Quantile of chi-square with an even number of degrees of freedom, by bisection."""
    def beyond(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid) > 1 - q else (low, mid)
    return high


def text_statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    """One row per document: carried columns as ``_row``, the group columns, the base counts."""
    t = docs.select(whole_row(docs.select(*[F.col(f"`{c}`") for c in carry])),
                    F.coalesce(F.col("lang"), F.lit("\u0000")).alias("_lang"),
                    F.coalesce(F.col("source"), F.lit("\u0000")).alias("_source"),
                    F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    t = t.withColumns({
        "_w": F.array_remove(F.split("_text", SPACE, -1), ""),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    t = t.select("_row", "_lang", "_source", "_w",
                 F.size("_w").cast("long").alias("n_words"),
                 F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                 F.length(F.regexp_replace("_text", r"[^A-Z]+", "")).cast("long").alias("_n_upper"),
                 F.size("_lines").cast("long").alias("_n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    # hashes of the 3-word windows, by their position
    t = t.withColumn("_h", F.expr(
        "CASE WHEN n_words < 3 THEN array() ELSE transform(sequence(0, size(_w) - 3), "
        "i -> xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))) END"))
    # Texts without a repeated window are done; the others sort (hash, position), keep the windows
    # equal to a neighbour and count the distinct words that these cover. The one-element array
    # binds the sorted list to a name so that it is built once.
    t = t.withColumn("n_repeat_words", F.expr("""
        CASE WHEN size(array_distinct(_h)) = size(_h) THEN 0L ELSE
        transform(array(sort_array(transform(_h, (h, i) -> struct(h AS h, i AS i)))), s ->
          CAST(size(array_distinct(flatten(transform(
            filter(s, (x, k) -> (k > 0 AND get(s, k - 1).h = x.h) OR
                                (k + 1 < size(s) AND get(s, k + 1).h = x.h)),
            x -> array(x.i, x.i + 1, x.i + 2))))) AS BIGINT))[0] END"""))
    return t.drop("_w", "_h")


def _vector(t: DataFrame) -> DataFrame:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("_n_lines", F.lit(1))
    return t.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "x_len": F.log1p("n_words"),
        "x_word": F.col("word_chars") / words,
        "x_symbol": F.sqrt(F.col("n_symbols") / chars),
        "x_line": F.sqrt(F.col("n_dup_lines") / lines),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
        "x_upper": F.sqrt(F.col("_n_upper") / chars),
    })


def _groups(v: DataFrame) -> DataFrame:
    """Adds ``_g``, the group whose estimate judges a row – (language, source), or the language, or the
    whole table, whichever has rows enough among the texts that pass the base rule –, and ``_fits``, all
    groups whose estimates it takes part in."""
    pair = v.groupBy("_lang", "_source").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("_n"))
    lang = pair.groupBy("_lang").agg(F.sum("_n").alias("_nl"), F.min(F.when(F.col("_n") > 0, F.col("_n"))).alias("_least"))
    pair = stored(pair.join(lang, "_lang"), "mcd-sizes")
    rare = pair.filter((F.col("_nl") > 0) & (F.col("_nl") < MIN_GROUP)).limit(1).count() > 0
    own = F.concat_ws("\u0001", F.lit("s"), "_lang", "_source")
    by_lang, whole = F.concat_ws("\u0001", F.lit("l"), "_lang"), F.lit("all")
    pair_fits, lang_fits = F.col("_n") >= MIN_GROUP, F.col("_nl") >= MIN_GROUP
    level = stored(pair.select(
        "_lang", "_source", F.when(pair_fits, own).when(lang_fits, by_lang).otherwise(whole).alias("_g"),
        F.array_compact(F.array(F.when(pair_fits, own), F.when(lang_fits & (F.col("_least") < MIN_GROUP), by_lang),
                                F.when(F.lit(rare), whole))).alias("_fits")), "mcd-groups")
    return v.join(broadcast_if_small(level, MAX_BROADCAST_GROUPS), ["_lang", "_source"])


def _names() -> list[str]:
    p = len(STATS)
    return [f"m{i}" for i in range(p)] + [f"l{i}{j}" for i in range(p) for j in range(i + 1)]


def _with_distance(v: DataFrame, est: DataFrame, how: str = "inner") -> DataFrame:
    """Adds ``distance2`` (null where the group has no estimate), a row for each estimate of the group;
    the substitution is spread over projections, one per statistic, so that no expression repeats the
    earlier ones."""
    out = v.join(broadcast_if_small(est, MAX_BROADCAST_GROUPS), "_g", how)
    total = F.lit(0.0)
    for i, x in enumerate(STATS):
        left = F.col(x) - F.col(f"m{i}")
        for j in range(i):
            left = left - F.col(f"l{i}{j}") * F.col(f"_z{j}")
        out = out.withColumn(f"_z{i}", left / F.col(f"l{i}{i}"))
        total = total + F.col(f"_z{i}") * F.col(f"_z{i}")
    return out.withColumn("distance2", total).drop(*_names(), *[f"_z{i}" for i in range(len(STATS))])


def _estimate(rows: DataFrame, keys: tuple[str, ...] = ("_g",)) -> DataFrame:
    """Mean and Cholesky factor of the covariance with the ridge, per group, as the columns m0.. and l00..."""
    p = len(STATS)
    aggs = [F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)]
    aggs += [F.covar_pop(STATS[i], STATS[j]).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)]
    out = rows.groupBy(*keys).agg(*aggs)
    for i in range(p):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") + (FLOOR[i] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(FLOOR[i] ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    return out.select(*keys, *_names())


def _starts(v: DataFrame) -> DataFrame:
    """The starts ``_k`` of every group: 0 has medians and scaled absolute deviations as a diagonal
    estimate, the others the moments of the rows that a hash of the statistics picks."""
    med = stored(v.groupBy("_g").agg(F.count("*").alias("_n"), *[F.percentile_approx(x, 0.5, 2000).alias(f"m{i}")
                                                                 for i, x in enumerate(STATS)]), "mcd-median")
    both = v.join(broadcast_if_small(med, MAX_BROADCAST_GROUPS), "_g")
    dev = both.groupBy("_g").agg(*[F.max(f"m{i}").alias(f"m{i}") for i in range(len(STATS))],
                                 *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 2000).alias(f"d{i}")
                                   for i, x in enumerate(STATS)])
    middle = dev.select("_g", F.lit(0).alias("_k"), *[f"m{i}" for i in range(len(STATS))],
                        *[(F.sqrt((1.4826 * F.col(f"d{i}")) ** 2 + FLOOR[i] ** 2) if i == j else F.lit(0.0))
                          .alias(f"l{i}{j}") for i in range(len(STATS)) for j in range(i + 1)])
    k = F.explode(F.array(*[F.lit(i + 1) for i in range(STARTS)])).alias("_k")
    draw = F.pmod(F.xxhash64("_k", *STATS), F.lit(1 << 31)) / float(1 << 31)
    few = both.select("_g", "_n", *STATS, k).filter(draw < F.lit(float(START_ROWS)) / F.col("_n"))
    return middle.unionByName(_estimate(few, ("_g", "_k")))


def _concentrated(v: DataFrame, est: DataFrame, name: str) -> DataFrame:
    """One concentration step of every estimate (``_g``, ``_k``)."""
    keys = ["_g", "_k"]
    d = _with_distance(v, est)
    cut = stored(d.groupBy(*keys).agg(F.percentile_approx("distance2", H, 2000).alias("_cut")), f"mcd-cut{name}")
    near = d.join(broadcast_if_small(cut, MAX_BROADCAST_GROUPS), keys).filter("distance2 <= _cut")
    return stored(_estimate(near, tuple(keys)), f"mcd-step{name}")


def fit_mcd(v: DataFrame) -> DataFrame:
    """Estimates per group ``_g`` from the rows of ``v`` (a stored table), with the group's factor ``_scale``."""
    middle, normal = chi2_quantile(0.5), chi2_quantile(0.975)
    est = stored(_starts(v), "mcd-start")
    for step in range(TRIALS):
        est = _concentrated(v, est, f"-trial{step}")
    volume = sum((F.log(f"l{i}{i}") for i in range(1, len(STATS))), F.log("l00"))
    best = est.groupBy("_g").agg(F.min_by(F.struct("_k", *_names()), F.struct(volume, "_k")).alias("e"))
    est = stored(best.select("_g", "e.*"), "mcd-best")
    for step in range(STEPS):
        est = _concentrated(v, est, str(step))
    # The kept share's covariance is too small by a factor that the median distance shows; with
    # it, rows inside the 97.5 % ellipsoid give the final estimate.
    d = _with_distance(v, est)
    mid = stored(d.groupBy("_g").agg((F.percentile_approx("distance2", 0.5, 2000) / middle).alias("_f")), "mcd-mid")
    inside = (d.join(broadcast_if_small(mid, MAX_BROADCAST_GROUPS), "_g")
              .filter(F.col("distance2") <= normal * F.greatest("_f", F.lit(0.05))))
    est = stored(_estimate(inside), "mcd-final")
    spread = _with_distance(v, est).groupBy("_g").agg(
        F.greatest(F.percentile_approx("distance2", 0.5, 2000) / middle, F.lit(1.0)).alias("_scale"))
    return stored(est.join(spread, "_g"), "mcd-estimates")


def robust_quality(docs: DataFrame, carry: list[str] | None = None, alpha: float = ALPHA) -> DataFrame:
    """Base counts and the verdict ``kept`` for every row of ``docs`` (columns text, lang, source);
    ``carry`` names the columns to return beside the results (default: all)."""
    v = _groups(stored(_vector(text_statistics(docs, docs.columns if carry is None else carry)), "mcd-vectors"))
    fit = stored(v.filter(~F.col("base_failed")).select(F.explode("_fits").alias("_g"), *STATS), "mcd-fit")
    out = _with_distance(v, fit_mcd(fit), "left").withColumn("distance2", F.col("distance2") / F.col("_scale"))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= chi2_quantile(1 - alpha)))
    return unpack(out, RESULTS)
