"""Splits, slices, shuffles and batches.

Every positional operator goes through :func:`kiln.operators.position.with_position`, so no step
pulls the table into one task. Hash splits need no shuffle at all.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.position import (before_keys, hash_int, hash_unit, keys_at_positions, with_position,
                                     with_position_and_count)


def split_sizes(n: int, train_fraction: float = 0.7, eval_fraction: float | None = None) -> tuple[int, int, int]:
    """train = int(n * 0.7); the rest is halved, eval gets the floor (or int(n * eval_fraction) when
    that is given), serving the remainder."""
    train = int(n * train_fraction)
    rest = n - train
    ev = rest // 2 if eval_fraction is None else min(int(n * eval_fraction), rest)
    return train, ev, rest - ev


def split_positional(df: DataFrame, key: str | list[str], train_fraction: float = 0.7,
                     split_col: str = "split", pos_col: str = "pos", with_positions: bool = False,
                     materialize: bool = False, eval_fraction: float | None = None) -> DataFrame:
    """Tag rows 'train' / 'eval' / 'serving' by their position in ``key`` order (ascending).

    Sizes follow :func:`split_sizes`. Only two rows decide the split: the first eval row and the
    first serving row. Their keys are found by ranking just the interval that holds each of them
    (:func:`keys_at_positions`); every row is then tagged by comparing its key with those two –
    a projection, so the table is never shuffled or sorted as a whole. With ``with_positions`` each
    row also gets its exact position (``pos_col``), which does order the whole table (distributed
    index); ``materialize`` then checkpoints that result to the shared folder.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if with_positions:
        positioned, n = with_position_and_count(df, keys, pos_col=pos_col)
        train, ev, _ = split_sizes(n, train_fraction, eval_fraction)
        if materialize:
            from kiln.session import cut_lineage
            positioned = cut_lineage(positioned)
        return positioned.withColumn(
            split_col,
            F.when(F.col(pos_col) < train, "train").when(F.col(pos_col) < train + ev, "eval").otherwise("serving"))

    def bounds(n: int) -> list[int]:
        train, ev, _ = split_sizes(n, train_fraction, eval_fraction)
        return [train, train + ev]

    found, n = keys_at_positions(df, keys, bounds)
    first_eval, first_serving = bounds(n)
    in_train = before_keys(keys, found[first_eval]) if first_eval in found else F.lit(True)
    in_eval = before_keys(keys, found[first_serving]) if first_serving in found else F.lit(True)
    return df.withColumn(split_col, F.when(in_train, "train").when(in_eval, "eval").otherwise("serving"))


def splits_of(tagged: DataFrame, label: str | None = None, split_col: str = "split",
              names: tuple[str, ...] = ("train", "eval", "serving"),
              drop: tuple[str, ...] = ("pos",)) -> dict[str, DataFrame]:
    """Separate a tagged frame; the label is dropped from the serving part."""
    out = {}
    for name in names:
        part = tagged.filter(F.col(split_col) == name).drop(split_col, *[c for c in drop if c in tagged.columns])
        if name == "serving" and label:
            part = part.drop(label)
        out[name] = part
    return out


def split_hash(df: DataFrame, key: str, seed: int = 42, bounds: tuple[float, float] = (0.70, 0.85),
               split_col: str = "split", names: tuple[str, str, str] = ("train", "eval", "test")) -> DataFrame:
    """Independent, repeatable draw per row: u < 0.70 train, u < 0.85 eval, else test."""
    u = hash_unit(key, seed)
    return df.withColumn(split_col, F.when(u < bounds[0], names[0])
                         .when(u < bounds[1], names[1]).otherwise(names[2]))


def shuffle_seeded(df: DataFrame, key: str, seed: int = 42, pos_col: str = "shuffle_pos") -> DataFrame:
    """Seeded shuffle: each row gets its place in a repeatable random order.

    Inputs and targets are columns of the same row, so they can never be separated. The order
    is (hash of key, key); the position comes from the distributed index.
    """
    h = "__kiln_h"
    return with_position(df.withColumn(h, hash_int(key, seed)), [h, key], pos_col=pos_col).drop(h)


def batch_assign(df: DataFrame, key: str | list[str], size: int, batch_col: str = "batch_id",
                 pos_col: str = "pos") -> DataFrame:
    """Fixed-size batches in key order: ``ceil(n / size)`` batches, the last one short."""
    return with_position(df, key, pos_col=pos_col).withColumn(
        batch_col, F.floor(F.col(pos_col) / F.lit(size)).cast("bigint"))


def n_batches(n: int, size: int) -> int:
    return math.ceil(n / size)


def slice_head(df: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """First ``n`` rows in key order (a distributed top-n: each task keeps n, then a merge)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def slice_range_by_class(df: DataFrame, class_col: str, key: str, start: int, end: int,
                         rank_col: str = "class_pos") -> DataFrame:
    """Rows [start, end) inside each class, in key order.

    The filter is written on the raw ``row_number`` (``rn <= end``) so that Spark inserts a partial
    per-class limit before the shuffle (window group limit, for ``end`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``): a hot class ships at most ``end`` rows
    per map task. Larger ranges use in-class ranks from the distributed position index over
    (class, key), so a hot class is still spread over many tasks.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if end <= limit:
        rn = "__kiln_rn"
        w = Window.partitionBy(class_col).orderBy(F.col(key))
        ranked = df.withColumn(rn, F.row_number().over(w))
        return (ranked.filter((F.col(rn) <= end) & (F.col(rn) > start))
                .withColumn(rank_col, (F.col(rn) - 1).cast("bigint")).drop(rn))
    from kiln.operators.analyze import broadcast_if_small
    g = "__kiln_gpos"
    pos = with_position(df, [class_col, key], pos_col=g)
    # a class starts after all rows of smaller classes: per-class counts, running sum (one row per class)
    first = (df.groupBy(class_col).agg(F.count(F.lit(1)).alias("__kiln_n"))
             .withColumn("__kiln_c0", F.coalesce(F.sum("__kiln_n").over(
                 Window.orderBy(F.col(class_col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)),
                 F.lit(0)))
             .drop("__kiln_n"))
    first = broadcast_if_small(first.withColumnRenamed(class_col, "__kiln_cls"))
    ranked = (pos.join(first, pos[class_col].eqNullSafe(first["__kiln_cls"]))      # null is a class too
              .drop("__kiln_cls")
              .withColumn(rank_col, (F.col(g) - F.col("__kiln_c0")).cast("bigint")))
    return ranked.filter((F.col(rank_col) >= start) & (F.col(rank_col) < end)).drop(g, "__kiln_c0")


def _holdout(df: DataFrame, key: str | list[str], n_val: int | None, fraction: float | None, tail: bool,
             role_col: str) -> DataFrame:
    """Tags rows by comparing their key with the one at the boundary; only the interval that holds
    the boundary is ranked, the table is not ordered as a whole. Keys must be unique."""
    keys = [key] if isinstance(key, str) else list(key)

    def bounds(n: int) -> list[int]:
        k = min(int(n * float(fraction or 0.0)) if n_val is None else n_val, n)
        return [n - k if tail else k]

    found, n = keys_at_positions(df, keys, bounds)
    at = bounds(n)[0]
    first = before_keys(keys, found[at]) if at in found else F.lit(at > 0)
    return df.withColumn(role_col, F.when(first, "train" if tail else "val").otherwise("val" if tail else "train"))


def holdout_head(df: DataFrame, key: str | list[str], n_val: int | None = None, fraction: float | None = None,
                 role_col: str = "role") -> DataFrame:
    """First ``n_val`` rows (or the first ``fraction`` of rows) in key order are validation."""
    return _holdout(df, key, n_val, fraction, False, role_col)


def holdout_tail(df: DataFrame, key: str | list[str], n_val: int | None = None,
                 fraction: float | None = None, role_col: str = "role") -> DataFrame:
    """Last ``n_val`` rows (or the last ``fraction`` of rows) are validation."""
    return _holdout(df, key, n_val, fraction, True, role_col)


def count_rows(tagged: DataFrame, split_col: str = "split") -> DataFrame:
    return tagged.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column: ONE aggregate over all columns, then unpivot to (column, n_null)."""
    cols = columns or df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("bigint").alias("n_null"))
                     for i, c in enumerate(cols)])
    return agg.select(F.inline(rows))


def concat_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
