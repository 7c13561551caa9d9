"""Exact row positions without pulling the table into one task.

A global ``row_number()`` (a window with no partition) moves every row to a single task.
Here the position comes from small jobs and one shuffle:

1. cut points of the leading order key from ONE ``percentile_approx`` aggregate (only the cut
   values, a bounded list, reach the driver);
2. a leading value that fills more than one interval (it repeats among the cut points – a hot
   key) is split again by the second key: one more ``percentile_approx`` over just those rows;
3. every row gets its interval (``Bucketizer``, a JVM binary search; hot values get their
   sub-interval from a multi-column ``Bucketizer`` with one column of cut points per hot value);
4. rows per interval (a partial aggregate) → running offsets on that tiny table;
5. ``row_number`` within ``partitionBy(interval).orderBy(keys)`` plus the broadcast offset.

Keys are numeric, temporal or strings; strings are cut on an order-preserving numeric prefix of
their bytes. The result equals a global ``row_number() - 1`` whenever the keys form a total order,
whatever cut points the sketch returns, so repeated runs give the same positions.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import cut_lineage

# Hard cap on the number of intervals. The offsets table has one row per interval, so this is
# also the proven size bound of the broadcast side in step 5.
MAX_BUCKETS = 65536
# Hot leading values split into at most this many sub-intervals each; at most MAX_HOT of them.
MAX_SUB_BUCKETS = 1024
MAX_HOT = 64
# Above MAX_HOT of them the rows are cut on all keys together, by Spark's range partitioning.
# Below this many rows per interval on average, repeated cut points only mean "few rows": skip.
MIN_ROWS_PER_INTERVAL = 64
# An interval up to this many rows is ranked in one window task when looking up single positions.
DIRECT_RANK_ROWS = 2_000_000

# Finite proxies of values without a place on the number line: infinities and NaN sort inside the
# proxies of null, and all of them can be cut points like any other value.
FAR, FARTHEST, NULL_FAR = 1.5e308, 1.6e308, 1.7e308

KeySpec = str | tuple[str, str]


def _n_buckets(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return max(1, min(int(buckets), MAX_BUCKETS))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(parts, MAX_BUCKETS))


def _spec(k: KeySpec) -> tuple[str, bool]:
    if isinstance(k, str):
        return k, False
    name, direction = k
    return name, direction.lower() == "desc"


def order_proxy(df: DataFrame, name: str, desc: bool = False, prefix: str = "") -> Column:
    """A double that never decreases along the sort order of ``name`` (ties allowed).

    Numbers and times map to themselves; strings to 7 bytes read as a big-endian integer, taken
    after the ``prefix`` (hex digits) that most values share, values below or above it being placed
    before or after all of those by their own first bytes (shorter strings are zero-padded, which
    keeps prefixes first, as in byte order). Nulls go first for ascending and last for
    descending order, NaN after every number in ascending order, like Spark's defaults.
    """
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, T.TimestampNTZType):
        # wall-clock microseconds from the fields themselves: no session zone, so no DST gaps
        secs = (F.unix_date(F.to_date(c)).cast("double") * 86400.0 + F.hour(c) * 3600.0 + F.minute(c) * 60.0)
        v = secs * 1e6 + F.date_part(F.lit("SECOND"), c).cast("double") * 1e6
    elif isinstance(dt, T.TimestampType):
        v = F.unix_micros(c).cast("double")
    elif isinstance(dt, T.DateType):
        v = F.unix_date(c).cast("double")
    elif isinstance(dt, (T.StringType, T.BinaryType)):
        h, far = F.hex(c), F.lit(float(1 << 57))
        v = _leading(h, len(prefix)).cast("double")
        if prefix:
            v = (F.when(h.startswith(prefix), v).when(h < prefix, _leading(h, 0).cast("double") - far)
                 .otherwise(_leading(h, 0).cast("double") + far))
    else:
        v = c.cast("double")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        v = F.when(F.isnan(v), F.lit(FARTHEST)).otherwise(F.least(F.greatest(v, F.lit(-FAR)), F.lit(FAR)))
    return F.coalesce(-v, F.lit(NULL_FAR)) if desc else F.coalesce(v, F.lit(-NULL_FAR))


def common_prefix(df: DataFrame, name: str, most: int = 16) -> str:
    """Hex digits that at least the middle half of the values of ``name`` begin with, 6 bytes at a
    time (exact as doubles): while the quartiles of the next 6 bytes coincide, they are part of it. Values that begin
    otherwise (outliers) do not shorten it."""
    h, prefix = F.hex(F.col(f"`{name}`")), ""
    for _ in range(most):
        nxt = _leading(h, len(prefix), 12)
        r = df.where(h.startswith(prefix)).agg(F.percentile_approx(nxt, [0.25, 0.75], 1000).alias("c")).first()["c"]
        if not r or r[0] != r[1]:
            break
        step = f"{int(r[0]):012X}"
        if step.endswith("00"):                   # the end of the value, not a prefix of longer ones
            break
        prefix += step
    return prefix


def _leading(hex_value: Column, skip: int, digits: int = 14) -> Column:
    """The ``digits`` hex digits after the first ``skip`` as an integer, zero-padded (prefixes first)."""
    return F.conv(F.rpad(F.substring(hex_value, skip + 1, digits), digits, "0"), 16, 10).cast("bigint")


def _plain(value):
    """A dictionary key for a collected value: NaN is not equal to itself."""
    return "NaN" if isinstance(value, float) and value != value else value


def _order(k: KeySpec) -> Column:
    name, desc = _spec(k)
    return F.col(f"`{name}`").desc_nulls_last() if desc else F.col(f"`{name}`").asc_nulls_first()


def with_position(df: DataFrame, keys: KeySpec | list[KeySpec], pos_col: str = "pos",
                  buckets: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Add ``pos_col``: the 0-based position of each row when ordered by ``keys``.

    ``keys`` are column names (ascending) or ``(name, "desc")`` pairs; together they must be
    unique for the position to be well defined.
    """
    return with_position_and_count(df, keys, pos_col, buckets, accuracy)[0]


def _by_range(df: DataFrame, keys: list[KeySpec], pos_col: str, nb: int, keep_intervals: bool = False) -> DataFrame:
    """Positions by range partitioning on all keys: bounds are key tuples, so any number of hot values
    on any of the keys is split wherever rows differ in a later key. The ordered partitions are stored
    once; a row's place in its partition plus the rows of the partitions before it is its position."""
    at, part = "__kiln_at", "__kiln_b1"
    order = [_order(k) for k in keys]
    placed = df.repartitionByRange(nb, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    placed = cut_lineage(placed).withColumn(part, F.shiftright(at, 33).cast("int")).withColumn("__kiln_b2", F.lit(0))
    offsets = (placed.groupBy(part).agg(F.count(F.lit(1)).alias("__kiln_n"))          # one row per partition
               .withColumn("__kiln_off", F.coalesce(F.sum("__kiln_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .drop("__kiln_n"))
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(offsets), part).withColumn(pos_col, (place + F.col("__kiln_off")).cast("bigint"))
            .drop(at, "__kiln_off", *([] if keep_intervals else [part, "__kiln_b2"])))


def _intervals(df: DataFrame, keys: list[KeySpec], buckets: int | None, accuracy: int) -> tuple[DataFrame, int, bool]:
    """Steps 1-3: the rows with their interval ids (``__kiln_b1``, ``__kiln_b2``), the row count, and whether
    there are more hot values than can be split here."""
    nb = _n_buckets(df, buckets)
    p1, p2, b1, b2 = "__kiln_p1", "__kiln_p2", "__kiln_b1", "__kiln_b2"

    lead, lead_desc = _spec(keys[0])
    lead_type = df.schema[lead].dataType
    prefix = common_prefix(df, lead) if isinstance(lead_type, (T.StringType, T.BinaryType)) else ""
    keyed = df.withColumn(p1, order_proxy(df, lead, lead_desc, prefix))
    probs = [i / nb for i in range(1, max(nb, 2))]
    # The sketch must resolve finer than one interval, or unique keys would look like hot values.
    accuracy = max(int(accuracy), 4 * nb)
    row = keyed.agg(F.percentile_approx(p1, probs, accuracy).alias("c"), F.count(F.lit(1)).alias("n")).first()
    n_rows = int(row["n"])
    cuts_all = [float(x) for x in (row["c"] or []) if x is not None] if nb > 1 else []
    cuts = sorted(set(cuts_all))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=p1, outputCol=b1, handleInvalid="keep").transform(keyed)
    bucketed = bucketed.withColumn(b1, F.col(b1).cast("int"))

    # Hot leading values. A cut point repeated in the sketch marks an interval holding more than one
    # interval's share of rows. The dominant actual value behind it (found by value, not proxy) has
    # its rows cut again on the second key: sub-intervals 1..k. Rows of the same interval that sort
    # before that value get sub-interval 0, all others come after. Exact for any key type.
    after = F.lit(MAX_SUB_BUCKETS + 2)
    sub = after
    hot = {v: n for v, n in Counter(cuts_all).items() if n >= 2}
    many_hot = len(hot) > MAX_HOT and len(keys) > 1 and n_rows >= MIN_ROWS_PER_INTERVAL * nb
    hot = dict(sorted(hot.items(), key=lambda kv: -kv[1])[:MAX_HOT])
    drop = [p1]
    if hot and len(keys) > 1 and n_rows >= MIN_ROWS_PER_INTERVAL * nb:
        lc = F.col(f"`{lead}`")
        cand = (bucketed.where(F.col(p1).isin(list(hot))).groupBy(p1, lc.alias("__kiln_v"))
                .agg(F.count(F.lit(1)).alias("__kiln_n"))
                .where(F.col("__kiln_n") >= max(1, n_rows // (2 * nb)))
                .orderBy(F.col("__kiln_n").desc()).limit(4 * MAX_HOT).collect())      # bounded
        chosen: dict[float, object] = {}
        for r in cand:                          # heaviest actual value per hot cut point
            chosen.setdefault(r[p1], r["__kiln_v"])
        if chosen:
            second, second_desc = _spec(keys[1])
            bucketed = bucketed.withColumn(p2, order_proxy(df, second, second_desc))
            drop.append(p2)
            k = min(max(hot[v] for v in chosen) + 1, MAX_SUB_BUCKETS)
            probs2 = [i / k for i in range(1, k)]
            is_value = {v: lc.isNull() if actual is None else lc.eqNullSafe(F.lit(actual)) for v, actual in chosen.items()}
            is_hot = F.lit(False)
            for cond in is_value.values():
                is_hot = is_hot | cond
            sub_rows = {_plain(r["__kiln_v"]): r["c"] for r in
                        bucketed.where(is_hot).groupBy(lc.alias("__kiln_v"))
                        .agg(F.percentile_approx(p2, probs2, accuracy).alias("c")).collect()}  # <= MAX_HOT
            ins, outs, splits2, cases = [], [], [], None
            for j, (v, actual) in enumerate(chosen.items()):
                inner = sorted({float(x) for x in (sub_rows.get(_plain(actual)) or []) if x is not None})
                is_v = is_value[v]
                bucketed = bucketed.withColumn(f"__kiln_h{j}", F.when(is_v, F.col(p2)).otherwise(F.lit(float("-inf"))))
                ins.append(f"__kiln_h{j}")
                outs.append(f"__kiln_s{j}")
                splits2.append([float("-inf")] + (inner or [0.0]) + [float("inf")])
                before = (F.lit(False) if actual is None else
                          (F.col(p1) == F.lit(v)) & ((lc > F.lit(actual)) if lead_desc else (lc < F.lit(actual))))
                step = F.when(is_v, F.col(f"__kiln_s{j}") + 1).when(before, F.lit(0))
                cases = step if cases is None else cases.when(is_v, F.col(f"__kiln_s{j}") + 1).when(before, F.lit(0))
            # One JVM binary search per hot value's column (its own cut points), all in one pass.
            bucketed = Bucketizer(splitsArray=splits2, inputCols=ins, outputCols=outs,
                                  handleInvalid="keep").transform(bucketed)
            sub = cases.otherwise(after)
            drop += ins + outs
    bucketed = bucketed.withColumn(b2, sub.cast("int")).drop(*drop)
    return bucketed, n_rows, many_hot


def with_position_and_count(df: DataFrame, keys: KeySpec | list[KeySpec], pos_col: str = "pos",
                            buckets: int | None = None, accuracy: int = 10000,
                            keep_intervals: bool = False) -> tuple[DataFrame, int]:
    """:func:`with_position` plus the row count, taken from the same aggregate as the cut points.

    ``keep_intervals`` keeps the interval ids (``__kiln_b1``, ``__kiln_b2``) for inspecting balance.
    """
    keys = [keys] if isinstance(keys, (str, tuple)) else list(keys)
    b1, b2 = "__kiln_b1", "__kiln_b2"
    bucketed, n_rows, many_hot = _intervals(df, keys, buckets, accuracy)
    if many_hot:
        return _by_range(df, keys, pos_col, _n_buckets(df, buckets), keep_intervals), n_rows

    # Offsets: one row per (interval, sub-interval) – bounded – running sum over a tiny table.
    offsets = (bucketed.groupBy(b1, b2).agg(F.count(F.lit(1)).alias("__kiln_n"))
               .withColumn("__kiln_off",
                           F.coalesce(F.sum("__kiln_n").over(
                               Window.orderBy(b1, b2).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .drop("__kiln_n"))
    w = Window.partitionBy(b1, b2).orderBy(*[_order(k) for k in keys])
    return (bucketed.join(F.broadcast(offsets), [b1, b2])
            .withColumn(pos_col, (F.row_number().over(w) - 1 + F.col("__kiln_off")).cast("bigint"))
            .drop(*([] if keep_intervals else [b1, b2]), "__kiln_off")), n_rows


def keys_at_positions(df: DataFrame, keys: list[str], positions, buckets: int | None = None,
                       accuracy: int = 10000) -> tuple[dict[int, tuple], int]:
    """The key tuples of the rows at the given 0-based positions (ascending ``keys`` order), and n.

    ``positions`` is a list, or a function of the row count returning one. Only the rows of the
    interval that holds a wanted position are ranked (with this same index, so a hot interval is
    split again); the table itself is never ordered as a whole.
    """
    b1, b2 = "__kiln_b1", "__kiln_b2"
    bucketed, n_rows, _ = _intervals(df, keys, buckets, accuracy)
    if callable(positions):
        positions = positions(n_rows)
    wanted = sorted({p for p in positions if 0 <= p < n_rows})
    if not wanted:
        return {}, n_rows
    sizes = sorted((r[b1], r[b2], r["n"]) for r in bucketed.groupBy(b1, b2)
                   .agg(F.count(F.lit(1)).alias("n")).collect())             # one row per interval
    found: dict[int, tuple] = {}
    small, large = [], []
    start = 0
    for x1, x2, n in sizes:
        inside = [p - start for p in wanted if start <= p < start + n]
        if inside:
            (small if n <= DIRECT_RANK_ROWS else large).append((x1, x2, start, inside))
        start += n
    cols = [F.col(f"`{k}`") for k in keys]
    if small:
        # all small intervals that hold a wanted row: ranked together, one window task per interval
        cond = None
        for x1, x2, _, _ in small:
            c = (F.col(b1) == x1) & (F.col(b2) == x2)
            cond = c if cond is None else (cond | c)
        w = Window.partitionBy(b1, b2).orderBy(*[c.asc_nulls_first() for c in cols])
        ranked = bucketed.where(cond).select(b1, b2, *cols, (F.row_number().over(w) - 1).alias("__kiln_r"))
        want = {(x1, x2, r): st + r for x1, x2, st, inside in small for r in inside}
        for r in ranked.where(F.col("__kiln_r").isin(sorted({q for *_, ins in small for q in ins}))).collect():
            at = want.get((r[b1], r[b2], r["__kiln_r"]))
            if at is not None:
                found[at] = tuple(r[k] for k in keys)
    for x1, x2, start, inside in large:
        # a large interval (a hot value): ranked by this same index, so it is split again
        rows = bucketed.where((F.col(b1) == x1) & (F.col(b2) == x2)).select(*cols)
        ranked = with_position(rows, keys, pos_col="__kiln_r", buckets=buckets, accuracy=accuracy)
        for r in ranked.where(F.col("__kiln_r").isin(inside)).collect():
            found[start + r["__kiln_r"]] = tuple(r[k] for k in keys)
    return found, n_rows


def before_keys(keys: list[str], values: tuple) -> Column:
    """True for rows that sort before ``values`` in ascending ``keys`` order (nulls first)."""
    expr = None
    for k, v in reversed(list(zip(keys, values))):
        c = F.col(f"`{k}`")
        if v is None:
            less, equal = F.lit(False), c.isNull()
        else:
            less, equal = c.isNull() | (c < F.lit(v)), c.eqNullSafe(F.lit(v))
        expr = less if expr is None else (less | (equal & expr))
    return expr


def hash_unit(key: Column | str, seed: int = 42) -> Column:
    """Deterministic draw in [0, 1) from ``md5(key || '|' || seed)``.

    The first 8 hex digits as an unsigned integer over 2**32; the same formula runs in DuckDB as
    ``('0x' || substr(md5(k || '|42'), 1, 8))::BIGINT / 4294967296.0``.
    """
    return hash_int(key, seed) / F.lit(4294967296.0)


def hash_int(key: Column | str, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
