"""Presentation helpers for registered query outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Values are first rounded to this many decimals: it removes last-bit differences that different
# summation orders leave behind, so the final rounding sees the same double on every engine. The
# SQL twins spell the same two steps out as round(round(x, 9), d).
GUARD_DIGITS = 9


def _round_to(col: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale)) / F.lit(scale)


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Round a double to ``digits`` decimals, as ``round(round(x, 9), d)`` with each step
    ``round(x * 10^d) / 10^d`` – the rounding a plain SQL engine applies to doubles – so both sides
    of an oracle check agree on half-way values."""
    col = F.col(c) if isinstance(c, str) else c
    return _round_to(_round_to(col.cast("double"), GUARD_DIGITS), digits)
