"""Arithmetic that never raises, and the two rounding rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.functions.dates import col


def safe_div(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def round_half_up(c, digits: int = 2) -> Column:
    return F.round(col(c), digits)


def round_half_even(c, digits: int = 2) -> Column:
    return F.bround(col(c), digits)


def finite_or_null(c) -> Column:
    """Double value; NULL for text that is not a number, NaN and the infinities."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def greatest_strict(*cols) -> Column:
    """Largest argument; NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(~any_null, F.greatest(*cs) if len(cs) > 1 else cs[0])


def null_safe_eq(a, b) -> Column:
    return col(a).eqNullSafe(col(b))


def safe_corr(a, b, window=None) -> Column:
    """Pearson r over the rows where both are present, NULL where one of them is constant."""
    x, y = col(a), col(b)
    both = x.isNotNull() & y.isNotNull()
    parts = F.covar_pop(x, y), F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))
    joint, sx, sy = (p if window is None else p.over(window) for p in parts)
    return F.try_divide(joint, sx * sy)


def row_mean(cols) -> Column:
    """Mean across columns, NULLs skipped."""
    present = F.array_compact(F.array(*[col(c).cast("double") for c in cols]))
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(present) > 0, total / F.size(present))


def row_std(cols) -> Column:
    """Standard deviation (n-1) across columns, NULLs skipped; NULL below two values."""
    present = F.array_compact(F.array(*[col(c).cast("double") for c in cols]))
    mean = row_mean(cols)
    squares = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(F.size(present) > 1, F.sqrt(squares / (F.size(present) - 1)))
