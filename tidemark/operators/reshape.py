"""Pivots, unpivots, alignment of series, calendar joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import month_start, week_u
from tidemark.operators.ordered import names
from tidemark.session import stage


def weekly_mean(df: DataFrame, date: str, cols, e=()) -> DataFrame:
    """Mean per calendar year and Sunday-based week."""
    return df.groupBy(*names(e), F.year(date).alias("year"), week_u(date).alias("week")).agg(
        *[F.avg(c).alias(c) for c in names(cols)]
    )


def pivot_max(df: DataFrame, idx, key: str, columns: dict[str, str], value: str, digits: int | None = None) -> DataFrame:
    """One column per listed key: MAX(value where key matches). Keys not listed are left out, index
    values stay. ``columns`` maps key -> output column."""
    return pivot_many(df, idx, key, columns, {"": value}, digits)


def pivot_many(
    df: DataFrame, idx, key: str, stems: dict[str, str], measures: dict[str, str], digits: int | None = None
) -> DataFrame:
    """``pivot_max`` for several measures: column ``stem`` + suffix per key and measure."""
    idx = names(idx)

    def cell(k, value):
        top = F.max(F.when(F.col(key) == k, F.col(value).cast("double")))
        return top if digits is None else F.round(top, digits)

    return df.groupBy(*idx).agg(
        *[cell(k, value).alias(f"{stem}{suffix}") for k, stem in stems.items() for suffix, value in measures.items()]
    )


def pivot_mean(df: DataFrame, idx, key: str, columns: dict[str, str], value: str, missing: float | None = 0.0) -> DataFrame:
    out = df.groupBy(*names(idx)).agg(*[F.avg(F.when(F.col(key) == k, F.col(value))).alias(c) for k, c in columns.items()])
    return out if missing is None else out.fillna(missing, subset=list(columns.values()))


def to_long(df: DataFrame, ids, cols, name: str = "series", value: str = "value", keep_nulls: bool = False) -> DataFrame:
    """Wide to long; NULL cells are dropped unless asked for."""
    out = df.unpivot(names(ids), names(cols), name, value)
    return out if keep_nulls else out.filter(F.col(value).isNotNull())


def stack_series(frames: dict[str, DataFrame], label: str = "series") -> DataFrame:
    """UNION ALL of frames of one shape, each tagged with its label."""
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn(label, F.lit(k)) for k, df in frames.items()])


def concat(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def outer_align(frames: dict[str, DataFrame], on="date", value: str = "value") -> DataFrame:
    """Full outer alignment of series on a key, one column per series.

    The series are stacked and pivoted: one shuffle for any number of series, and several values of a
    series on one key give their maximum instead of multiplying rows.
    """
    long = stack_series({k: df.select(*names(on), value) for k, df in frames.items()}, "__series")
    return pivot_max(long, on, "__series", {k: k for k in frames}, value)


def weekly_combine(spine: DataFrame, others: list[DataFrame], on=("year", "week")) -> DataFrame:
    """LEFT joins to a spine on year and week."""
    return reduce(lambda a, b: a.join(b, list(on), "left"), others, spine)


def join_by_month(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """Inner join on the calendar month, dated at the month start."""
    left = a.withColumn("month", month_start(date)).drop(date)
    right = b.withColumn("month", month_start(date)).drop(date)
    return left.join(right, "month")


def common_dates(df: DataFrame, key: str, date: str = "date") -> DataFrame:
    """Rows on the dates for which every key has a row."""
    pairs = df.select(date, key).distinct()
    wanted = df.select(key).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    full = pairs.groupBy(date).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == wanted).select(date)
    return df.join(stage(full, "dates"), date, "left_semi")


def distinct_values(df: DataFrame, date: str = "date", value: str = "value") -> DataFrame:
    return df.select(F.col(date).cast("date").alias("date"), F.col(value).alias("value")).distinct()


def max_by_date(df: DataFrame, date: str = "date", value: str = "value") -> DataFrame:
    return df.groupBy(F.col(date).cast("date").alias("date")).agg(F.max(value).alias("value"))


def mean_by_date(df: DataFrame, date: str = "date", value: str = "value", digits: int = 2) -> DataFrame:
    return df.groupBy(F.col(date).cast("date").alias("date")).agg(F.round(F.avg(value), digits).alias(value))
