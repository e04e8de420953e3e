"""Filters and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import safe_date, trailing_start
from tidemark.functions.text import TRUSTED_DOMAINS
from tidemark.operators.ordered import names


def select_as(df: DataFrame, mapping: dict[str, str | tuple[str, str]]) -> DataFrame:
    """Project and rename; a (column, type) pair also casts."""
    return df.select(
        *[
            (F.col(src) if isinstance(src, str) else F.col(src[0]).cast(src[1])).alias(out)
            for out, src in mapping.items()
        ]
    )


def drop_bad_dates(df: DataFrame, date: str = "date", ticker: str = "ticker") -> DataFrame:
    """Drop rows whose date repeats the ticker or is no date; the date becomes a DATE."""
    repeated = F.upper(F.col(date).cast("string")) == F.upper(ticker)
    return df.filter(~repeated & safe_date(date).isNotNull()).withColumn(date, safe_date(date))


def _as_of(df: DataFrame, date: str, as_of) -> Column:
    if as_of is not None:
        return F.lit(as_of).cast("date")
    return df.agg(F.max(F.col(date).cast("date")).alias("d")).scalar()


def trailing(df: DataFrame, date: str, n: int, unit: str = "day", as_of=None) -> DataFrame:
    """Rows of the last n days, months or years up to ``as_of``, both ends included.

    The default ``as_of`` is the latest date of the table, never the wall clock.
    """
    end = _as_of(df, date, as_of)
    return df.filter(F.col(date).cast("date").between(trailing_start(end, n, unit), end))


def year_week_between(df: DataFrame, start=None, end=None, year: str = "year", week: str = "week") -> DataFrame:
    """Lexicographic range over (year, week), written so that the year bounds reach the file scan."""
    y, w = F.col(year), F.col(week)
    if start is not None:
        df = df.filter((y >= start[0]) & ((y > start[0]) | (w >= start[1])))
    if end is not None:
        df = df.filter((y <= end[0]) & ((y < end[0]) | (w <= end[1])))
    return df


def date_between(df: DataFrame, date: str, start=None, end=None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end).cast("date"))
    return df


def valid_weeks(df: DataFrame, first_year: int = 1999) -> DataFrame:
    """Leave out the partial weeks 0 and 53 and the years before ``first_year``."""
    return df.filter(~F.col("week").isin(0, 53) & (F.col("year") >= first_year))


def fill_features(df: DataFrame, cols, value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=names(cols))


def feature_names(df: DataFrame, without=("delinq", "date", "week", "year", "rn")) -> list[str]:
    return [c for c in df.columns if c not in without]


def news_valid(df: DataFrame, url: str = "url") -> DataFrame:
    return df.filter(F.col(url).isNotNull() & (F.col(url) != ""))


# Crisis windows, first and last day.
PERIODS = {
    "2001-2003": ("2001-03-01", "2003-03-01"),
    "2007-2009": ("2007-12-01", "2009-06-01"),
    "2020-2020": ("2020-02-01", "2020-06-01"),
}


def label_periods(df: DataFrame, date: str = "date", periods: dict[str, tuple[str, str]] = PERIODS) -> DataFrame:
    """Rows inside a named window, one copy per window they fall in."""
    d = F.col(date).cast("date")
    hits = [
        F.when(d.between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(name)) for name, (a, b) in periods.items()
    ]
    return df.withColumn("period", F.explode(F.array_compact(F.array(*hits))))


def trusted_only(df: DataFrame, domain: str = "source_domain", domains=TRUSTED_DOMAINS) -> DataFrame:
    """Rows whose domain is listed or a subdomain of a listed one."""
    known = [F.col(domain) == d for d in domains] + [F.col(domain).endswith("." + d) for d in domains]
    return df.filter(reduce(lambda a, b: a | b, known))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """What a DELETE leaves: rows where the predicate is false or NULL."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
