"""Raw long series and prices -> landing tables.

A table here has one row per key and date, so the calendar bounds a series and its window stays whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.fills import fill, interpolate_dates, on_calendar
from tidemark.operators.ordered import WHOLE, names
from tidemark.operators.reshape import mean_by_date, pivot_many, pivot_max
from tidemark.operators.rolling import first_per_key
from tidemark.session import stage
from tidemark.schemas import CREDIT_SERIES, DAILY_SERIES, MONTHLY_SERIES, SECTORS

FIRST_DAY = "1980-01-01"


def monthly_macro(raw: DataFrame, mode: str = "reference", start: str = FIRST_DAY, e=(), series=MONTHLY_SERIES, gdp="realgdp") -> DataFrame:
    """One row per date with a value, one rounded column per monthly series.

    ``reference`` interpolates the quarterly output series between its own dates and leaves the rest;
    ``full`` interpolates every column and carries the edges.
    """
    keys = names(e)
    rows = raw.filter((F.col("date") >= F.lit(start).cast("date")) & F.col("series").isin(list(series)))
    wide = pivot_max(rows.filter(F.col("value").isNotNull()), [*keys, "date"], "series", series, "value", digits=2)
    rules = {gdp: "dates_inner"} if mode == "reference" else {c: "dates" for c in series.values()}
    return fill(wide, "date", rules, keys, WHOLE).withColumns({c: F.round(c, 2) for c in rules})


def first_per_date(raw: DataFrame, e=()) -> DataFrame:
    """One row per series and date: the latest ingest, then the smallest value."""
    return first_per_key(
        raw, [*names(e), "series", "date"], [F.col("ingest_timestamp").desc_nulls_last(), F.col("value").asc_nulls_last()]
    )


def daily_long(raw: DataFrame, start=FIRST_DAY, end=None, e=(), series=DAILY_SERIES) -> DataFrame:
    """Daily series on a dense calendar, gaps linear in days, edges carried; long form, unrounded."""
    keys = [*names(e), "series"]
    known = raw.filter(F.col("series").isin(list(series)))
    # One row per series and date is small next to the raw rows, and is read twice from here on.
    one = stage(first_per_date(known, e).select(*keys, "date", "value"), "first_per_date")
    return interpolate_dates(on_calendar(one, start, end, keys), "date", "value", keys, segment=WHOLE)


def daily_macro(raw: DataFrame, start=FIRST_DAY, end=None, e=(), series=DAILY_SERIES) -> DataFrame:
    return pivot_max(daily_long(raw, start, end, e, series), [*names(e), "date"], "series", series, "value", digits=2)


def credit_outcomes(raw: DataFrame, series=CREDIT_SERIES) -> DataFrame:
    (column,) = series.values()
    rows = raw.filter(F.col("series").isin(list(series)))
    return mean_by_date(rows).withColumnRenamed("value", column)


def sector_daily(prices: DataFrame, sectors: dict[str, str] = SECTORS, e=(), load_time=None) -> DataFrame:
    """Price and volume column per sector and date, rounded to 2 decimals."""
    out = pivot_many(prices, [*names(e), "date"], "ticker", sectors, {"_price": "close_price", "_vol": "volume"}, 2)
    return out if load_time is None else out.withColumn("load_timestamp", F.lit(load_time).cast("timestamp"))


def macro_long(frames: dict[str, DataFrame]) -> DataFrame:
    """Tables of one series each, stacked into the long form."""
    tagged = [df.withColumn("series", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
