"""Gap filling, calendars and resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import calendar, week_end
from tidemark.operators.ordered import STEP, names, neighbours, place


def _between(c: str, place: str, distance) -> Column:
    """Linear value between the neighbours; NULL unless both exist apart."""
    prev, nxt = F.col(f"__prev_{c}"), F.col(f"__next_{c}")
    share = F.try_divide(distance(F.col(place), prev[place]), distance(nxt[place], prev[place]))
    return prev["v"] + (nxt["v"] - prev["v"]) * share


def fill_rule(c: str, rule: str, place: str) -> Column:
    """The filled column of a frame of ``neighbours``."""
    value, prev, nxt = F.col(c), F.col(f"__prev_{c}")["v"], F.col(f"__next_{c}")["v"]
    days = lambda end, start: F.datediff(end, start)
    if rule == "ffill":
        return prev
    if rule == "bfill":
        return nxt
    if rule == "both":
        return F.coalesce(prev, nxt)
    if rule == "dates":
        return F.coalesce(value, _between(c, place, days), prev, nxt)
    if rule == "dates_inner":
        return F.coalesce(value, _between(c, place, days))
    if rule == "steps":
        p, n = F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        line = p["v"] + (n["v"] - p["v"]) * (F.col(STEP) - p[STEP]) / (n[STEP] - p[STEP])
        return F.coalesce(value, F.when(nxt.isNull(), prev).otherwise(line))
    raise ValueError(rule)


def fill(df: DataFrame, order, rules: dict[str, str], keys=(), segment=None) -> DataFrame:
    """Fill several columns in one pass. Rules: ``ffill``, ``bfill``, ``both`` (forward, then backward),
    ``dates`` (linear in days, edges carried), ``dates_inner`` (same, edges stay NULL), ``steps``
    (linear in row positions, trailing gap carried, leading gap NULL)."""
    order, cols = names(order), list(rules)
    found = neighbours(df, order, cols, keys, segment, steps="steps" in rules.values())
    return found.select(*[fill_rule(c, rules[c], order[0]).alias(c) if c in rules else F.col(c) for c in df.columns])


def ffill(df, order, cols, e=(), segment=None) -> DataFrame:
    return fill(df, order, {c: "ffill" for c in names(cols)}, e, segment)


def bfill(df, order, cols, e=(), segment=None) -> DataFrame:
    return fill(df, order, {c: "bfill" for c in names(cols)}, e, segment)


def interpolate_dates(df, order, cols, e=(), edges: str = "carry", segment=None) -> DataFrame:
    rule = {"carry": "dates", "null": "dates_inner"}[edges]
    return fill(df, order, {c: rule for c in names(cols)}, e, segment)


def interpolate_steps(df, order, cols, e=(), segment=None) -> DataFrame:
    return fill(df, order, {c: "steps" for c in names(cols)}, e, segment)


def calendar_frame(df: DataFrame, start, end=None, date: str = "date") -> DataFrame:
    """Every day from start to end; the default end is the latest date of the frame."""
    last = df.agg(F.max(date).alias("d")).scalar() if end is None else F.lit(end)
    return df.sparkSession.range(1).select(F.explode(calendar(F.lit(start), last)).alias(date))


def on_calendar(df: DataFrame, start=None, end=None, e=(), date: str = "date") -> DataFrame:
    """Every key on every day from start to end, values NULL where the key has no row.

    Defaults: the first and last date of the whole frame. Rows outside the range are dropped.
    """
    keys = names(e)
    ends = df.groupBy(*keys).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    span = ends.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(F.struct("lo", "hi")).scalar()
    lo = F.lit(start).cast("date") if start is not None else span["lo"]
    hi = F.lit(end).cast("date") if end is not None else span["hi"]
    spine = ends.select(*keys, F.explode(calendar(lo, hi)).alias(date))
    return on_spine(spine, df, [*keys, date])


def on_spine(spine: DataFrame, df: DataFrame, on) -> DataFrame:
    """Left join to a spine that holds each key once; NULL keys match each other."""
    on = names(on)
    rest = [c for c in df.columns if c not in on]
    right = df.select(F.struct(*on).alias("__key"), *rest)
    return spine.withColumn("__key", F.struct(*on)).join(right, "__key", "left").select(*df.columns)


def resample_week(df: DataFrame, date: str, cols, e=(), filled: bool = True) -> DataFrame:
    """Mean per week ending on Sunday, empty weeks kept, then filled forward and backward."""
    keys, cols = names(e), names(cols)
    means = (
        df.withColumn("__week", week_end(F.col(date).cast("date")))
        .groupBy(*keys, "__week").agg(*[F.avg(c).alias(c) for c in cols])
        .select(*keys, F.col("__week").alias(date), *cols)
    )
    ends = means.groupBy(*keys).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    spine = ends.select(*keys, F.explode(calendar("lo", "hi", "INTERVAL 7 DAY")).alias(date))
    out = on_spine(spine, means, [*keys, date])
    return fill(out, date, {c: "both" for c in cols}, keys) if filled else out


def resample_month_last(df: DataFrame, date: str, cols, e=(), ties=()) -> DataFrame:
    """Last non-NULL value of each month, dated at the month's end. Of several on one date the last by ``ties``, then in the total
    order of ``ordered``."""
    keys, latest = names(e), place(df, date, ties)
    return (
        df.groupBy(*keys, F.last_day(date).alias("__month"))
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), latest)).alias(c) for c in names(cols)])
        .withColumnRenamed("__month", date)
    )
