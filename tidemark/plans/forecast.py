"""Forecasts of many steps: autoregressions with given drivers, fitted per key and carried forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.linear import co_moments, fitted, least_squares
from tidemark.operators.ordered import attach, names, over_rows, row_index
from tidemark.operators.rolling import first_per_key, time_split
from tidemark.session import stage

LAGS = (1, 2, 3)


def fit_ar(df: DataFrame, order, y: str, drivers=(), p: int = 1, e=(), segment=None) -> DataFrame:
    """Per key the regression of ``y`` on its ``p`` values before and on the drivers of the same row: intercept, coefs (lags from
    the nearest, then drivers), rss, errors, n, and tail, the last p values, latest first.

    One aggregate of co-moments and one elimination per key inside a row; all keys are fitted at once, and no key is gathered.
    Rows without p values before them, or with a NULL among what they need, do not count. Where the rows cannot tell
    the coefficients apart they are NULL. A key whose last p values hold a NULL has no forecast.
    """
    keys, drivers, k = names(e), names(drivers), p + len(names(drivers))
    slim = df.select(*keys, *names(order), F.col(y).cast("double").alias(y), *[F.col(d).cast("double").alias(d) for d in drivers])
    lags = [f"__lag_{i}" for i in range(1, p + 1)]
    moved = over_rows(slim, order, lambda w: {f"__lag_{i}": F.lag(y, i).over(w) for i in range(1, p + 1)} | {"__next": F.lead(F.lit(1)).over(w)}, e,
                      before=p, after=1, segment=segment)
    whole = F.array_size(F.array_compact(F.array(y, *lags, *drivers))) == k + 1
    known = lambda c: F.when(whole, F.col(c))
    last = F.array(y, *lags[:-1])
    sums = moved.groupBy(*keys).agg(
        *[c.alias(n) for n, c in co_moments([known(c) for c in [*lags, *drivers]], known(y)).items()],
        F.max(F.when(F.col("__next").isNull(), last)).alias("tail"))
    solved = sums.withColumns(least_squares(k))
    told = fitted(k)
    return solved.select(*keys, *[c.alias(n) for n, c in told.items()], F.col("__n").alias("n"), F.lit(p).alias("p"), "tail")


def forecast(params: DataFrame, ahead: DataFrame, order, drivers=(), e=()) -> DataFrame:
    """The rows of ``ahead`` with step (from 1) and forecast: each key's regression carried on over its own forecasts, with the
    drivers that the rows give.

    The recursion is one expression over a key's rows ahead, whose number is the horizon, and an array of the last values as its
    state. A NULL driver ends the forecasts of its key there; a key without parameters or with too few known values has none.
    """
    keys, drivers, order = names(e), names(drivers), names(order)
    numbered = row_index(ahead.select(*keys, *order, *[F.col(d).cast("double").alias(d) for d in drivers]), order, keys, "step")
    given = F.array_sort(F.collect_list(F.struct("step", *order, F.array(*drivers).cast("array<double>").alias("x"))))
    paths = attach(numbered.groupBy(*keys).agg(given.alias("given")), params.select(*keys, "intercept", "coefs", "tail", "p"), keys)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    p = F.col("p")

    def carry(past, row):
        """``past`` holds the values so far, latest first."""
        value = F.col("intercept") + dot(F.slice(F.col("coefs"), 1, p), F.slice(past, 1, p))
        return F.concat(F.array(value + (dot(F.slice(F.col("coefs"), p + 1, F.lit(len(drivers))), row["x"]) if drivers else F.lit(0.0))), past)

    path = F.reverse(F.aggregate(F.col("given"), F.col("tail"), carry))
    row = F.transform(F.col("given"), lambda r, i: F.struct(r["step"].alias("step"), *[r[o].alias(o) for o in order], F.get(F.col("path"), i + p).alias("forecast")))
    return paths.withColumn("path", path).select(*keys, F.inline(row)).withColumn("step", (F.col("step") + 1).cast("int"))


def search_ar(df: DataFrame, order, y: str, drivers=(), ps: Sequence[int] = LAGS, holdout: int = 100, e=(), segment=None) -> DataFrame:
    """Per key the number of lags whose forecast over the last ``holdout`` rows has the lowest mean absolute error, the fewest
    of equal ones: keys, p, mae, and the parameters. All numbers of lags are fitted on one staged frame."""
    keys = names(e)
    split = stage(time_split(df.select(*keys, *names(order), y, *names(drivers)), order, holdout, e, segment).drop("rn"), "ar-split")
    train, test = split.filter("split = 'train'").drop("split"), split.filter("split = 'test'").drop("split")
    tried = None
    for p in ps:
        params = stage(fit_ar(train, order, y, drivers, p, e, segment), "ar-params")
        ahead = row_index(test, order, keys, "step").withColumn("step", (F.col("step") + 1).cast("int"))
        told = forecast(params, test, order, drivers, e).select(*[F.col(c).alias(f"__{c}") for c in keys], F.col("step").alias("__step"), "forecast")
        match = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys] + [F.col("step") == F.col("__step")]
        errors = ahead.join(told, match).groupBy(*keys).agg(F.avg(F.abs(F.col(y) - F.col("forecast"))).alias("mae"))
        own = attach(params, errors, keys)
        tried = own if tried is None else tried.unionByName(own)
    usable = tried.filter(F.col("mae").isNotNull() & ~F.isnan("mae"))
    return first_per_key(usable, keys, [F.col("mae"), F.col("p")]) if keys else usable.orderBy("mae", "p").limit(1)
