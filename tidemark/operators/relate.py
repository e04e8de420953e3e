"""Correlations, market ratios, unit-root and cointegration statistics."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.linear import co_moments, fitted, least_squares
from tidemark.functions.numbers import safe_corr
from tidemark.operators.fills import ffill
from tidemark.operators.ordered import attach, names, over_rows, place
from tidemark.operators.reshape import common_dates, to_long
from tidemark.operators.rolling import first_per_key, pct_change, with_lags
from tidemark.session import stage

TRADING_DAYS = 252


def _pairs(df: DataFrame, pairs, e=()) -> DataFrame:
    """Pearson r of column pairs as rows (a, b, r), all pairs in one aggregate. ``corr`` takes the
    rows where both columns are present."""
    keys = names(e)
    wide = df.groupBy(*keys).agg(*[safe_corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(*keys, F.inline(F.array(*rows)))


#: More pairs than this, without keys, are read off one matrix of sums instead of an aggregate for each.
MANY_PAIRS = 50


def pair_sums(df: DataFrame, cols) -> np.ndarray:
    """Sums over all rows, as a matrix of 3 x 3 blocks of columns: of the products of presence (0 / 1), value and squared value of each
    column with those of each other, NULL counting 0. Values are centred and scaled first, which no correlation feels.

    One pass for mean and deviation, one for the matrix: executors add up packed matrices of rows, and the driver gets
    one of (3 columns)^2 numbers, however many rows there are.
    """
    cols = names(cols)
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    scaled = [(F.col(c).cast("double") - float(stats[f"m_{i}"] or 0.0)) / float(stats[f"s_{i}"] or 1.0) for i, c in enumerate(cols)]
    values = [F.coalesce(z, F.lit(0.0)) for z in scaled]
    parts = [*[F.col(c).isNotNull().cast("double") for c in cols], *values, *[v * v for v in values]]
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*parts)).alias("row")))
    if df.isEmpty():
        return np.zeros((3 * len(cols), 3 * len(cols)))
    return RowMatrix(rows).computeGramianMatrix().toArray()


def _from_sums(sums: np.ndarray, i: int, j: int) -> float | None:
    """Pearson r of columns i and j over the rows that have both. NULL where one of them does not vary there."""
    k = len(sums) // 3
    n, sxy = sums[i, j], sums[k + i, k + j]
    sx, sy, sxx, syy = sums[k + i, j], sums[i, k + j], sums[2 * k + i, j], sums[i, 2 * k + j]
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    if n < 2 or vx <= 1e-12 * n * n or vy <= 1e-12 * n * n:
        return None
    return float(min(1.0, max(-1.0, (n * sxy - sx * sy) / (vx * vy) ** 0.5)))


def _related(df: DataFrame, pairs, e=()) -> DataFrame:
    if names(e) or len(pairs) <= MANY_PAIRS:
        return _pairs(df, pairs, e)
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    sums, at = pair_sums(df, cols), {c: i for i, c in enumerate(cols)}
    return df.sparkSession.createDataFrame([(a, b, _from_sums(sums, at[a], at[b])) for a, b in pairs], "a STRING, b STRING, r DOUBLE")


def corr_matrix(df: DataFrame, cols, e=()) -> DataFrame:
    """Upper triangle of the correlation matrix, pairwise complete. Many columns are read from one matrix of sums (see ``pair_sums``),
    which runs while the plan is built."""
    return _related(df, list(combinations(names(cols), 2)), e)


def cross_corr(df: DataFrame, left, right, e=()) -> DataFrame:
    """Every left column against every right column, as ``corr_matrix``."""
    return _related(df, [(a, b) for a in names(left) for b in names(right)], e)


def lag_corr(df: DataFrame, order, xs, y: str, lags=(0, 3, 6, 9, 12), e=(), segment=None) -> DataFrame:
    """Correlation of x, k rows earlier, with y; rows (x, lag, r)."""
    xs, keys = names(xs), names(e)
    lagged = with_lags(df, order, xs, [k for k in lags if k], e, segment) if any(lags) else df
    col = lambda x, k: f"{x}__lag_{k}" if k else x
    wanted = [(x, k) for x in xs for k in lags]
    wide = lagged.groupBy(*keys).agg(*[safe_corr(col(x, k), y).alias(f"r_{i}") for i, (x, k) in enumerate(wanted)])
    rows = [
        F.struct(F.lit(x).alias("x"), F.lit(k).alias("lag"), F.col(f"r_{i}").alias("r")) for i, (x, k) in enumerate(wanted)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def ccf(df: DataFrame, order, x: str, y: str, max_lag: int = 24, e=(), segment=None) -> DataFrame:
    """Cross-correlation of x, k rows later, with y: sum of centred products / (n - k), over the
    population standard deviations; rows (lag, r) for k = 0..max_lag."""
    keys = names(e)
    whole = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    stats = whole.groupBy(*keys).agg(
        F.avg(x).alias("__mx"), F.avg(y).alias("__my"), F.stddev_pop(x).alias("__sx"), F.stddev_pop(y).alias("__sy"),
        F.count(F.lit(1)).alias("__n"),
    )
    centred = attach(whole, stats, keys).withColumns({"__x": F.col(x) - F.col("__mx"), "__y": F.col(y) - F.col("__my")})
    lagged = with_lags(centred, order, "__y", list(range(1, max_lag + 1)), e, segment)
    back = lambda k: F.col(f"__y__lag_{k}") if k else F.col("__y")
    sums = lagged.groupBy(*keys).agg(
        F.max("__n").alias("__n"), F.max("__sx").alias("__sx"), F.max("__sy").alias("__sy"),
        *[F.sum(F.col("__x") * back(k)).alias(f"s_{k}") for k in range(max_lag + 1)],
    )
    value = lambda k: F.try_divide(
        F.try_divide(F.col(f"s_{k}"), F.col("__n") - k), F.col("__sx") * F.col("__sy")
    )
    rows = [F.struct(F.lit(k).alias("lag"), value(k).alias("r")) for k in range(max_lag + 1)]
    return sums.select(*keys, F.inline(F.array(*rows)))


def total_return(df: DataFrame, e="ticker", date: str = "date", price: str = "close_price", ties=()) -> DataFrame:
    """(last / first - 1) * 100 per key. Of several prices on the first or last date the one decides that comes first or last by
    ``ties``, then in the total order of ``ordered``."""
    present = F.when(F.col(price).isNotNull(), place(df, date, ties))
    growth = F.try_divide(F.max_by(price, present), F.min_by(price, present))
    return df.groupBy(*names(e)).agg(((growth - 1) * 100).alias("total_return"))


def daily_returns(df: DataFrame, e: str = "ticker", date: str = "date", price: str = "close_price", segment=None) -> DataFrame:
    """Return on the row before, on the dates for which every key has one."""
    moved = pct_change(df.select(e, date, price), date, price, e, suffix="_ret", segment=segment)
    returns = moved.withColumnRenamed(f"{price}_ret", "ret").filter(F.col("ret").isNotNull())
    return common_dates(returns, e, date)


def _ratios(rf: float) -> dict[str, Column]:
    year = F.lit(float(TRADING_DAYS))
    return {
        "annual_vol": F.stddev_samp("ret") * F.sqrt(year) * 100,
        "sharpe": F.try_divide(F.avg("ret") * year - rf, F.stddev_samp("ret") * F.sqrt(year)),
    }


def annual_vol(df, e: str = "ticker", date="date", price="close_price", segment=None) -> DataFrame:
    return daily_returns(df, e, date, price, segment).groupBy(e).agg(_ratios(0.0)["annual_vol"].alias("annual_vol"))


def sharpe(df, e: str = "ticker", rf: float = 0.02, date="date", price="close_price", segment=None) -> DataFrame:
    return daily_returns(df, e, date, price, segment).groupBy(e).agg(_ratios(rf)["sharpe"].alias("sharpe"))


def market_ratios(wide: DataFrame, date: str, cols, rf: float = 0.02, segment=None) -> DataFrame:
    """Volatility and Sharpe ratio per price column of a wide table, its inner gaps padded and a date
    dropped for all columns when one of them has no return yet."""
    cols = names(cols)
    moved = pct_change(ffill(wide.select(date, *cols), date, cols, segment=segment), date, cols, suffix="", segment=segment)
    long = to_long(moved.dropna(subset=cols), date, cols, "ticker", "ret")
    return long.groupBy("ticker").agg(*[c.alias(n) for n, c in _ratios(rf).items()])


def df_stat(df: DataFrame, order, col: str, e=(), segment=None) -> DataFrame:
    """Dickey-Fuller t statistic of the regression of the change on the level before, with constant."""
    step = lambda w: {"__lag": F.lag(col).over(w)}
    moved = over_rows(df, order, step, e, before=1, segment=segment).withColumn("__dy", F.col(col) - F.col("__lag"))
    sums = moved.groupBy(*names(e)).agg(
        F.regr_count("__dy", "__lag").alias("n"),
        F.regr_sxx("__dy", "__lag").alias("sxx"),
        F.regr_syy("__dy", "__lag").alias("syy"),
        F.regr_sxy("__dy", "__lag").alias("sxy"),
    )
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    rest = F.try_divide(F.col("syy") - slope * F.col("sxy"), F.col("n") - 2)
    error = F.sqrt(F.try_divide(rest, F.col("sxx")))
    return sums.select(*names(e), F.col("n").alias("n_obs"), slope.alias("slope"), F.try_divide(slope, error).alias("df_t"))


def adf_stat(df: DataFrame, order, col: str, max_lag: int = 4, e=(), criterion: str = "aic", segment=None) -> DataFrame:
    """Augmented Dickey-Fuller t statistic per key: the change on the level before and on up to ``max_lag`` changes before, with constant.

    All numbers of lags are compared by ``criterion`` (aic or bic) on the rows that have all lags, and the best is fitted again on
    the rows it can use: lags, n_obs, slope, adf_t. Fits are solved per key from co-moments in one aggregate for each number of lags and
    each sample; the lagged frame is staged, so the series is ordered once. A key too short, or without change, has NULL.
    """
    keys = names(e)
    step = lambda w: {"__lag": F.lag(col).over(w), "__dy": F.col(col) - F.lag(col).over(w)}
    back = lambda w: {f"__dy_{k}": F.lag("__dy", k).over(w) for k in range(1, max_lag + 1)}
    moved = over_rows(df.select(*keys, *names(order), F.col(col).cast("double").alias(col)), order, [step, back], e, before=max_lag + 1, segment=segment)
    lags = [f"__dy_{k}" for k in range(1, max_lag + 1)]
    slim = stage(moved.select(*keys, "__dy", "__lag", *lags), "adf")
    whole = F.array_size(F.array_compact(F.array("__dy", "__lag", *lags))) == 2 + max_lag
    tried = None
    for p in range(max_lag + 1):
        xs, k = ["__lag", *lags[:p]], p + 1

        def fits(known):
            masked = lambda c: F.when(known, F.col(c))
            sums = slim.groupBy(*keys).agg(*[c.alias(n) for n, c in co_moments([masked(x) for x in xs], masked("__dy")).items()])
            return sums.withColumns(least_squares(k)).select(*keys, F.col("__n").alias("n"), *[c.alias(n) for n, c in fitted(k).items()])

        weight = F.lit(2.0) if criterion == "aic" else F.ln("n")
        score = F.col("n") * F.ln(F.when(F.col("rss") > 0, F.col("rss")) / F.col("n")) + weight * (k + 1)
        own = F.array_size(F.array_compact(F.array("__dy", *xs))) == 1 + k
        told = fits(own).select(*keys, F.lit(p).alias("lags"), F.col("n").alias("n_obs"), F.get("coefs", F.lit(0)).alias("slope"), F.get("errors", F.lit(0)).alias("__error"))
        judged = attach(told, fits(whole).select(*keys, score.alias("__score")), keys)
        tried = judged if tried is None else tried.unionByName(judged)
    tried = tried.withColumn("adf_t", F.try_divide("slope", "__error"))
    order_ = [F.col("__score").asc_nulls_last(), F.col("lags").asc()]
    best = first_per_key(tried, keys, order_) if keys else tried.orderBy(*order_).limit(1)
    return best.drop("__score", "__error")


def coint_stat(df: DataFrame, order, y: str, x: str, e=(), segment=None) -> DataFrame:
    """Dickey-Fuller statistic of the residuals of y regressed on x."""
    line = df.groupBy(*names(e)).agg(F.regr_slope(y, x).alias("__b"), F.regr_intercept(y, x).alias("__a"))
    left = attach(df, line, e).withColumn("__rest", F.col(y) - F.col("__a") - F.col("__b") * F.col(x))
    return df_stat(left, order, "__rest", e, segment)
