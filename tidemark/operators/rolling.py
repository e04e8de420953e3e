"""Rolling frames, lags, ranks, latest values. Windows go through ``over_rows`` (see ``ordered``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import safe_corr
from tidemark.operators.ordered import attach, names, over_rows, place, row_index


def _frame(w, n: int):
    return w.rowsBetween(-(n - 1), Window.currentRow)


def _full(c: str, w, n: int, min_periods: int, value: Column) -> Column:
    """Value of the frame once it holds enough non-NULL rows."""
    return F.when(F.count(c).over(_frame(w, n)) >= min_periods, value)


def rolling_mean(df, order, cols, n: int, e=(), min_periods: int | None = None, suffix="_mean", segment=None) -> DataFrame:
    need = n if min_periods is None else min_periods
    step = lambda w: {
        f"{c}{suffix}": _full(c, w, n, need, F.avg(c).over(_frame(w, n))) for c in names(cols)
    }
    return over_rows(df, order, step, e, before=n - 1, segment=segment)


def rolling_std(df, order, cols, n: int, e=(), min_periods: int | None = None, suffix="_std", segment=None) -> DataFrame:
    need = n if min_periods is None else min_periods
    step = lambda w: {
        f"{c}{suffix}": _full(c, w, n, need, F.stddev_samp(c).over(_frame(w, n))) for c in names(cols)
    }
    return over_rows(df, order, step, e, before=n - 1, segment=segment)


def rolling_z(df, order, cols, n: int = 30, e=(), suffix="_zscore", segment=None) -> DataFrame:
    """(x - mean) / std over the last n rows; 0 until n values are there and where the std is 0."""

    def step(w):
        out = {}
        for c in names(cols):
            f = _frame(w, n)
            z = F.try_divide(F.col(c) - F.avg(c).over(f), F.stddev_samp(c).over(f))
            out[f"{c}{suffix}"] = F.coalesce(_full(c, w, n, n, z), F.lit(0.0))
        return out

    return over_rows(df, order, step, e, before=n - 1, segment=segment)


def rolling_corr(df, order, a: str, b: str, n: int, e=(), name: str = "corr", segment=None) -> DataFrame:
    def step(w):
        f = _frame(w, n)
        both = F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).over(f)
        return {name: F.when(both >= n, safe_corr(a, b, f))}

    return over_rows(df, order, step, e, before=n - 1, segment=segment)


def diff(df, order, col: str, e=(), name: str | None = None, segment=None) -> DataFrame:
    step = lambda w: {name or f"{col}_diff": F.col(col) - F.lag(col).over(w)}
    return over_rows(df, order, step, e, before=1, segment=segment)


def shocks(df, order, col: str, k: float = 2.0, e=(), segment=None) -> DataFrame:
    """Rows whose change exceeds k standard deviations of all changes of the key."""
    moved = diff(df, order, col, e, "change", segment)
    spread = moved.groupBy(*names(e)).agg(F.stddev_samp("change").alias("change_std"))
    return attach(moved, spread, e).filter(F.abs("change") > k * F.col("change_std"))


def pct_change(df, order, cols, e=(), scale: float = 1.0, suffix="_pct", segment=None) -> DataFrame:
    step = lambda w: {
        f"{c}{suffix}": (F.try_divide(F.col(c), F.lag(c).over(w)) - 1) * scale for c in names(cols)
    }
    return over_rows(df, order, step, e, before=1, segment=segment)


def with_lags(df, order, cols, lags, e=(), segment=None) -> DataFrame:
    """Columns ``c__lag_k`` for each column and lag."""
    step = lambda w: {f"{c}__lag_{k}": F.lag(c, k).over(w) for c in names(cols) for k in lags}
    return over_rows(df, order, step, e, before=max(lags), segment=segment)


def time_split(df, order, holdout: int = 100, e=(), segment=None) -> DataFrame:
    """Adds rn (1-based) and split: the last ``holdout`` rows of a key are 'test', the rest 'train'."""
    numbered = row_index(df, order, e, "rn", segment).withColumn("rn", F.col("rn") + 1)
    totals = df.groupBy(*names(e)).agg(F.count(F.lit(1)).alias("total_rows"))
    test = F.col("rn") > F.col("total_rows") - holdout
    return attach(numbered, totals, e).withColumn("split", F.when(test, "test").otherwise("train")).drop("total_rows")


def top_n(df, order, n: int) -> DataFrame:
    """First n rows of the table in an order of columns."""
    return df.orderBy(*order).limit(n)


def top_n_per_key(df, key, order, n: int) -> DataFrame:
    """First n rows per key. Each input partition keeps at most n rows of a key before the shuffle."""
    w = Window.partitionBy(*names(key)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


def last_n(df, order, n: int, e=()) -> DataFrame:
    backwards = [F.col(o).desc() for o in names(order)]
    return top_n_per_key(df, e, backwards, n) if names(e) else top_n(df, backwards, n)


def first_per_key(df, key, order) -> DataFrame:
    """One row per key, the first in a total order."""
    return top_n_per_key(df, key, order, 1)


def latest_per_key(df, key, order: str, ties=()) -> DataFrame:
    """The row with the latest ``order`` per key, ties broken by further columns, ascending."""
    return first_per_key(df, key, [F.col(order).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in names(ties)]])


def latest_values(df, order: str, cols, e=(), missing: float = 0.0, ties=()) -> DataFrame:
    """Each column at its key's latest date; ``missing`` where that value is NULL or the table is empty. All columns come from
    one row: of several on that date the last by ``ties``, then in the total order of ``ordered``."""
    latest = place(df, order, ties)
    return df.groupBy(*names(e)).agg(*[F.coalesce(F.max_by(c, latest), F.lit(missing)).alias(c) for c in names(cols)])


def latest_nonnull_per_key(df, key, order: str, cols, ties=()) -> DataFrame:
    """Latest non-NULL value of each column on its own; ties as in ``latest_values``."""
    latest = place(df, order, ties)
    return df.groupBy(*names(key)).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), latest)).alias(c) for c in names(cols)])


def flag_spans(df, order: str, flag: str, e=(), segment=None) -> DataFrame:
    """First and last order value of every run of rows with flag > 0."""
    keys = names(e)
    up = F.coalesce(F.col(flag) > 0, F.lit(False))
    edges = lambda w: {
        "__opens": F.col("__up") & ~F.coalesce(F.lag("__up").over(w), F.lit(False)),
        "__closes": F.col("__up") & ~F.coalesce(F.lead("__up").over(w), F.lit(False)),
    }
    marked = over_rows(df.select(*keys, order, up.alias("__up")), order, edges, keys, 1, 1, segment)
    # Only the two ends of a run are left, so the end of a run is the row itself or the next one.
    ends = marked.filter(F.col("__opens") | F.col("__closes"))
    paired = over_rows(ends, order, lambda w: {"__next": F.lead(order).over(w)}, keys, 0, 1, segment)
    return paired.filter("__opens").select(
        *keys,
        F.col(order).alias("span_start"),
        F.when(F.col("__closes"), F.col(order)).otherwise(F.col("__next")).alias("span_end"),
    )


def market_features(df, e="ticker", date="date", price="close_price", segment=None) -> DataFrame:
    """Returns over 1, 5 and 21 rows, their volatility over 5 and 21 rows, momentum over 20 rows and
    the deepest drawdown of the last 20 rows against the highest price of the 20 rows before each."""
    x = F.col(price)

    def from_price(w):
        past = lambda k: F.try_divide(x, F.lag(price, k).over(w)) - 1
        return {
            "return_1d": past(1),
            "return_1w": past(5),
            "return_1m": past(21),
            "momentum_4w": past(20),
            "__down": F.try_divide(x, F.max(price).over(_frame(w, 20))) - 1,
        }

    def from_returns(w):
        vol = lambda n: _full("return_1d", w, n, n, F.stddev_samp("return_1d").over(_frame(w, n)))
        return {
            "volatility_1w": vol(5),
            "volatility_1m": vol(21),
            "drawdown_max_4w": F.min("__down").over(_frame(w, 20)),
        }

    return over_rows(df, date, [from_price, from_returns], e, before=42, segment=segment).drop("__down")
