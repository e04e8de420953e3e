"""Fills, rolling frames, lags, resampling, unit roots, landing and gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.numbers import row_std
from tidemark.operators.fills import bfill, ffill, interpolate_dates, interpolate_steps, resample_month_last, resample_week
from tidemark.operators.ordered import WHOLE, row_index
from tidemark.operators.relate import adf_stat, ccf, coint_stat, df_stat, lag_corr
from tidemark.operators.reshape import pivot_max, weekly_mean
from tidemark.operators.rolling import (
    diff, latest_nonnull_per_key, latest_values, market_features, pct_change, rolling_corr, rolling_mean, rolling_std, rolling_z, shocks,
)
from tidemark.plans.gold import load_weeks, read_gold, weekly_features
from tidemark.plans.models import train_and_serve
from tidemark.plans.landing import credit_outcomes, daily_macro, monthly_macro, sector_daily
from tidemark.schemas import DAILY_SERIES, MONTHLY_SERIES
from tidemark.session import stage
from workload.frames import (
    PRIORITIES, SEGMENTS, cte, daily, daily_staged, dense, dense_staged, prices, prices_staged, r6, raw, raw_staged, scratch, sql_pivot, sql_round2, sql_week,
    table, weekly, wide, wide_staged,
)
from workload.register import query

PAST = "OVER (PARTITION BY series ORDER BY {o} ROWS UNBOUNDED PRECEDING)"
AHEAD = "OVER (PARTITION BY series ORDER BY {o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _near(o="date"):
    past, ahead = PAST.format(o=o), AHEAD.format(o=o)
    return (
        f"last_value(value IGNORE NULLS) {past} AS pv, first_value(value IGNORE NULLS) {ahead} AS nv, "
        f"last_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) {past} AS pd, "
        f"first_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) {ahead} AS nd"
    )


@query("w01_ffill", cte("dense") + f"SELECT series, date, last_value(value IGNORE NULLS) {PAST.format(o='date')} AS value FROM dense")
def forward(spark, sf):
    return ffill(dense_staged(spark, sf), "date", "value", "series")


@query("w01_ffill_whole", cte("dense") + f"SELECT series, date, last_value(value IGNORE NULLS) {PAST.format(o='date')} AS value FROM dense")
def forward_whole(spark, sf):
    """The same with one window per series, for many short series."""
    return ffill(dense_staged(spark, sf), "date", "value", "series", segment=WHOLE)


@query("w02_bfill", cte("dense") + f"SELECT series, date, first_value(value IGNORE NULLS) {AHEAD.format(o='date')} AS value FROM dense")
def backward(spark, sf):
    return bfill(dense_staged(spark, sf), "date", "value", "series")


_LINE = "pv + (nv - pv) * (CAST(date - pd AS DOUBLE) / NULLIF(nd - pd, 0))"


@query(
    "w03_interpolate_carry",
    cte("dense") + f", n AS (SELECT *, {_near()} FROM dense) SELECT series, date, COALESCE(value, {_LINE}, pv, nv) AS value FROM n",
)
def interpolate(spark, sf):
    return interpolate_dates(dense_staged(spark, sf), "date", "value", "series")


@query(
    "w04_interpolate_inner",
    cte("dense") + f", n AS (SELECT *, {_near()} FROM dense) SELECT series, date, {sql_round2(f'COALESCE(value, {_LINE})')} AS value FROM n",
)
def interpolate_inner(spark, sf):
    return interpolate_dates(dense_staged(spark, sf), "date", "value", "series", edges="null").withColumn("value", F.round("value", 2))


_STEPS = """, g AS (SELECT *, COUNT({c}) OVER (PARTITION BY series ORDER BY year, week ROWS UNBOUNDED PRECEDING) AS grp,
    last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY year, week ROWS UNBOUNDED PRECEDING) AS pv,
    first_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY year, week ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM weekly),
    h AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series, grp ORDER BY year, week) - 1 AS pos, COUNT(*) OVER (PARTITION BY series, grp) AS total FROM g) """


@query(
    "w05_interpolate_steps",
    cte("weekly") + _STEPS.format(c="sparse")
    + "SELECT series, year, week, ROUND(value, 6) AS value, ROUND(COALESCE(sparse, CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * pos / total END), 6) AS sparse FROM h",
)
def steps(spark, sf):
    return r6(interpolate_steps(stage(weekly(spark, sf)), ["year", "week"], "sparse", "series"), "value", "sparse")


def _rolled(n: int, value: str, digits: int = 6) -> str:
    f = f"OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN COUNT(value) {f} >= {{need}} THEN ROUND({value.format(f=f)}, {digits}) END"


@query("w08_rolling_mean", cte("dense") + f"SELECT series, date, {_rolled(12, 'AVG(value) {f}').format(need=12)} AS value_mean FROM dense")
def roll_mean(spark, sf):
    return r6(rolling_mean(dense_staged(spark, sf), "date", "value", 12, "series"), "value_mean").drop("value")


@query("w09_rolling_mean_min1", cte("dense") + f"SELECT series, date, {_rolled(3, 'AVG(value) {f}').format(need=1)} AS value_mean FROM dense")
def roll_mean_1(spark, sf):
    return r6(rolling_mean(dense_staged(spark, sf), "date", "value", 3, "series", min_periods=1), "value_mean").drop("value")


@query("w10_rolling_std", cte("daily") + f"SELECT series, date, {_rolled(52, 'stddev_samp(value) {f}', 3).format(need=52)} AS value_std FROM daily")
def roll_std(spark, sf):
    return r6(rolling_std(daily_staged(spark, sf), "date", "value", 52, "series"), "value_std", digits=3).drop("value")


_Z = "(value - AVG(value) {f}) / NULLIF(stddev_samp(value) {f}, 0)"


@query("w11_rolling_z", cte("daily") + f"SELECT series, date, COALESCE({_rolled(30, _Z).format(need=30)}, 0.0) AS value_zscore FROM daily")
def roll_z(spark, sf):
    return r6(rolling_z(daily_staged(spark, sf), "date", "value", 30, "series"), "value_zscore").drop("value")


_F104 = "OVER (ORDER BY date ROWS BETWEEN 103 PRECEDING AND CURRENT ROW)"
_FILLED = ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {c}" for c in ("urgent", "high"))


@query(
    "w12_rolling_corr",
    cte("wide")
    + f", f AS (SELECT date, {_FILLED} FROM wide) SELECT date, CASE WHEN COUNT(CASE WHEN urgent IS NOT NULL AND high IS NOT NULL THEN 1 END) {_F104} >= 104 "
    + f"THEN ROUND(corr(urgent, high) {_F104}, 6) END AS corr FROM f",
)
def roll_corr(spark, sf):
    filled = stage(ffill(wide_staged(spark, sf).select("date", "urgent", "high"), "date", ["urgent", "high"]))
    return r6(rolling_corr(filled, "date", "urgent", "high", 104), "corr").select("date", "corr")


_DIFF = cte("daily") + ", m AS (SELECT *, value - LAG(value) OVER (PARTITION BY series ORDER BY date) AS d FROM daily) "


@query("w13_diff", _DIFF + "SELECT series, date, value, d AS value_diff FROM m")
def difference(spark, sf):
    return diff(daily_staged(spark, sf), "date", "value", "series")


@query(
    "w14_shocks",
    _DIFF + "SELECT series, date, d AS change FROM (SELECT *, stddev_samp(d) OVER (PARTITION BY series) AS s FROM m) WHERE abs(d) > 2 * s",
)
def shock_rows(spark, sf):
    return shocks(daily_staged(spark, sf), "date", "value", 2.0, "series").select("series", "date", "change")


@query(
    "w15_pct_change",
    cte("daily") + "SELECT series, date, value, ROUND((value / NULLIF(LAG(value) OVER (PARTITION BY series ORDER BY date), 0) - 1) * 100, 6) AS value_pct FROM daily",
)
def growth(spark, sf):
    return r6(pct_change(daily_staged(spark, sf), "date", "value", "series", scale=100.0), "value_pct")


_LAGS = (0, 3, 6, 9, 12)


@query(
    "w16_lag_corr",
    cte("wide")
    + ", l AS (SELECT *, "
    + ", ".join(f"LAG({x}, {k}) OVER (ORDER BY date) AS {x}_{k}" for x in ("urgent", "high") for k in _LAGS)
    + " FROM wide) "
    + " UNION ALL ".join(f"SELECT '{x}' AS x, CAST({k} AS INTEGER) AS lag, ROUND(corr({x}_{k}, low), 8) AS r FROM l" for x in ("urgent", "high") for k in _LAGS),
)
def lags(spark, sf):
    return r6(lag_corr(wide_staged(spark, sf), "date", ["urgent", "high"], "low", _LAGS), "r", digits=8)


_BOTH = cte("wide") + ", b AS (SELECT date, urgent, low FROM wide WHERE urgent IS NOT NULL AND low IS NOT NULL), s AS (SELECT AVG(urgent) AS mx, AVG(low) AS my, stddev_pop(urgent) AS sx, stddev_pop(low) AS sy, COUNT(*) AS n FROM b), c AS (SELECT date, urgent - mx AS x, low - my AS y, sx, sy, n FROM b, s) "


@query(
    "w17_ccf",
    _BOTH
    + " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS lag, ROUND(SUM(x * p) / (MAX(n) - {k}) / (MAX(sx) * MAX(sy)), 8) AS r FROM (SELECT *, LAG(y, {k}) OVER (ORDER BY date) AS p FROM c)"
        for k in range(13)
    ),
)
def cross_correlation(spark, sf):
    return r6(ccf(wide_staged(spark, sf), "date", "urgent", "low", 12), "r", digits=8)


@query(
    "w20_latest_values",
    cte("wide") + "SELECT COALESCE(arg_max_null(urgent, date), 0.0) AS urgent, COALESCE(arg_max_null(low, date), 0.0) AS low FROM wide",
)
def latest_value(spark, sf):
    return latest_values(wide(spark, sf), "date", ["urgent", "low"])


@query(
    "w21_latest_nonnull",
    cte("wide") + "SELECT CAST(year(date) AS INTEGER) AS year, arg_max(urgent, date) AS urgent, arg_max(low, date) AS low FROM wide GROUP BY 1",
)
def latest_nonnull(spark, sf):
    return latest_nonnull_per_key(wide(spark, sf).withColumn("year", F.year("date")), "year", "date", ["urgent", "low"])


@query("w22_row_index", cte("daily") + "SELECT series, date, value, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) - 1 AS rn FROM daily")
def numbered(spark, sf):
    return row_index(daily_staged(spark, sf), "date", "series")


@query(
    "w22_row_index_table",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders",
)
def numbered_table(spark, sf):
    return row_index(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "w23_row_std",
    cte("wide") + "SELECT date, ROUND((SELECT stddev_samp(v) FROM UNNEST([urgent, high, medium, unspecified, low]) t(v)), 6) AS spread FROM wide",
)
def spread(spark, sf):
    return wide(spark, sf).select("date", F.round(row_std(list(PRIORITIES.values())), 6).alias("spread"))


def _w(n):
    return f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_LAGGED = "close_price / LAG(close_price, {}) OVER (PARTITION BY ticker ORDER BY date) - 1"


@query(
    "w24_market_features",
    cte("prices")
    + f", a AS (SELECT *, {_LAGGED.format(1)} AS r1, {_LAGGED.format(5)} AS r5, {_LAGGED.format(21)} AS r21, {_LAGGED.format(20)} AS m20, "
    f"close_price / MAX(close_price) {_w(20)} - 1 AS down FROM prices) SELECT ticker, date, ROUND(r1, 6) AS return_1d, ROUND(r5, 6) AS return_1w, "
    f"ROUND(r21, 6) AS return_1m, ROUND(m20, 6) AS momentum_4w, CASE WHEN COUNT(r1) {_w(5)} >= 5 THEN ROUND(stddev_samp(r1) {_w(5)}, 6) END AS volatility_1w, "
    f"CASE WHEN COUNT(r1) {_w(21)} >= 21 THEN ROUND(stddev_samp(r1) {_w(21)}, 6) END AS volatility_1m, ROUND(MIN(down) {_w(20)}, 6) AS drawdown_max_4w FROM a",
)
def features(spark, sf):
    made = ["return_1d", "return_1w", "return_1m", "momentum_4w", "volatility_1w", "volatility_1m", "drawdown_max_4w"]
    return r6(market_features(prices_staged(spark, sf)), *made).select("ticker", "date", *made)


@query(
    "t02_resample_week",
    cte("daily")
    + """, w AS (SELECT series, CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE) AS date, AVG(value) AS value FROM daily GROUP BY 1, 2),
    e AS (SELECT series, MIN(date) AS a, MAX(date) AS b FROM w GROUP BY 1),
    s AS (SELECT series, CAST(UNNEST(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS date FROM e),
    j AS (SELECT s.series, s.date, w.value FROM s LEFT JOIN w ON w.series = s.series AND w.date = s.date) """
    + f"SELECT series, date, ROUND(COALESCE(last_value(value IGNORE NULLS) {PAST.format(o='date')}, first_value(value IGNORE NULLS) {AHEAD.format(o='date')}), 6) AS value FROM j",
)
def week_sampled(spark, sf):
    return r6(resample_week(daily_staged(spark, sf), "date", "value", "series"), "value")


@query(
    "t03_resample_month_last",
    cte("dense") + "SELECT series, last_day(date) AS date, arg_max(value, date) AS value FROM dense GROUP BY 1, 2",
)
def month_sampled(spark, sf):
    return resample_month_last(dense(spark, sf), "date", "value", "series")


_DF = """, q AS (SELECT {k} regr_count(dy, p) AS n, regr_sxx(dy, p) AS sxx, regr_syy(dy, p) AS syy, regr_sxy(dy, p) AS sxy FROM l {g}),
    b AS (SELECT *, sxy / sxx AS slope FROM q)
    SELECT {k} CAST(n AS BIGINT) AS n_obs, ROUND(slope, 8) AS slope, ROUND(slope / sqrt((syy - slope * sxy) / (n - 2) / sxx), 6) AS df_t FROM b"""


@query(
    "t04_dickey_fuller",
    cte("daily")
    + ", l0 AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p FROM daily), l AS (SELECT *, value - p AS dy FROM l0)"
    + _DF.format(k="series,", g="GROUP BY series"),
)
def unit_root(spark, sf):
    return r6(r6(df_stat(daily_staged(spark, sf), "date", "value", "series"), "slope", digits=8), "df_t")


_ADF = """, l0 AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p FROM daily), l1 AS (SELECT *, value - p AS dy FROM l0),
    l AS (SELECT *, LAG(dy) OVER (PARTITION BY series ORDER BY date) AS d1 FROM l1),
    m AS (SELECT series, 0 AS lags, regr_count(dy, p) AS n, regr_slope(dy, p) AS slope, regr_syy(dy, p) - regr_slope(dy, p) * regr_sxy(dy, p) AS rss, regr_sxx(dy, p) AS sxx FROM l GROUP BY 1),
    z AS (SELECT series, regr_count(dy, p) AS n, regr_syy(dy, p) - regr_slope(dy, p) * regr_sxy(dy, p) AS rss FROM l WHERE d1 IS NOT NULL GROUP BY 1),
    c AS (SELECT series, COUNT(*) AS n, var_pop(p) AS pp, var_pop(d1) AS dd, covar_pop(p, d1) AS pd, covar_pop(p, dy) AS py, covar_pop(d1, dy) AS dyy, var_pop(dy) AS yy FROM l WHERE d1 IS NOT NULL GROUP BY 1),
    k AS (SELECT *, pp * dd - pd * pd AS det FROM c),
    o AS (SELECT series, n, (py * dd - dyy * pd) / det AS slope, n * (yy - (py * dd - dyy * pd) / det * py - (dyy * pp - py * pd) / det * dyy) AS rss, det / dd * n AS sxx FROM k),
    a AS (SELECT m.series, 0 AS lags, m.n, m.slope, m.rss, m.sxx, 2 AS k, z.n * ln(z.rss / z.n) + 2.0 * 2 AS score FROM m JOIN z USING (series)
        UNION ALL SELECT series, 1, n, slope, rss, sxx, 3, n * ln(rss / n) + 2.0 * 3 FROM o)
    SELECT series, CAST(lags AS INTEGER) AS lags, CAST(n AS BIGINT) AS n_obs, ROUND(slope, 8) AS slope, ROUND(slope / sqrt(rss / (n - k) / sxx), 6) AS adf_t FROM a QUALIFY ROW_NUMBER() OVER (PARTITION BY series ORDER BY score, lags) = 1"""


@query("t04_adf_lags", cte("daily") + _ADF)
def unit_root_lags(spark, sf):
    """Unit-root statistic with the number of lagged changes that the information criterion picks, none or one."""
    return r6(r6(adf_stat(daily_staged(spark, sf), "date", "value", 1, "series"), "slope", digits=8), "adf_t")


@query(
    "t05_cointegration",
    cte("wide")
    + """, r AS (SELECT date, urgent - (SELECT regr_intercept(urgent, low) FROM wide) - (SELECT regr_slope(urgent, low) FROM wide) * low AS v FROM wide),
    l0 AS (SELECT *, LAG(v) OVER (ORDER BY date) AS p FROM r), l AS (SELECT *, v - p AS dy FROM l0)"""
    + _DF.format(k="", g=""),
)
def cointegration(spark, sf):
    return r6(r6(coint_stat(wide_staged(spark, sf), "date", "urgent", "low"), "slope", digits=8), "df_t")


# --- Landing and gold -----------------------------------------------------------------------------

_MONTHLY_WIDE = ", ".join(f"{sql_round2(f'''MAX(CASE WHEN series = '{k}' THEN value END)''')} AS {v}" for k, v in MONTHLY_SERIES.items())
_M_REST = ", ".join(c for c in MONTHLY_SERIES.values() if c != "realgdp")
_U = "OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)"
_A = "OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _neighbour(c):
    return (
        f"last_value({c} IGNORE NULLS) {_U} AS {c}_pv, first_value({c} IGNORE NULLS) {_A} AS {c}_nv, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN date END IGNORE NULLS) {_U} AS {c}_pd, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN date END IGNORE NULLS) {_A} AS {c}_nd"
    )


def _line(c):
    return f"{c}_pv + ({c}_nv - {c}_pv) * (CAST(date - {c}_pd AS DOUBLE) / NULLIF({c}_nd - {c}_pd, 0))"


_MONTHLY = (
    f", mw AS (SELECT date, {_MONTHLY_WIDE} FROM raw WHERE series IN ({', '.join(repr(k) for k in MONTHLY_SERIES)}) AND value IS NOT NULL "
    f"AND date >= DATE '1980-01-01' GROUP BY date), mn AS (SELECT *, {_neighbour('realgdp')} FROM mw), "
    f"macro_m AS (SELECT date, {_M_REST}, {sql_round2(f'''COALESCE(realgdp, {_line('realgdp')})''')} AS realgdp FROM mn) "
)


@query("landing_monthly_macro", cte("raw") + _MONTHLY + "SELECT * FROM macro_m")
def macro_monthly(spark, sf):
    return monthly_macro(raw(spark, sf))


@query(
    "landing_monthly_macro_full",
    cte("raw") + _MONTHLY
    + ", mf AS (SELECT date, " + ", ".join(list(MONTHLY_SERIES.values()) + [_neighbour(c) for c in MONTHLY_SERIES.values()]) + " FROM mw) "
    + "SELECT date, " + ", ".join(f"{sql_round2(f'COALESCE({c}, {_line(c)}, {c}_pv, {c}_nv)')} AS {c}" for c in MONTHLY_SERIES.values()) + " FROM mf",
)
def macro_monthly_full(spark, sf):
    return monthly_macro(raw(spark, sf), mode="full")


_DAILY = (
    f", dr AS (SELECT series, date, value FROM raw WHERE series IN ({', '.join(repr(k) for k in DAILY_SERIES)}) "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY series, date ORDER BY ingest_timestamp DESC, value) = 1), "
    "dc AS (SELECT CAST(UNNEST(generate_series(TIMESTAMP '1980-01-01', CAST((SELECT MAX(date) FROM dr) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date), "
    "dw AS (SELECT dc.date, " + sql_pivot(DAILY_SERIES) + " FROM dc LEFT JOIN dr ON dr.date = dc.date GROUP BY dc.date), "
    "dn AS (SELECT date, " + ", ".join(list(DAILY_SERIES.values()) + [_neighbour(c) for c in DAILY_SERIES.values()]) + " FROM dw), "
    "macro_d AS (SELECT date, " + ", ".join(f"{sql_round2(f'COALESCE({c}, {_line(c)}, {c}_pv, {c}_nv)')} AS {c}" for c in DAILY_SERIES.values()) + " FROM dn) "
)


@query("landing_daily_macro", cte("raw") + _DAILY + "SELECT * FROM macro_d")
def macro_daily(spark, sf):
    return daily_macro(raw(spark, sf))


@query(
    "t01_calendar",
    cte("raw") + _DAILY + "SELECT date FROM dc",
)
def calendar(spark, sf):
    return daily_macro(raw(spark, sf)).select("date")


_SECTOR = "SELECT date, " + ", ".join(
    f"{sql_round2(f'''MAX(CASE WHEN ticker = '{k}' THEN close_price END)''')} AS {v}_price, MAX(CASE WHEN ticker = '{k}' THEN volume END) AS {v}_vol"
    for k, v in SEGMENTS.items()
) + " FROM prices GROUP BY date"


@query("landing_sector_daily", cte("prices") + _SECTOR)
def sector(spark, sf):
    return sector_daily(prices(spark, sf), SEGMENTS)


_FF = ["fedfundrate", "unemployrate", "recessionindicator"]
_ST = ["cpiurban", "ownedconsumercredit", "realgdp", "delinq"]
_SEC = [f"{v}_{p}" for v in SEGMENTS.values() for p in ("price", "vol")]


def _week_mean(source, cols):
    return f"SELECT CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week, " + ", ".join(f"AVG({c}) AS {c}" for c in cols) + f" FROM {source} GROUP BY 1, 2"


_O = "OVER (ORDER BY year, week ROWS UNBOUNDED PRECEDING)"
_OA = "OVER (ORDER BY year, week ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_GOLD = (
    _MONTHLY + _DAILY
    + f", sec AS ({_SECTOR}), crd AS (SELECT date, {sql_round2('AVG(value)')} AS delinq FROM raw WHERE series = 'DRCCLACBS' GROUP BY 1), "
    + f"wd AS ({_week_mean('macro_d', DAILY_SERIES.values())}), wm AS ({_week_mean('macro_m', MONTHLY_SERIES.values())}), "
    + f"ws AS ({_week_mean('sec', _SEC)}), wc AS ({_week_mean('crd', ['delinq'])}), "
    + "cb AS (SELECT * FROM wd LEFT JOIN wm USING (year, week) LEFT JOIN ws USING (year, week) LEFT JOIN wc USING (year, week)), "
    + "cg AS (SELECT *, "
    + ", ".join(f"COUNT({c}) {_O} AS {c}_g, last_value({c} IGNORE NULLS) {_O} AS {c}_p, first_value({c} IGNORE NULLS) {_OA} AS {c}_n" for c in _ST)
    + ", " + ", ".join(f"last_value({c} IGNORE NULLS) {_O} AS {c}_f" for c in _FF)
    + " FROM cb), cp AS (SELECT *, "
    + ", ".join(f"ROW_NUMBER() OVER (PARTITION BY {c}_g ORDER BY year, week) - 1 AS {c}_i, COUNT(*) OVER (PARTITION BY {c}_g) AS {c}_t" for c in _ST)
    + " FROM cg), gold AS (SELECT year, week, "
    + ", ".join(f"ROUND({c}, 6) AS {c}" for c in [*DAILY_SERIES.values(), *_SEC]) + ", "
    + ", ".join(f"ROUND({c}_f, 6) AS {c}" for c in _FF) + ", "
    + ", ".join(f"ROUND(COALESCE({c}, CASE WHEN {c}_n IS NULL THEN {c}_p ELSE {c}_p + ({c}_n - {c}_p) * {c}_i / {c}_t END), 6) AS {c}" for c in _ST)
    + " FROM cp WHERE week NOT IN (0, 53) AND year >= 1999) "
)


def gold(spark, sf):
    r = raw_staged(spark, sf)
    landing = (daily_macro(r), monthly_macro(r), sector_daily(prices(spark, sf), SEGMENTS), credit_outcomes(r))
    return weekly_features(*landing)


@query("gold_weekly_features", cte("raw", "prices") + _GOLD + "SELECT * FROM gold")
def gold_rounded(spark, sf):
    g = gold(spark, sf)
    return r6(g, *[c for c in g.columns if c not in ("year", "week")])


@query("gold_weekly_loads", cte("raw", "prices") + _GOLD + "SELECT * FROM gold")
def gold_loads(spark, sf):
    """The gold table after three loads by time, the second of which is run twice: that of one build."""
    r = raw_staged(spark, sf)
    landing = [stage(f, "landing") for f in (daily_macro(r), monthly_macro(r), sector_daily(prices(spark, sf), SEGMENTS), credit_outcomes(r))]
    columns = [c for f in landing for c in f.columns if c not in ("date", "load_timestamp")]
    root = scratch(spark, "gold")
    cuts = [dt.date(1998, 3, 11), dt.date(2000, 7, 2), dt.date(9999, 1, 1)]
    for first, last in ((None, cuts[0]), (cuts[0], cuts[1]), (cuts[0], cuts[1]), (cuts[1], cuts[2])):
        load_weeks(*[f.filter(F.col("date") < F.lit(last)) for f in landing], root, first)
    out = read_gold(spark, root, columns)
    return r6(out, *[c for c in out.columns if c not in ("year", "week")])


@query(
    "gold_train_serve",
    cte("raw", "prices") + _GOLD
    + """, r AS (SELECT year, week, COALESCE(unemployrate, 0) AS x, COALESCE(delinq, 0) AS y, delinq, ROW_NUMBER() OVER (ORDER BY year, week) AS rn, COUNT(*) OVER () AS total FROM gold),
    f AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM r WHERE rn <= total - 100),
    p AS (SELECT *, a + b * x AS yhat FROM r, f WHERE rn > total - 100)
    SELECT year, week, printf('%04d-W%02d', year, week) AS label, rn, ROUND(yhat, 4) AS prediction, ROUND(yhat - delinq, 4) AS error, ROUND(abs(yhat - delinq), 4) AS abs_error FROM p""",
)
def serve(spark, sf):
    """A linear fit on the early weeks of the gold table, served on its last hundred."""
    g = gold_rounded(spark, sf)
    out = train_and_serve(g, "delinq", ["unemployrate"])
    return r6(out, "prediction", "error", "abs_error", digits=4).select("year", "week", "label", "rn", "prediction", "error", "abs_error")


@query(
    "slice_weekly_pivot",
    cte("dense")
    + f", n AS (SELECT *, {_near()} FROM dense), i AS (SELECT series, date, COALESCE(value, {_LINE}, pv, nv) AS value FROM n), "
    + f"w AS (SELECT series, CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week, ROUND(AVG(value), 6) AS value FROM i GROUP BY 1, 2, 3) "
    + f"SELECT year, week, {sql_pivot(PRIORITIES)} FROM w GROUP BY year, week",
)
def weekly_slice(spark, sf):
    """Calendar, interpolation, weekly mean and pivot in one plan."""
    filled = interpolate_dates(dense_staged(spark, sf), "date", "value", "series")
    means = r6(weekly_mean(filled, "date", "value", "series"), "value")
    return pivot_max(means, ["year", "week"], "series", PRIORITIES, "value")
