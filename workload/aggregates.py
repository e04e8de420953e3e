"""Aggregations, pivots, profiles, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tidemark.operators.profile import (
    by_theme, common_window, decade_stats, describe_long, frequency_overview, mean_per_key, month_profile, null_profile,
    quality_report, top_values, zscore,
)
from tidemark.operators.relate import annual_vol, corr_matrix, cross_corr, market_ratios, sharpe, total_return
from tidemark.operators.reshape import pivot_many, pivot_mean, to_long, weekly_mean
from tidemark.plans.landing import credit_outcomes
from tidemark.session import stage
from workload.frames import (
    PRIORITIES, SEGMENTS, articles, cte, daily, monthly, orders, prices, prices_staged, r6, raw, sql_round2, sql_week, table, wide,
)
from workload.register import query

COLS = list(PRIORITIES.values())


@query(
    "a01_weekly_mean",
    cte("daily") + f"SELECT series, CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week, ROUND(AVG(value), 6) AS value FROM daily GROUP BY 1, 2, 3",
)
def weekly(spark, sf):
    return r6(weekly_mean(daily(spark, sf), "date", "value", "series"), "value")


@query(
    "a02_pivot_price_volume",
    cte("prices")
    + "SELECT date, "
    + ", ".join(
        f"{sql_round2(f'''MAX(CASE WHEN ticker = '{k}' THEN close_price END)''')} AS {v}_price, MAX(CASE WHEN ticker = '{k}' THEN volume END) AS {v}_vol"
        for k, v in SEGMENTS.items()
    )
    + " FROM prices GROUP BY date",
)
def pivot_prices(spark, sf):
    return pivot_many(prices(spark, sf), "date", "ticker", SEGMENTS, {"_price": "close_price", "_vol": "volume"}, 2)


@query(
    "a05_mean_by_date",
    cte("raw") + f"SELECT date, {sql_round2('AVG(value)')} AS delinq FROM raw WHERE series = 'DRCCLACBS' GROUP BY 1",
)
def mean_date(spark, sf):
    return credit_outcomes(raw(spark, sf))


_UNPIVOT = " UNION ALL ".join(f"SELECT date, '{c}' AS series, {c} AS value FROM wide" for c in COLS)


@query("a07_unpivot", cte("wide") + f"SELECT * FROM ({_UNPIVOT}) WHERE value IS NOT NULL")
def unpivot(spark, sf):
    return to_long(wide(spark, sf), "date", COLS)


@query("a07_unpivot_keep_nulls", cte("wide") + _UNPIVOT)
def unpivot_all(spark, sf):
    return to_long(wide(spark, sf), "date", COLS, keep_nulls=True)


@query(
    "a08_melt_complete",
    cte("wide") + f"SELECT * FROM ({_UNPIVOT} ) WHERE date IN (SELECT date FROM wide WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLS)})",
)
def melt(spark, sf):
    return to_long(wide(spark, sf).dropna(subset=COLS), "date", COLS)


TOPIC_COLS = {"fed": "fed", "Layoffs": "layoffs", "inflation": "inflation", "oil": "oil"}


@query(
    "a09_pivot_mean",
    cte("articles")
    + "SELECT ingest_date, "
    + ", ".join(f"ROUND(COALESCE(AVG(CASE WHEN topic = '{k}' THEN score END), 0.0), 6) AS {v}" for k, v in TOPIC_COLS.items())
    + " FROM articles GROUP BY 1",
)
def pivot_avg(spark, sf):
    return r6(pivot_mean(articles(spark, sf), "ingest_date", "topic", TOPIC_COLS, "score"), *TOPIC_COLS.values())


@query(
    "a10_null_profile",
    cte("wide")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT({c}) AS non_null_rows, COUNT(*) - COUNT({c}) AS null_rows, "
        f"ROUND((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) * 100, 6) AS null_percentage FROM wide"
        for c in COLS
    ),
)
def nulls(spark, sf):
    return r6(null_profile(wide(spark, sf)), "null_percentage")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a11_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS std, MIN({c}) AS min, "
        f"ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50, ROUND(quantile_cont({c}, 0.75), 6) AS p75, MAX({c}) AS max FROM lineitem"
        for c in _NUM
    ),
)
def describe(spark, sf):
    return r6(describe_long(table(spark, sf, "lineitem"), _NUM), "mean", "std", "p25", "p50", "p75")


@query("a12_top_values", "SELECT source, COUNT(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top(spark, sf):
    return top_values(table(spark, sf, "documents"), "source", 10)


@query(
    "a13_u01_frequency_overview",
    cte("wide", "monthly")
    + """SELECT 'daily' AS frequency, COUNT(*) AS record_count, MIN(date) AS earliest_date, MAX(date) AS latest_date,
    ROUND(AVG(urgent), 4) AS avg_1, ROUND(AVG(high), 4) AS avg_2 FROM wide
    UNION ALL SELECT 'monthly', COUNT(*), MIN(date), MAX(date), ROUND(AVG(value), 4), ROUND(AVG(value * 2), 4) FROM monthly""",
)
def overview(spark, sf):
    m = monthly(spark, sf).withColumn("twice", F.col("value") * 2)
    out = frequency_overview({"daily": (wide(spark, sf), ["urgent", "high"]), "monthly": (m, ["value", "twice"])})
    return r6(out, "avg_1", "avg_2", digits=4)


@query(
    "a14_decade_stats",
    cte("daily")
    + """SELECT series, CAST(year(date) // 10 * 10 AS INTEGER) AS decade, ROUND(AVG(value), 4) AS value_mean, MIN(value) AS value_min,
    MAX(value) AS value_max, ROUND(stddev_samp(value), 4) AS value_std FROM daily GROUP BY 1, 2""",
)
def decades(spark, sf):
    return r6(decade_stats(daily(spark, sf), "value", e="series", digits=None), "value_mean", "value_std", digits=4)


@query("a15_month_profile", cte("daily") + "SELECT series, CAST(month(date) AS INTEGER) AS month, ROUND(AVG(value), 5) AS value FROM daily GROUP BY 1, 2")
def months(spark, sf):
    return r6(month_profile(daily(spark, sf), "value", e="series"), "value", digits=5)


@query(
    "a16_total_return",
    cte("prices") + "SELECT ticker, ROUND((arg_max(close_price, date) / arg_min(close_price, date) - 1) * 100, 6) AS total_return FROM prices GROUP BY 1",
)
def returns(spark, sf):
    return r6(total_return(prices(spark, sf)), "total_return")


_RET = (
    cte("prices")
    + """, r AS (SELECT ticker, date, close_price / LAG(close_price) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM prices),
    k AS (SELECT * FROM r WHERE ret IS NOT NULL), c AS (SELECT date FROM k GROUP BY 1 HAVING COUNT(*) = (SELECT COUNT(DISTINCT ticker) FROM k)),
    z AS (SELECT * FROM k WHERE date IN (SELECT date FROM c)) """
)


@query("a17_annual_vol", _RET + "SELECT ticker, ROUND(stddev_samp(ret) * sqrt(252) * 100, 6) AS annual_vol FROM z GROUP BY 1")
def vol(spark, sf):
    return r6(annual_vol(prices_staged(spark, sf)), "annual_vol")


@query("a18_sharpe", _RET + "SELECT ticker, ROUND((AVG(ret) * 252 - 0.02) / (stddev_samp(ret) * sqrt(252)), 6) AS sharpe FROM z GROUP BY 1")
def ratio(spark, sf):
    return r6(sharpe(prices_staged(spark, sf)), "sharpe")


_TW = ", ".join(f"MAX(CASE WHEN ticker = '{k}' THEN close_price END) AS {v}" for k, v in SEGMENTS.items())
_TF = ", ".join(f"last_value({v} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {v}" for v in SEGMENTS.values())
_TR = ", ".join(f"{v} / LAG({v}) OVER (ORDER BY date) - 1 AS {v}" for v in SEGMENTS.values())


@query(
    "a17_a18_market_ratios",
    cte("prices")
    + f", w AS (SELECT date, {_TW} FROM prices GROUP BY 1), f AS (SELECT date, {_TF} FROM w), r AS (SELECT date, {_TR} FROM f), "
    + f"k AS (SELECT * FROM r WHERE {' AND '.join(f'{v} IS NOT NULL' for v in SEGMENTS.values())}), l AS ("
    + " UNION ALL ".join(f"SELECT '{v}' AS ticker, {v} AS ret FROM k" for v in SEGMENTS.values())
    + ") SELECT ticker, ROUND(stddev_samp(ret) * sqrt(252) * 100, 6) AS annual_vol, ROUND((AVG(ret) * 252 - 0.02) / (stddev_samp(ret) * sqrt(252)), 6) AS sharpe FROM l GROUP BY 1",
)
def ratios_wide(spark, sf):
    w = stage(pivot_many(prices(spark, sf), "date", "ticker", SEGMENTS, {"": "close_price"}))
    return r6(market_ratios(w, "date", list(SEGMENTS.values())), "annual_vol", "sharpe")


@query(
    "a19_corr_matrix",
    cte("wide") + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 8) AS r FROM wide" for a, b in combinations(COLS, 2)),
)
def correlations(spark, sf):
    return r6(corr_matrix(wide(spark, sf), COLS), "r", digits=8)


@query(
    "a20_cross_corr",
    cte("wide", "prices")
    + f", p AS (SELECT date, {_TW} FROM prices GROUP BY 1), j AS (SELECT * FROM wide JOIN p USING (date)) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 8) AS r FROM j" for a in ("urgent", "high", "low") for b in SEGMENTS.values()
    ),
)
def cross(spark, sf):
    p = pivot_many(prices(spark, sf), "date", "ticker", SEGMENTS, {"": "close_price"})
    return r6(cross_corr(wide(spark, sf).join(p, "date"), ["urgent", "high", "low"], list(SEGMENTS.values())), "r", digits=8)


@query("a21_pair_corr", "SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, ROUND(corr(l_quantity, l_extendedprice), 8) AS r FROM lineitem")
def pair(spark, sf):
    return r6(corr_matrix(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), "r", digits=8)


@query(
    "a22_common_window",
    cte("daily")
    + """SELECT series, date, value FROM daily WHERE date >= (SELECT MAX(f) FROM (SELECT MIN(date) AS f FROM daily WHERE value IS NOT NULL GROUP BY series))""",
)
def window(spark, sf):
    return common_window(daily(spark, sf))


@query(
    "a23_zscore",
    cte("wide")
    + """SELECT date, ROUND((urgent - (SELECT AVG(urgent) FROM wide)) / (SELECT stddev_pop(urgent) FROM wide), 8) AS urgent,
    ROUND((high - (SELECT AVG(high) FROM wide)) / (SELECT stddev_pop(high) FROM wide), 8) AS high FROM wide""",
)
def standardise(spark, sf):
    return r6(zscore(wide(spark, sf).select("date", "urgent", "high"), ["urgent", "high"]), "urgent", "high", digits=8)


@query(
    "a23_zscore_keyed",
    "SELECT l_orderkey, l_linenumber, l_partkey, ROUND((l_extendedprice - AVG(l_extendedprice) OVER (PARTITION BY l_returnflag)) / "
    "stddev_pop(l_extendedprice) OVER (PARTITION BY l_returnflag), 8) AS z FROM lineitem",
)
def standardise_keyed(spark, sf):
    z = zscore(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", suffix="_z")
    return z.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice_z", 8).alias("z"))


@query(
    "a27_mean_per_key",
    cte("prices") + "SELECT ticker, ROUND(AVG(volume), 6) AS volume FROM prices GROUP BY 1",
)
def volume(spark, sf):
    return r6(mean_per_key(prices(spark, sf), "ticker", "volume"), "volume")


@query(
    "a28_quality_report",
    cte("ord")
    + """, s AS (SELECT o_orderpriority AS series, AVG(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM ord GROUP BY 1),
    d AS (SELECT DISTINCT o_orderpriority AS series, date FROM ord),
    g AS (SELECT series, date - LAG(date) OVER (PARTITION BY series ORDER BY date) AS step FROM d),
    u AS (SELECT series, CAST(COUNT(*) FILTER (step <> shortest) AS BIGINT) AS uneven_steps FROM (SELECT *, MIN(step) OVER (PARTITION BY series) AS shortest FROM g) GROUP BY 1)
    SELECT o.o_orderpriority AS series, COUNT(*) AS row_count, ROUND(COUNT(o_totalprice) / CAST(COUNT(*) AS DOUBLE), 6) AS completeness,
    CAST((SELECT MAX(date) FROM ord) - MAX(date) AS INTEGER) AS age_days, COUNT(*) - COUNT(DISTINCT date) AS duplicate_rows,
    COUNT(*) FILTER (abs(o_totalprice - m) > 1.5 * sd) AS outliers, MAX(uneven_steps) AS uneven_steps
    FROM ord o JOIN s ON s.series = o.o_orderpriority JOIN u ON u.series = o.o_orderpriority GROUP BY 1""",
)
def quality(spark, sf):
    o = orders(spark, sf).withColumnRenamed("o_orderpriority", "series")
    return r6(quality_report(o, "date", "o_totalprice", "series", sigma=1.5), "completeness")


_GROUPS = {"Rates": ["urgent", "high"], "Growth": ["medium"], "Labor": ["low"]}


@query(
    "a29_by_theme",
    cte("wide")
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT date, '{c}' AS indicator, {c} AS value, '{t}' AS theme FROM wide" for t, cs in _GROUPS.items() for c in cs)
    + ") WHERE value IS NOT NULL",
)
def themes(spark, sf):
    return by_theme(wide(spark, sf), "date", _GROUPS)
