"""Risk index: components, mix, levels, alerts, summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.risk import (
    MACRO_WEIGHTS, NEWS_WEIGHTS, WEIGHTS, composite, macro_risk, market_risk, min_max, news_risk, risk_alerts, risk_level, risk_summary,
    simple_index, traffic_light,
)
from tidemark.operators.reshape import pivot_max
from workload.frames import PRIORITIES, SEGMENTS, case, cte, daily, daily_staged, mapped, prices, r6, wide_staged
from workload.register import query

# Columns of the wide table that stand in for the macro columns, and series that stand in for topics.
AS_MACRO = {"urgent": "unemployrate", "high": "cpiurban", "medium": "fedfundrate", "low": "realgdp"}
AS_TOPIC = {"1-URGENT": "fed_policy", "2-HIGH": "labor", "3-MEDIUM": "markets", "4-NOT SPECIFIED": "energy", "5-LOW": "layoff"}
_F = "OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


def _z(c: str) -> str:
    return f"COALESCE(CASE WHEN COUNT({c}) {_F} >= 30 THEN ({c} - AVG({c}) {_F}) / NULLIF(stddev_samp({c}) {_F}, 0) END, 0.0)"


_MACRO = (
    ", mi AS (SELECT date, " + ", ".join(f"{a} AS {b}" for a, b in AS_MACRO.items()) + " FROM wide), "
    + "macro AS (SELECT date, " + " + ".join(f"{_z(c)} * ({w})" for c, w in MACRO_WEIGHTS.items()) + " AS macro_risk FROM mi) "
)
_SEG = list(SEGMENTS.values())
_MARKET = (
    ", pw AS (SELECT date, " + ", ".join(f"MAX(CASE WHEN ticker = '{k}' THEN close_price END) AS {v}" for k, v in SEGMENTS.items())
    + f" FROM prices GROUP BY 1), market AS (SELECT date, COALESCE((SELECT stddev_samp(v) FROM UNNEST([{', '.join(_SEG)}]) t(v)), NULL) * 0.5 "
    + f"- {_z('automobile')} * 0.3 + {_z('building')} * 0.2 AS market_risk FROM pw) "
)
_NEWS = (
    f", nl AS (SELECT date, {case('series', AS_TOPIC)} AS topic, value FROM daily), nw AS (SELECT date, "
    + ", ".join(f"COALESCE(AVG(CASE WHEN topic = '{t}' THEN value END), 0.0) AS {t}" for t in NEWS_WEIGHTS)
    + " FROM nl GROUP BY 1), news AS (SELECT date, " + " + ".join(f"{_z(t)} * ({w})" for t, w in NEWS_WEIGHTS.items()) + " AS news_risk FROM nw) "
)
_INDEX = (
    _MACRO + _MARKET + _NEWS
    + ", cj AS (SELECT date, COALESCE(macro_risk, 0) AS macro_risk, COALESCE(market_risk, 0) AS market_risk, COALESCE(news_risk, 0) AS news_risk "
    "FROM macro FULL JOIN market USING (date) FULL JOIN news USING (date)), "
    f"ci AS (SELECT *, macro_risk * {WEIGHTS['macro']} + market_risk * {WEIGHTS['market']} + news_risk * {WEIGHTS['news']} AS cmri FROM cj), "
    "cn AS (SELECT *, (cmri - (SELECT MIN(cmri) FROM ci)) / ((SELECT MAX(cmri) FROM ci) - (SELECT MIN(cmri) FROM ci)) AS x FROM ci), "
    "idx AS (SELECT *, CASE WHEN x < 0.3 THEN 'Low' WHEN x < 0.6 THEN 'Medium' ELSE 'High' END AS risk_level FROM cn) "
)
_FRAMES = cte("wide", "prices", "daily")


def _macro(d):
    return macro_risk(pivot_max(d, "date", "series", PRIORITIES, "value").withColumnsRenamed(AS_MACRO))


def _market(spark, sf):
    w = pivot_max(prices(spark, sf), "date", "ticker", SEGMENTS, "close_price")
    return market_risk(w, prices=_SEG, broad="automobile", financial="building")


def _news(d):
    return news_risk(d.select("date", mapped("series", AS_TOPIC).alias("topic"), F.col("value").alias("avg_sentiment_score")))


def _index(spark, sf):
    d = daily_staged(spark, sf)
    return composite(_macro(d), _market(spark, sf), _news(d))


@query("r01_macro_risk", _FRAMES + _MACRO + "SELECT date, ROUND(macro_risk, 6) AS macro_risk FROM macro")
def macro(spark, sf):
    return r6(_macro(daily(spark, sf)).select("date", "macro_risk"), "macro_risk")


@query("r02_market_risk", _FRAMES + _MARKET + "SELECT date, ROUND(market_risk, 5) AS market_risk FROM market")
def market(spark, sf):
    return r6(_market(spark, sf).select("date", "market_risk"), "market_risk", digits=5)


@query("r03_news_risk", _FRAMES + _NEWS + "SELECT date, ROUND(news_risk, 6) AS news_risk FROM news")
def news(spark, sf):
    return r6(_news(daily(spark, sf)).select("date", "news_risk"), "news_risk")


@query(
    "r04_j12_composite",
    _FRAMES + _INDEX + "SELECT date, ROUND(macro_risk, 5) AS macro_risk, ROUND(market_risk, 5) AS market_risk, ROUND(news_risk, 5) AS news_risk, ROUND(cmri, 5) AS cmri, ROUND(x, 6) AS cmri_normalized, risk_level FROM idx",
)
def mixed(spark, sf):
    out = r6(_index(spark, sf), "macro_risk", "market_risk", "news_risk", "cmri", digits=5)
    return r6(out, "cmri_normalized")


@query(
    "r05_min_max",
    cte("daily") + "SELECT series, date, ROUND((value - MIN(value) OVER (PARTITION BY series)) / (MAX(value) OVER (PARTITION BY series) - MIN(value) OVER (PARTITION BY series)), 8) AS x FROM daily",
)
def scaled(spark, sf):
    return r6(min_max(daily_staged(spark, sf), "value", "series", "x"), "x", digits=8).drop("value")


@query(
    "r06_risk_level",
    cte("daily") + ", s AS (SELECT series, date, value / (SELECT MAX(value) FROM daily) AS x FROM daily) SELECT series, date, CASE WHEN x < 0.3 THEN 'Low' WHEN x < 0.6 THEN 'Medium' ELSE 'High' END AS level FROM s",
)
def levels(spark, sf):
    d = daily(spark, sf)
    return d.withColumn("x", F.col("value") / d.agg(F.max("value").alias("m")).scalar()).select("series", "date", risk_level("x").alias("level"))


_ALERTS = """, lagged AS (SELECT *, LAG(x) OVER (ORDER BY date) AS px, LAG(risk_level) OVER (ORDER BY date) AS pl FROM idx)
    SELECT date, type FROM (SELECT date, 'warning' AS type FROM lagged WHERE px IS NOT NULL AND risk_level = 'High'
    UNION ALL SELECT date, 'trend' FROM lagged WHERE x - px > 0.1 UNION ALL SELECT date, 'level_change' FROM lagged WHERE risk_level <> pl)"""


@query("r07_alerts", _FRAMES + _INDEX + _ALERTS)
def alerts(spark, sf):
    return risk_alerts(_index(spark, sf)).select("date", "type")


@query(
    "r08_summary",
    _FRAMES + _INDEX
    + """, t AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date DESC) AS k FROM idx), a AS (SELECT AVG(x) FILTER (k <= 7) AS w, AVG(x) FILTER (k <= 30) AS m FROM t)
    SELECT ROUND(x, 6) AS current_cmri, risk_level AS current_risk_level, ROUND(w, 6) AS week_average, ROUND(m, 6) AS month_average,
    CASE WHEN x > w THEN 'increasing' ELSE 'decreasing' END AS trend_direction, ROUND(macro_risk * 0.4, 5) AS macro_contribution,
    ROUND(market_risk * 0.35, 5) AS market_contribution, ROUND(news_risk * 0.25, 5) AS news_contribution FROM t, a WHERE k = 1""",
)
def summary(spark, sf):
    out = r6(risk_summary(_index(spark, sf)), "current_cmri", "week_average", "month_average")
    return r6(out, "macro_contribution", "market_contribution", "news_contribution", digits=5)


_FIVE = ["urgent", "high", "medium", "unspecified", "low"]
_STD = ", ".join(f"({c} - (SELECT AVG({c}) FROM wide)) / (SELECT stddev_pop({c}) FROM wide)" for c in _FIVE)
_SIMPLE = cte("wide") + f", si AS (SELECT date, (SELECT AVG(v) FROM UNNEST([{_STD}]) t(v)) AS risk_index FROM wide) "


@query("r09_simple_index", _SIMPLE + "SELECT date, ROUND(risk_index, 8) AS risk_index FROM si")
def simple(spark, sf):
    return r6(simple_index(wide_staged(spark, sf), _FIVE).select("date", "risk_index"), "risk_index", digits=8)


@query(
    "r10_traffic_light",
    _SIMPLE + "SELECT date, CASE WHEN risk_index < 0 THEN 'green' WHEN risk_index < 1 THEN 'yellow' WHEN risk_index IS NOT NULL THEN 'red' END AS light FROM si",
)
def light(spark, sf):
    return simple_index(wide_staged(spark, sf), _FIVE).select("date", traffic_light("risk_index").alias("light"))
