"""Composite risk index: components, mix, level, alerts, summary.

Its tables have one row per date (and key), so the calendar bounds a series and its window stays whole;
``segment=None`` cuts hot keys and un-keyed tables instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import row_mean, row_std
from tidemark.operators.ordered import WHOLE, attach, names, over_rows
from tidemark.operators.profile import zscore
from tidemark.operators.reshape import pivot_mean
from tidemark.operators.rolling import last_n, rolling_z
from tidemark.schemas import TOPICS
from tidemark.session import stage

# Fixed values of the index.
WEIGHTS = {"macro": 0.4, "market": 0.35, "news": 0.25}
MACRO_WEIGHTS = {"unemployrate": 0.3, "cpiurban": 0.3, "fedfundrate": 0.2, "realgdp": -0.2}
ETFS = ["SPY", "XLF", "XLY", "XLK", "XLE", "XLI", "XLRE"]
NEWS_WEIGHTS = {
    "fed_policy": -0.25,
    "labor": -0.2,
    "markets": -0.2,
    "energy": -0.15,
    "real_estate": -0.1,
    "cpi": -0.05,
    "layoff": 0.05,
}
LOW, MEDIUM = 0.3, 0.6
Z_ROWS = 30


def _weighted(df: DataFrame, weights: dict[str, float]) -> Column:
    """Sum of z-score times weight over the columns the table has."""
    out = F.lit(0.0)
    for c, weight in weights.items():
        if f"{c}_zscore" in df.columns:
            out = out + F.col(f"{c}_zscore") * weight
    return out


def macro_risk(df: DataFrame, e=(), date="date", weights=MACRO_WEIGHTS, segment=WHOLE) -> DataFrame:
    z = rolling_z(df, date, [c for c in weights if c in df.columns], Z_ROWS, e, segment=segment)
    return z.withColumn("macro_risk", _weighted(z, weights))


def market_risk(df: DataFrame, e=(), date="date", prices=ETFS, broad="SPY", financial="XLF", segment=WHOLE) -> DataFrame:
    """Half the spread of the prices of a day, less the broad market's score, plus the financials'."""
    z = rolling_z(df, date, [broad, financial], Z_ROWS, e, segment=segment)
    return z.withColumn("market_volatility", row_std(prices)).withColumn(
        "market_risk",
        F.col("market_volatility") * 0.5 - F.col(f"{broad}_zscore") * 0.3 + F.col(f"{financial}_zscore") * 0.2,
    )


def news_risk(
    df: DataFrame, e=(), date="date", score="avg_sentiment_score", topics=TOPICS, weights=NEWS_WEIGHTS, segment=WHOLE
) -> DataFrame:
    """Weighted z-scores of the daily mean score per topic; a topic without news on a day counts 0."""
    wide = pivot_mean(df, [*names(e), date], "topic", {t: t for t in topics}, score)
    z = rolling_z(wide, date, [t for t in weights if t in topics], Z_ROWS, e, segment=segment)
    return z.withColumn("news_risk", _weighted(z, weights))


def min_max(df: DataFrame, col: str, e=(), name: str | None = None) -> DataFrame:
    """Scale to 0..1 over the table or key; a flat column gives 0.5."""
    ends = df.groupBy(*names(e)).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    span = F.col("__hi") - F.col("__lo")
    scaled = F.when(span > 0, (F.col(col) - F.col("__lo")) / F.when(span > 0, span)).otherwise(F.lit(0.5))
    return attach(df, ends, e).withColumn(name or f"{col}_normalized", scaled).drop("__lo", "__hi")


def risk_level(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x < LOW, "Low").when(x < MEDIUM, "Medium").otherwise("High")


def composite(macro: DataFrame, market: DataFrame, news: DataFrame, e=(), date="date", weights=WEIGHTS) -> DataFrame:
    """Outer join of the three components on date, a missing one counts 0, mixed and scaled to 0..1."""
    on = [*names(e), date]
    out = macro.select(*on, "macro_risk")
    for part, name in ((market, "market_risk"), (news, "news_risk")):
        out = out.join(part.select(*on, name), on, "full")
    out = out.fillna(0.0, subset=["macro_risk", "market_risk", "news_risk"])
    mix = sum((F.col(f"{k}_risk") * w for k, w in weights.items()), F.lit(0.0))
    # Scaling reads the mix twice; without the stage the rolling windows below it would run twice.
    mixed = stage(out.withColumn("cmri", mix), "risk_mix")
    return min_max(mixed, "cmri", e).withColumn("risk_level", risk_level("cmri_normalized"))


def risk_alerts(df: DataFrame, order="date", e=(), index="cmri_normalized", rise=0.1, latest_only=False, segment=WHOLE) -> DataFrame:
    """One row per alert: high level, rise above ``rise``, changed level. A key's first row has none."""

    def previous(w):
        return {"__index": F.lag(index).over(w), "__level": F.lag("risk_level").over(w)}

    rows = over_rows(df, order, previous, e, before=1, segment=segment).filter(F.col("__index").isNotNull())
    if latest_only:
        rows = last_n(rows, order, 1, e)
    change = F.col(index) - F.col("__index")

    def alert(when, kind, title, message, severity):
        fields = {"type": F.lit(kind), "title": F.lit(title), "message": message, "severity": F.lit(severity)}
        return F.when(when, F.struct(*[v.alias(k) for k, v in fields.items()]))

    # Titles and severities of the alerts.
    alerts = F.array(
        alert(F.col("risk_level") == "High", "warning", "High Risk Alert",
              F.format_string("Index is at %.2f - high risk level", F.col(index)), "high"),
        alert(change > rise, "trend", "Rapid Risk Increase",
              F.format_string("Index rose by %.2f in the last period", change), "medium"),
        alert(F.col("risk_level") != F.col("__level"), "level_change", "Risk Level Changed",
              F.format_string("Risk level changed from %s to %s", F.col("__level"), F.col("risk_level")), "medium"),
    )
    return rows.select(*names(e), order, F.inline(F.array_compact(alerts)))


def risk_summary(df: DataFrame, order="date", e=(), index="cmri_normalized", weights=WEIGHTS) -> DataFrame:
    """Current value and level, means of the last 7 and 30 rows (the shorter one, or the value itself,
    where there are too few), direction and weighted contributions. Only 30 rows per key are gathered."""
    tail = last_n(df, order, 30, e)
    keys = names(e)
    newest = F.array_sort(
        F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*df.columns).alias("row"))),
        lambda a, b: F.when(a["o"] < b["o"], 1).when(a["o"] > b["o"], -1).otherwise(0),
    )
    held = tail.groupBy(*keys).agg(newest.alias("__rows"))
    rows, n = F.col("__rows"), F.size("__rows")

    def mean(k):
        part = F.slice(rows, 1, k)
        return F.aggregate(part, F.lit(0.0), lambda acc, r: acc + r["row"][index]) / F.size(part)

    current = rows[0]["row"]
    week = F.when(n >= 7, mean(7)).otherwise(current[index])
    month = F.when(n >= 30, mean(30)).otherwise(week)
    return held.select(
        *keys,
        current[index].alias("current_cmri"),
        current["risk_level"].alias("current_risk_level"),
        week.alias("week_average"),
        month.alias("month_average"),
        F.when(current[index] > week, "increasing").otherwise("decreasing").alias("trend_direction"),
        *[(current[f"{k}_risk"] * w).alias(f"{k}_contribution") for k, w in weights.items()],
    )


def simple_index(df: DataFrame, cols, e=(), name: str = "risk_index") -> DataFrame:
    """Mean of the standardised columns, NULLs skipped."""
    cols = names(cols)
    scaled = zscore(df, cols, e, suffix="_std")
    return scaled.withColumn(name, row_mean([f"{c}_std" for c in cols])).drop(*[f"{c}_std" for c in cols])


def traffic_light(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x < 0, "green").when(x < 1, "yellow").when(x.isNotNull(), "red")
