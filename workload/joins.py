"""Joins, alignment, upserts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.fills import on_calendar, resample_month_last
from tidemark.operators.merge import dedupe, upsert
from tidemark.operators.reshape import (
    common_dates, concat, join_by_month, outer_align, pivot_max, stack_series, weekly_combine, weekly_mean,
)
from tidemark.operators.rolling import first_per_key, latest_per_key, time_split
from tidemark.plans.registry import enrich_model_name
from tidemark.sources.sinks import read_days, upsert_days, write_days
from workload.frames import PRIORITIES, cte, daily, daily_staged, monthly, orders, prices, r6, runs, scratch, sql_pivot, table, versions, wide_staged
from workload.register import query


@query(
    "j01_outer_align",
    cte("daily", "monthly")
    + f"""SELECT date, {', '.join(PRIORITIES.values())}, month FROM
    {' FULL JOIN '.join(f"(SELECT date, value AS {v} FROM daily WHERE series = '{k}') {v}" + ('' if i == 0 else ' USING (date)') for i, (k, v) in enumerate(PRIORITIES.items()))}
    FULL JOIN (SELECT date, MAX(value) AS month FROM monthly GROUP BY 1) m USING (date)""",
)
def outer(spark, sf):
    """Every daily series and the monthly table, whose dates repeat, as one frame each."""
    d = daily_staged(spark, sf)
    frames = {v: d.filter(F.col("series") == k) for k, v in PRIORITIES.items()}
    return outer_align({**frames, "month": monthly(spark, sf).select("date", "value")})


@query("j02_weekly_combine", cte("weekly") + "SELECT series, year, week, ROUND(value, 6) AS value, ROUND(sparse, 6) AS sparse FROM weekly")
def combine(spark, sf):
    w = weekly_mean(daily(spark, sf), "date", "value", "series")
    m = weekly_mean(monthly(spark, sf), "date", "value", "series").withColumnRenamed("value", "sparse")
    return r6(weekly_combine(w, [m], ["series", "year", "week"]), "value", "sparse")


@query("j03_on_calendar", cte("dense") + "SELECT series, date, value FROM dense")
def calendar(spark, sf):
    return on_calendar(daily_staged(spark, sf), e="series")


@query(
    "j04_inner_join",
    cte("ord") + "SELECT o_orderkey, c_mktsegment, n_name FROM ord JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey",
)
def inner(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_mktsegment", "n_name")
    )


_SPLIT = (
    cte("wide")
    + """, o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS rn FROM wide), c AS (SELECT COUNT(*) AS total FROM o)
    SELECT date, urgent, rn, CASE WHEN rn > total - 100 THEN 'test' ELSE 'train' END AS split FROM o, c"""
)


@query("j05_w18_time_split", _SPLIT)
def split(spark, sf):
    return time_split(wide_staged(spark, sf), "date", 100).select("date", "urgent", "rn", "split")


@query(
    "w18_time_split_keyed",
    cte("daily")
    + """SELECT series, date, value, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) AS rn,
    CASE WHEN ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) <= 24 THEN 'test' ELSE 'train' END AS split FROM daily""",
)
def split_keyed(spark, sf):
    return time_split(daily_staged(spark, sf), "date", 24, "series").select("series", "date", "value", "rn", "split")


_UPSERT = """, held AS (SELECT user_id, d, ts, value, title FROM e WHERE d <= DATE '2024-01-20' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id) = 1),
    new AS (SELECT user_id, d, ts, value * 2 AS value, title FROM e WHERE d >= DATE '2024-01-13' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY value DESC, event_id) = 1) """
_E = "WITH e AS (SELECT *, CAST(ts AS DATE) AS d, CASE WHEN value >= 5 THEN event_type END AS title FROM events)"


def _sides(spark, sf):
    """Rows held up to a day, and a later load that reads a week of them again."""
    e = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("d"), "ts", "value", F.when(F.col("value") >= 5, F.col("event_type")).alias("title")
    )
    held = dedupe(e.filter(F.col("d") <= "2024-01-20"), ["user_id", "d"], "ts", "event_id").drop("event_id")
    new = dedupe(e.filter(F.col("d") >= "2024-01-13"), ["user_id", "d"], "value", "event_id").drop("event_id")
    return held, new.withColumn("value", F.col("value") * 2)


@query(
    "j08_upsert",
    _E + _UPSERT
    + """SELECT COALESCE(h.user_id, n.user_id) AS user_id, COALESCE(h.d, n.d) AS d, COALESCE(n.ts, h.ts) AS ts,
    COALESCE(n.value, h.value) AS value, COALESCE(n.title, h.title) AS title FROM held h FULL JOIN new n ON h.user_id = n.user_id AND h.d IS NOT DISTINCT FROM n.d""",
)
def merge(spark, sf):
    held, new = _sides(spark, sf)
    return upsert(held, new, ["user_id", "d"], ["title"], ["ts", "value"], ["user_id"])


@query(
    "j08_upsert_days",
    _E + _UPSERT
    + """SELECT COALESCE(h.user_id, n.user_id) AS user_id, COALESCE(h.d, n.d) AS d, COALESCE(n.ts, h.ts) AS ts,
    COALESCE(n.value, h.value) AS value, COALESCE(n.title, h.title) AS title FROM held h FULL JOIN new n ON h.user_id = n.user_id AND h.d IS NOT DISTINCT FROM n.d""",
)
def merge_days(spark, sf):
    """The same on a table kept by day, of which only the days of the load are read and replaced."""
    held, new = _sides(spark, sf)
    path = scratch(spark, "j08")
    write_days(held, path, "d")
    upsert_days(new, path, held.schema, "d", lambda t, s: upsert(t, s, ["user_id", "d"], ["title"], ["ts", "value"], ["user_id"]))
    return read_days(spark, path, held.schema)


@query("j07_semi_join", "SELECT c_custkey, c_nationkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_nationkey")


@query("u04_common_keys", "SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders INTERSECT SELECT user_id FROM events")
def shared_keys(spark, sf):
    sets = [table(spark, sf, t).select(F.col(c).alias("key")) for t, c in (("customer", "c_custkey"), ("orders", "o_custkey"), ("events", "user_id"))]
    return sets[0].intersect(sets[1]).intersect(sets[2])


@query(
    "j09_upsert_daily",
    _E + _UPSERT
    + """, t AS (SELECT d, COUNT(*) AS n, 'kept' AS notes FROM held GROUP BY 1), s AS (SELECT d, COUNT(*) + 1000 AS n FROM new GROUP BY 1)
    SELECT COALESCE(t.d, s.d) AS d, COALESCE(s.n, t.n) AS n, t.notes FROM t FULL JOIN s ON t.d = s.d""",
)
def merge_daily(spark, sf):
    held, new = _sides(spark, sf)
    target = held.groupBy("d").agg(F.count(F.lit(1)).alias("n")).withColumn("notes", F.lit("kept"))
    source = new.groupBy("d").agg((F.count(F.lit(1)) + 1000).alias("n"))
    return upsert(target, source, "d", overwrite_cols="n")


@query(
    "j11_enrich_model_name",
    "SELECT 'version_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS model_version_id, "
    "CASE WHEN event_type = 'error' THEN 'own' ELSE 'algo_' || (user_id % 4) END AS model_name FROM events",
)
def enrich(spark, sf):
    v = versions(spark, sf).withColumn("params", F.lit('{"algorithm":"own"}'))
    r = runs(spark, sf).filter(F.col("status") == "completed")
    return enrich_model_name(v, r).select("model_version_id", "model_name")


@query(
    "j13_month_join",
    cte("prices", "monthly")
    + """, p AS (SELECT ticker, date_trunc('month', date)::DATE AS month, arg_max(close_price, date) AS close_price FROM prices GROUP BY 1, 2)
    SELECT p.month, ticker, close_price, series, value FROM p JOIN monthly m ON m.date = p.month""",
)
def month_join(spark, sf):
    market = resample_month_last(prices(spark, sf), "date", "close_price", "ticker")
    return join_by_month(market, monthly(spark, sf))


@query(
    "j14_common_dates",
    cte("daily") + "SELECT series, date, value FROM daily WHERE date IN (SELECT date FROM daily GROUP BY 1 HAVING COUNT(DISTINCT series) = (SELECT COUNT(DISTINCT series) FROM daily))",
)
def common(spark, sf):
    return common_dates(daily_staged(spark, sf), "series")


@query(
    "u02_stack_series",
    cte("daily", "monthly") + "SELECT 'daily' AS label, date, value FROM daily UNION ALL SELECT 'monthly', date, value FROM monthly",
)
def stack(spark, sf):
    return stack_series({"daily": daily(spark, sf).select("date", "value"), "monthly": monthly(spark, sf).select("date", "value")}, "label")


@query(
    "u03_concat",
    cte("daily", "monthly") + "SELECT series, date, value, CAST(NULL AS DOUBLE) AS projected FROM daily UNION ALL SELECT series, date, NULL, value FROM monthly",
)
def concatenated(spark, sf):
    return concat([daily(spark, sf), monthly(spark, sf).withColumnRenamed("value", "projected")])


@query(
    "w06_first_per_key",
    cte("ord") + "SELECT o_orderpriority, date, o_orderkey, o_totalprice FROM ord QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderpriority, date ORDER BY o_totalprice DESC, o_orderkey) = 1",
)
def first(spark, sf):
    return first_per_key(orders(spark, sf), ["o_orderpriority", "date"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select(
        "o_orderpriority", "date", "o_orderkey", "o_totalprice"
    )


@query("w07_latest_per_key", "SELECT user_id, event_id, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def latest(spark, sf):
    return latest_per_key(table(spark, sf, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "value")


@query("a03_pivot_series", cte("daily") + f"SELECT date, {sql_pivot(PRIORITIES)} FROM daily GROUP BY date")
def pivot(spark, sf):
    return pivot_max(daily(spark, sf), "date", "series", PRIORITIES, "value")
