"""Series, prices, news and registry tables derived from the given tables, in Spark and in SQL.

Money is summed as DECIMAL, so both engines see the same doubles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.fills import on_calendar
from tidemark.operators.reshape import pivot_max, weekly_combine, weekly_mean
from tidemark.session import shared_folder, stage

PRIORITIES = {
    "1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low",
}
SEGMENTS = {s: s.lower() for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
EVENT_TOPICS = {"click": "fed", "error": "Layoffs", "purchase": "inflation", "signup": "oil", "view": "Other"}
MONTHLY = {"1-URGENT": "FEDFUNDS", "2-HIGH": "CPIAUCSL", "3-MEDIUM": "UNRATE", "4-NOT SPECIFIED": "TOTALSL", "5-LOW": "USREC"}
DAILY = {"A": "DGS2", "N": "DGS10", "R": "T5YIE"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def money(c) -> Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def mapped(c: str, names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(c)]


def case(c: str, names: dict[str, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


def r6(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round computed doubles, so that the last bit of an average does not decide a comparison."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- Spark frames ---------------------------------------------------------------------------------


def orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").withColumn("date", F.col("o_orderdate").cast("date"))


def daily(spark, sf) -> DataFrame:
    """One value per priority and day."""
    return orders(spark, sf).groupBy(F.col("o_orderpriority").alias("series"), "date").agg(money("o_totalprice").alias("value"))


def dense(spark, sf) -> DataFrame:
    """The same on every day, NULL where there was no order."""
    return on_calendar(daily_staged(spark, sf), e="series")


def wide(spark, sf) -> DataFrame:
    return pivot_max(daily(spark, sf), "date", "series", PRIORITIES, "value")


def monthly(spark, sf) -> DataFrame:
    d = orders(spark, sf).withColumn("date", F.trunc("date", "MM"))
    return d.groupBy(F.col("o_orderpriority").alias("series"), "date").agg(money("o_totalprice").alias("value"))


def weekly(spark, sf) -> DataFrame:
    """Weekly mean per series, with the monthly sum in the week of the first of a month, else NULL."""
    w = weekly_mean(daily(spark, sf), "date", "value", "series")
    m = weekly_mean(monthly(spark, sf), "date", "value", "series").withColumnRenamed("value", "sparse")
    return weekly_combine(w, [m], ["series", "year", "week"])


def prices(spark, sf) -> DataFrame:
    """Mean order price and order count per market segment and day, summed per customer before the join."""
    per_customer = orders(spark, sf).groupBy("o_custkey", "date").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("ticker"))
    return per_customer.join(customers, "o_custkey").groupBy("date", "ticker").agg(
        (F.sum("s").cast("double") / F.sum("n")).alias("close_price"), F.sum("n").cast("double").alias("volume")
    )


def raw(spark, sf) -> DataFrame:
    """Long raw series: five monthly ones, a quarterly one, three daily ones with two ingests a day, a
    weekly one and a quarterly one with several values a date."""
    cents = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    # One scan of each big table; months, quarters and weeks are rolled up from its daily sums.
    o = orders(spark, sf).groupBy("o_orderpriority", "o_orderstatus", "date").agg(cents("o_totalprice").alias("s"))
    l = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("date")).agg(
        cents("l_extendedprice").alias("s")
    )
    total = F.sum("s").cast("double").alias("value")
    quarter = F.trunc("date", "quarter").alias("date")

    def long(df, series):
        return df.select(
            series.alias("series"), "date", "value",
            (F.col("date").cast("timestamp") + F.make_interval(hours=F.col("h"))).alias("ingest_timestamp"),
        )

    zero = F.lit(0).alias("h")
    m = o.groupBy("o_orderpriority", F.trunc("date", "MM").alias("date")).agg(total)
    q = o.groupBy(quarter).agg(total)
    c = o.groupBy("o_orderstatus", quarter).agg(total)
    d = l.withColumn("value", F.col("s").cast("double"))
    w = l.groupBy(F.next_day(F.date_sub("date", 1), "SUN").alias("date")).agg(total)
    parts = [
        long(m.select("*", zero), mapped("o_orderpriority", MONTHLY)),
        long(q.select("*", zero), F.lit("GDPC1")),
        long(c.select("*", zero), F.lit("DRCCLACBS")),
        long(d.withColumn("h", F.when(F.col("l_linestatus") == "F", 1).otherwise(2)), mapped("l_returnflag", DAILY)),
        long(w.select("*", zero), F.lit("MORTGAGE30US")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def articles(spark, sf) -> DataFrame:
    """Events as news: a user is a url, a day a publish date, the event time the ingest time."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("https://site"), F.col("user_id") % 7, F.lit(".example.com/a/"), F.col("user_id")).alias("url"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("published_at"),
        F.col("ts").cast("timestamp").alias("ingest_datetime"),
        F.col("ts").cast("date").alias("ingest_date"),
        mapped("event_type", EVENT_TOPICS).alias("topic"),
        F.when(F.col("value") >= 5, F.concat(F.lit("Article "), F.col("event_id"))).alias("title"),
        F.col("value").alias("score"),
        F.concat(F.lit("site"), F.col("user_id") % 7, F.lit(".example.com")).alias("source_domain"),
        F.col("props").alias("snippet"),
        "event_id",
    )


def runs(spark, sf) -> DataFrame:
    """Events as training runs."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    text = lambda c: F.col(c).cast("string")
    return e.select(
        F.concat(F.lit("run_"), F.lpad(text("event_id"), 12, "0")).alias("run_id"),
        F.concat(F.lit("model_"), F.col("event_type")).alias("model_id"),
        F.concat(F.lit("data_"), F.dayofmonth("ts").cast("string")).alias("dataset_id"),
        F.concat(F.lit('{"algorithm":"algo_'), F.col("user_id") % 4, F.lit('"}')).alias("params"),
        F.when(
            F.col("value") < 1, F.concat(F.lit('{"mae":'), k, F.lit("}"))
        ).otherwise(F.concat(F.lit('{"smape":'), k, F.lit(',"MAE":'), text("value"), F.lit(',"test_count":100}'))).alias("metrics"),
        F.concat(F.lit("models/"), text("event_id")).alias("artifact"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def deployments(spark, sf) -> DataFrame:
    """Events as deployments: purchases carry all traffic, sign-ups half, the rest none."""
    e = table(spark, sf, "events")
    padded = F.lpad(F.col("event_id").cast("string"), 12, "0")
    return e.select(
        F.concat(F.lit("deploy_"), padded).alias("deployment_id"),
        F.concat(F.lit("version_"), padded).alias("model_version_id"),
        F.lit("endpoint").alias("endpoint_url"),
        F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "signup", 0.5).otherwise(0.0).alias("traffic_split"),
        F.col("ts").cast("timestamp").alias("deployed_at"),
        F.lit("N/A").alias("params"),
        F.concat(F.lit('{"smape":'), F.col("value").cast("string"), F.lit("}")).alias("metrics"),
        F.lit("").alias("artifact"),
    )


def versions(spark, sf) -> DataFrame:
    """One model version per event; users are the models."""
    e = table(spark, sf, "events")
    padded = F.lpad(F.col("event_id").cast("string"), 12, "0")
    return e.select(
        F.concat(F.lit("version_"), padded).alias("model_version_id"),
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_id"),
        F.concat(F.lit("run_"), padded).alias("training_run_id"),
        F.lit("").alias("artifact_path"),
        F.col("props").alias("metrics_json"),
        F.lit("approved").alias("status"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


# Reduced frames that an operator reads more than once are staged, so the big tables are scanned once.


def daily_staged(spark, sf) -> DataFrame:
    return stage(daily(spark, sf), "daily")


def dense_staged(spark, sf) -> DataFrame:
    return stage(on_calendar(daily_staged(spark, sf), e="series"), "dense")


def wide_staged(spark, sf) -> DataFrame:
    return stage(wide(spark, sf), "wide")


def prices_staged(spark, sf) -> DataFrame:
    return stage(prices(spark, sf), "prices")


def raw_staged(spark, sf) -> DataFrame:
    return stage(raw(spark, sf), "raw")


# --- The same in SQL ------------------------------------------------------------------------------

_MONEY = "CAST(SUM(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
_PAD = "lpad(CAST(event_id AS VARCHAR), 12, '0')"
_INT = "CAST({} AS INTEGER)"


def sql_money(c: str) -> str:
    return _MONEY.format(c)


def sql_week(d: str) -> str:
    return f"CAST(strftime({d}, '%U') AS INTEGER)"


def sql_round2(x: str) -> str:
    """Rounding of the decimal print, ties away from zero."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)), 2) AS DOUBLE)"


def sql_pivot(names: dict[str, str], key="series", value="value") -> str:
    return ", ".join(f"MAX(CASE WHEN {key} = '{k}' THEN {value} END) AS {v}" for k, v in names.items())


def _long(series: str, source: str, date: str, value: str, hours: str = "0", group: str = "") -> str:
    g = f", {group}" if group else ""
    return (
        f"SELECT {series} AS series, {date} AS date, {sql_money(value)} AS value, "
        f"CAST({date} AS TIMESTAMP) + to_hours({hours}) AS ingest_timestamp FROM {source} GROUP BY {date}{g}"
    )


_CTES: dict[str, tuple[list[str], str]] = {
    "ord": ([], "SELECT *, CAST(o_orderdate AS DATE) AS date FROM orders"),
    "line": ([], "SELECT *, CAST(l_shipdate AS DATE) AS date FROM lineitem"),
    "daily": (["ord"], f"SELECT o_orderpriority AS series, date, {sql_money('o_totalprice')} AS value FROM ord GROUP BY 1, 2"),
    "days": (
        ["daily"],
        "SELECT CAST(UNNEST(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date "
        "FROM (SELECT MIN(date) AS a, MAX(date) AS b FROM daily)",
    ),
    "dense": (
        ["daily", "days"],
        "SELECT s.series, c.date, d.value FROM (SELECT DISTINCT series FROM daily) s CROSS JOIN days c "
        "LEFT JOIN daily d ON d.series = s.series AND d.date = c.date",
    ),
    "wide": (["daily"], f"SELECT date, {sql_pivot(PRIORITIES)} FROM daily GROUP BY date"),
    "monthly": (
        ["ord"],
        f"SELECT o_orderpriority AS series, CAST(date_trunc('month', date) AS DATE) AS date, {sql_money('o_totalprice')} AS value "
        "FROM ord GROUP BY 1, 2",
    ),
    "weekly": (
        ["daily", "monthly"],
        f"SELECT w.*, m.sparse FROM (SELECT series, CAST(year(date) AS INTEGER) AS year, {sql_week('date')} AS week, AVG(value) AS value "
        "FROM daily GROUP BY 1, 2, 3) w LEFT JOIN (SELECT series, CAST(year(date) AS INTEGER) AS year, "
        f"{sql_week('date')} AS week, AVG(value) AS sparse FROM monthly GROUP BY 1, 2, 3) m "
        "ON m.series = w.series AND m.year = w.year AND m.week = w.week",
    ),
    "prices": (
        ["ord"],
        "SELECT date, c_mktsegment AS ticker, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS close_price, "
        "CAST(COUNT(*) AS DOUBLE) AS volume FROM ord JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2",
    ),
    "raw": (
        ["ord", "line"],
        " UNION ALL ".join(
            [
                _long(case("o_orderpriority", MONTHLY), "ord", "CAST(date_trunc('month', date) AS DATE)", "o_totalprice", "0", "o_orderpriority"),
                _long("'GDPC1'", "ord", "CAST(date_trunc('quarter', date) AS DATE)", "o_totalprice"),
                _long("'DRCCLACBS'", "ord", "CAST(date_trunc('quarter', date) AS DATE)", "o_totalprice", "0", "o_orderstatus"),
                _long(case("l_returnflag", DAILY), "line", "date", "l_extendedprice",
                      "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END", "l_returnflag, l_linestatus"),
                _long("'MORTGAGE30US'", "line", "CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE)", "l_extendedprice"),
            ]
        ),
    ),
    "articles": (
        [],
        "SELECT 'https://site' || (user_id % 7) || '.example.com/a/' || user_id AS url, date_trunc('day', ts) AS published_at, "
        f"ts AS ingest_datetime, CAST(ts AS DATE) AS ingest_date, {case('event_type', EVENT_TOPICS)} AS topic, "
        "CASE WHEN value >= 5 THEN 'Article ' || event_id END AS title, value AS score, "
        "'site' || (user_id % 7) || '.example.com' AS source_domain, props AS snippet, event_id FROM events",
    ),
    "runs": (
        [],
        f"SELECT 'run_' || {_PAD} AS run_id, 'model_' || event_type AS model_id, 'data_' || day(ts) AS dataset_id, "
        "'algo_' || (user_id % 4) AS algorithm, CASE WHEN value < 1 THEN NULL ELSE CAST(props->>'$.k' AS DOUBLE) END AS smape, "
        "CASE WHEN value < 1 THEN CAST(props->>'$.k' AS DOUBLE) ELSE value END AS mae, "
        "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, ts AS created_at FROM events",
    ),
    "deployments": (
        [],
        f"SELECT 'deploy_' || {_PAD} AS deployment_id, 'version_' || {_PAD} AS model_version_id, "
        "CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.5 ELSE 0.0 END::DOUBLE AS traffic_split, "
        "ts AS deployed_at, value AS smape, user_id, event_type FROM events",
    ),
    "versions": (
        [],
        f"SELECT 'version_' || {_PAD} AS model_version_id, 'model_' || user_id AS model_id, 'run_' || {_PAD} AS training_run_id FROM events",
    ),
}


def cte(*wanted: str) -> str:
    """WITH clause for the named frames and what they need."""
    order: list[str] = []

    def need(name):
        for dep in _CTES[name][0]:
            need(dep)
        if name not in order:
            order.append(name)

    for name in wanted:
        need(name)
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n][1]})" for n in order) + " "
