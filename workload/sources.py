"""Scans, sinks and table statistics. Round trips write derived rows to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.readers import flatten_observations, read_latest_file, read_news_json, read_series_csv
from tidemark.sources.sinks import (
    align_to_schema, ensure_table, insert_rows, read_current, write_append, write_batch, write_clustered, write_overwrite,
)
from tidemark.sources.stats import (
    bounds, completeness_score, dataset_snapshot, folder_size, freshness, latest_key_date, quick_stats, table_size, table_stats, total_records,
)
from workload.frames import articles, cte, daily, dense, orders, r6, scratch, table
from workload.register import query

AS_OF = "2001-08-10"
SERIES = cte("daily") + "SELECT series, date, value FROM daily"
POINT = "series STRING, date DATE, value DOUBLE"


@query("s01_csv_scan", SERIES)
def csv_scan(spark, sf):
    path = scratch(spark, "csv")
    daily(spark, sf).write.option("header", True).csv(path)
    return read_series_csv(spark, f"{path}/*.csv", POINT)


@query("s02_latest_file", cte("daily") + "SELECT series, date, value + 1 AS value FROM daily")
def latest_file(spark, sf):
    path = scratch(spark, "latest")
    rows = daily(spark, sf)
    # Two loads per series, a folder each; the second one is newer.
    for load, add in (("a", 0), ("b", 1)):
        rows.withColumn("value", F.col("value") + add).withColumn("name", F.regexp_replace("series", "[^A-Z0-9]+", "_")).write.option("header", True).partitionBy("name").csv(f"{path}/load={load}")
    return read_latest_file(spark, path, POINT, key_pattern="name=([^/]+)", unit="folder")


@query("s03_flatten_observations", cte("dense") + "SELECT series, date, value FROM dense")
def flatten(spark, sf):
    point = F.struct(
        F.col("date").cast("string").alias("date"), F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value")
    )
    # A month of a series is one document of at most 31 observations.
    months = dense(spark, sf).groupBy("series", F.trunc("date", "MM").alias("month")).agg(F.collect_list(point).alias("observations"))
    return flatten_observations(months)


@query(
    "s04_news_json",
    cte("articles") + "SELECT url, topic, title, score, published_at, ingest_date, CAST(snippet->>'$.k' AS BIGINT) AS k FROM articles",
)
def news_json(spark, sf):
    path = scratch(spark, "news")
    rows = articles(spark, sf).withColumn("raw_payload", F.from_json("snippet", "k BIGINT")).drop("event_id")
    rows.write.json(path)
    news = read_news_json(spark, path)
    return news.select(
        "url", "topic", "title", "score", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "ingest_date",
        F.get_json_object("raw_payload", "$.k").cast("bigint").alias("k"),
    )


@query("s05_batch_files", cte("daily") + "SELECT series, date, value, TIMESTAMP '2024-01-01 00:00:00' AS ingest_timestamp FROM daily")
def batch_files(spark, sf):
    path = scratch(spark, "batch")
    write_batch(daily(spark, sf), path, "series", "2024-01-01")
    return spark.read.parquet(path).select("series", "date", "value", F.col("ingest_timestamp").cast("timestamp_ntz").alias("ingest_timestamp"))


@query("s06_overwrite", cte("daily") + "SELECT series, date, value * 2 AS value FROM daily")
def overwrite(spark, sf):
    path = scratch(spark, "snapshot")
    write_overwrite(daily(spark, sf), path)
    write_overwrite(read_current(spark, path).withColumn("value", F.col("value") * 2), path)
    return read_current(spark, path)


@query("s07_append", cte("daily") + "SELECT series, date, value FROM daily UNION ALL SELECT series, date, -value FROM daily")
def append(spark, sf):
    path = scratch(spark, "append")
    write_append(daily(spark, sf), path)
    write_append(daily(spark, sf).withColumn("value", -F.col("value")), path)
    return spark.read.parquet(path)


@query("s08_partitioned_table", cte("ord") + "SELECT o_orderkey, o_orderpriority, date, date_trunc('month', date)::DATE AS month FROM ord")
def partitioned(spark, sf):
    path = scratch(spark, "clustered")
    rows = orders(spark, sf).select("o_orderkey", "o_orderpriority", "date", F.trunc("date", "MM").alias("month"))
    write_clustered(rows, path, ["month"], ["o_orderpriority", "o_orderkey"])
    return spark.read.schema(rows.schema).parquet(path).select(rows.columns)


@query("s09_align_schema", cte("daily") + "SELECT date, CAST(NULL AS DOUBLE) AS realgdp, value, series FROM daily")
def align(spark, sf):
    target = StructType.fromDDL("date DATE, realgdp DOUBLE, value DOUBLE, series STRING")
    return align_to_schema(daily(spark, sf).withColumn("extra", F.lit(1)), target)


@query("s10_insert_rows", cte("daily") + "SELECT date, value, CAST(NULL AS DOUBLE) AS predicted FROM daily")
def insert(spark, sf):
    path = scratch(spark, "insert")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    ensure_table(spark, name, StructType.fromDDL("date DATE, value DOUBLE, predicted DOUBLE"), location=path)
    insert_rows(daily(spark, sf), name)
    rows = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
    return rows


@query(
    "s11_table_stats",
    "SELECT 'orders' AS table_name, COUNT(*) AS row_count, MAX(o_orderdate) AS latest FROM orders "
    "UNION ALL SELECT 'events', COUNT(*), MAX(ts) FROM events UNION ALL SELECT 'nation', COUNT(*), NULL FROM nation",
)
def stats(spark, sf):
    out = table_stats(
        {n: table(spark, sf, n) for n in ("orders", "events", "nation")}, ["created_at", "o_orderdate", "ts"]
    )
    return out.withColumn("latest", F.col("latest").cast("timestamp_ntz"))


@query("s11_table_size")
def size(spark, sf):
    return table_size(table(spark, sf, "lineitem"))


@query("s11_folder_size")
def listed_size(spark, sf):
    """From the listing of files alone."""
    return folder_size(spark, f"{sf}/lineitem.parquet")


@query(
    "s13_freshness",
    f"""WITH t AS (SELECT 'orders' AS table_name, MAX(o_orderdate)::DATE AS latest FROM orders
    UNION ALL SELECT 'lineitem', MAX(l_shipdate)::DATE FROM lineitem UNION ALL SELECT 'events', MAX(ts)::DATE FROM events)
    SELECT table_name, latest, CAST(CASE WHEN DATE '{AS_OF}' - latest > 14 THEN 7 ELSE DATE '{AS_OF}' - latest END AS INTEGER) AS age_days FROM t""",
)
def fresh(spark, sf):
    return freshness(
        {
            "orders": (table(spark, sf, "orders"), "o_orderdate"),
            "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
            "events": (table(spark, sf, "events"), "ts"),
        },
        AS_OF,
    )


@query("s14_latest_key_date", cte("ord") + "SELECT MAX(date) AS latest FROM ord WHERE o_orderpriority = '2-HIGH'")
def key_date(spark, sf):
    return latest_key_date(orders(spark, sf), "o_orderpriority", "2-HIGH")


@query("j06_bounds", "SELECT greatest((SELECT MAX(o_orderdate) FROM orders), (SELECT MAX(l_shipdate) FROM lineitem))::DATE AS end_date")
def bound(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    l = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return bounds({"orders": o, "lineitem": l})


NAMES = ("orders", "lineitem", "events", "nation")


@query("j06_total_records", "SELECT " + " + ".join(f"(SELECT COUNT(*) FROM {n})" for n in NAMES) + " AS total_records")
def total(spark, sf):
    return total_records({n: table(spark, sf, n) for n in NAMES})


@query(
    "a24_completeness",
    "SELECT ROUND(AVG(least(n / 1000.0::DOUBLE, 1.0)) * 100, 6) AS completeness FROM ("
    + " UNION ALL ".join(f"SELECT COUNT(*) AS n FROM {n}" for n in NAMES) + ")",
)
def completeness(spark, sf):
    return r6(completeness_score({n: table(spark, sf, n) for n in NAMES}), "completeness")


@query(
    "a25_quick_stats",
    """WITH t AS (SELECT COUNT(*) AS n, MIN(o_orderdate)::DATE AS a, MAX(o_orderdate)::DATE AS b FROM orders
    UNION ALL SELECT COUNT(*), MIN(l_shipdate)::DATE, MAX(l_shipdate)::DATE FROM lineitem)
    SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) FILTER (n > 0) AS active_tables, CAST(MAX(b) - MIN(a) AS INTEGER) AS covered_days FROM t""",
)
def quick(spark, sf):
    return quick_stats({"o": (table(spark, sf, "orders"), "o_orderdate"), "l": (table(spark, sf, "lineitem"), "l_shipdate")})


@query("a26_dataset_snapshot", "SELECT 'v1' AS data_version, COUNT(*) AS row_count, CAST(11 AS BIGINT) AS feature_count FROM lineitem")
def snapshot(spark, sf):
    return dataset_snapshot(table(spark, sf, "lineitem"), "v1")


