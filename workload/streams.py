"""Streaming twins. The events arrive in three loads; after each the stream runs until it has read all files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.rolling import with_lags
from tidemark.plans.news import upsert_raw_news
from tidemark.sources.sinks import read_days, write_days
from tidemark.streaming.streams import stream_append, stream_dedupe, stream_relevance, stream_source, stream_upsert, with_event_time
from workload.frames import EVENT_TOPICS, articles, cte, mapped, r6, scratch, table
from workload.register import query


def _arrive(spark, sf, run):
    """Lands the events by thirds of their time range in one folder and calls ``run`` with the stream of it after each."""
    e, folder = table(spark, sf, "events"), scratch(spark, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min(at), F.max(at)).first()
    load = F.lit(0) if first is None else F.floor((at - first) * 3 / (last - first + 1))
    for i in range(3):
        e.filter(load == i).write.mode("append").parquet(folder)
        run(stream_source(spark, folder, e.schema)).awaitTermination()


def _landed(spark, sf, make, name):
    """What the stream that ``make`` derives from the events has appended after the last load."""
    path, made = scratch(spark, name), []

    def run(events):
        made.append(make(events))
        return stream_append(made[-1], path, f"{path}-checkpoint")

    _arrive(spark, sf, run)
    return spark.read.schema(made[-1].schema).parquet(path)


@query("x01_file_ingest", "SELECT * FROM events")
def ingest(spark, sf):
    return _landed(spark, sf, lambda events: events, "x01")


def _as_news(e):
    topic = mapped("event_type", EVENT_TOPICS)
    ts = F.col("ts").cast("timestamp")
    return e.select(
        ts.alias("ingest_datetime"), ts.cast("date").alias("ingest_date"), topic.alias("topic"),
        F.when(F.col("value") >= 5, F.concat(F.lit("Article "), F.col("event_id"))).alias("title"),
        F.concat(F.lit("https://site/"), F.col("user_id")).alias("url"), F.lit("site").alias("source_domain"),
        F.date_trunc("day", ts).alias("published_at"), F.col("value").alias("score"), F.col("props").alias("snippet"),
        F.col("props").alias("raw_payload"),
    )


@query(
    "x02_stream_upsert",
    cte("articles")
    + """, b AS (SELECT *, (epoch_us(ingest_datetime) - MIN(epoch_us(ingest_datetime)) OVER ()) * 3
        // (MAX(epoch_us(ingest_datetime)) OVER () - MIN(epoch_us(ingest_datetime)) OVER () + 1) AS load FROM articles),
    w AS (SELECT * FROM b QUALIFY ROW_NUMBER() OVER (PARTITION BY url, published_at, load ORDER BY ingest_datetime DESC, topic, title NULLS LAST, snippet) = 1)
    SELECT 'https://site/' || split_part(url, '/', 5) AS url, published_at, arg_max(title, load) FILTER (title IS NOT NULL) AS title,
    arg_max(score, load) FILTER (score IS NOT NULL) AS score FROM w GROUP BY url, published_at""",
)
def upserts(spark, sf):
    path = scratch(spark, "x02")
    kind = _as_news(table(spark, sf, "events")).schema
    write_days(spark.createDataFrame([], kind), path, "published_at")
    _arrive(spark, sf, lambda events: stream_upsert(_as_news(events), path, f"{path}-checkpoint", upsert_raw_news, "published_at"))
    out = read_days(spark, path, kind)
    return out.select("url", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "title", "score")


def _topics(events):
    return events.select("ts", mapped("event_type", EVENT_TOPICS).alias("topic"), F.col("value").alias("score"))


def _shown(df):
    return r6(df, "avg_score").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_TOPIC = "CASE lower(topic) WHEN 'fed' THEN 'fed_policy' WHEN 'layoffs' THEN 'layoff' WHEN 'inflation' THEN 'cpi' WHEN 'oil' THEN 'energy' ELSE lower(topic) END"
_CLOSED = " WHERE window_end <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events)"


@query(
    "x03_tumbling_relevance",
    cte("articles")
    + f"""SELECT * FROM (SELECT published_at AS window_start, published_at + INTERVAL 1 DAY AS window_end, {_TOPIC} AS topic,
    ROUND(AVG(score), 6) AS avg_score, COUNT(*) AS n_articles FROM articles GROUP BY 1, 2, 3)""" + _CLOSED,
)
def tumbling(spark, sf):
    return _shown(_landed(spark, sf, lambda events: stream_relevance(_topics(events)), "x03"))


@query(
    "x04_sliding_relevance",
    cte("articles")
    + f""", s AS (SELECT UNNEST(generate_series(published_at - INTERVAL 6 DAY, published_at, INTERVAL 1 DAY)) AS window_start, {_TOPIC} AS topic, score FROM articles)
    SELECT * FROM (SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, topic, ROUND(AVG(score), 6) AS avg_score, COUNT(*) AS n_articles FROM s GROUP BY 1, 2, 3)"""
    + _CLOSED,
)
def sliding(spark, sf):
    return _shown(_landed(spark, sf, lambda events: stream_relevance(_topics(events), window="7 days", slide="1 day"), "x04"))


def _visits(events):
    return with_event_time(events).select("ts", F.concat(F.lit("https://site/"), F.col("user_id")).alias("url"))


@query("x05_dedupe", "SELECT DISTINCT 'https://site/' || user_id AS url FROM events")
def suppressed(spark, sf):
    return _landed(spark, sf, lambda events: stream_dedupe(_visits(events)), "x05").select("url")


@query("x05_dedupe_watermark", "SELECT COUNT(DISTINCT user_id) AS urls, CAST(0 AS BIGINT) AS close_pairs FROM events")
def suppressed_within(spark, sf):
    """No key is lost, and rows given for a key lie over a day apart."""
    given = _landed(spark, sf, lambda events: stream_dedupe(_visits(events), watermark="1 day"), "x05-watermark")
    before = with_lags(given, "ts", "ts", [1], "url")
    near = F.col("ts") <= F.col("ts__lag_1") + F.expr("INTERVAL 1 DAY")
    return before.agg(F.count_distinct("url").alias("urls"), F.count_if(near).alias("close_pairs"))


@query("x05_dedupe_batch", "SELECT DISTINCT 'https://site/' || user_id AS url FROM events")
def suppressed_batch(spark, sf):
    keyed = articles(spark, sf).select(F.col("ingest_datetime").alias("ts"), F.concat(F.lit("https://site/"), F.split("url", "/")[4]).alias("url"))
    return stream_dedupe(keyed).select("url")
