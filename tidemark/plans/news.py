"""News: normalise, upsert, land, score by day, profile, digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tidemark.functions.dates import safe_ts
from tidemark.functions.payload import json_map, published_at
from tidemark.functions.text import article_id, text_len, topic_norm, url_host_token
from tidemark.operators.merge import dedupe, upsert
from tidemark.operators.ordered import names
from tidemark.operators.profile import describe_long, null_profile, top_values, value_counts
from tidemark.operators.rolling import top_n_per_key
from tidemark.operators.select import news_valid
from tidemark.schemas import TOPICS

CONTENT = ["topic", "title", "source_domain", "score", "snippet"]


def _text(c):
    return F.when(c != "", c)


def normalise_news(items: DataFrame, now, payload: str = "payload", topic: str = "topic") -> DataFrame:
    """Search results (topic, JSON payload) -> raw news rows; results without a url are dropped."""
    found = items.withColumn("__item", json_map(payload)).withColumn("url", F.col("__item")["url"])
    stamp = F.lit(now).cast("timestamp")
    item = F.col("__item")
    return news_valid(found).select(
        stamp.alias("ingest_datetime"),
        stamp.cast("date").alias("ingest_date"),
        F.col(topic).alias("topic"),
        item["title"].alias("title"),
        "url",
        F.coalesce(_text(item["source"]), url_host_token("url")).alias("source_domain"),
        F.coalesce(published_at(payload), stamp).alias("published_at"),
        item["score"].try_cast("double").alias("score"),
        F.coalesce(_text(item["content"]), item["snippet"]).alias("snippet"),
        F.col(payload).alias("raw_payload"),
    )


def upsert_raw_news(target: DataFrame, source: DataFrame) -> DataFrame:
    """MERGE on url and publish time; content is kept where the source has none."""
    one = dedupe(source, ["url", "published_at"], "ingest_datetime", ["topic", "title", "snippet"])
    return upsert(
        target, one, ["url", "published_at"], CONTENT, ["ingest_datetime", "ingest_date", "raw_payload"], ["url"]
    )


def landing_rows(raw: DataFrame) -> DataFrame:
    """Raw news in landing form: publish time normalised, one row per url and publish time.

    The key uses the publish time as delivered, so a row that falls back to its ingest time does not
    come back as a new article when it is ingested again.
    """
    one = dedupe(raw, ["url", "published_at"], "ingest_datetime", ["topic", "title", "snippet"])
    return one.select(
        article_id("url", F.col("published_at").cast("string")).alias("article_id"),
        "topic", "title", "url", "source_domain",
        safe_ts("published_at", "ingest_datetime").alias("published_at"),
        F.col("score").cast("double").alias("score"),
        "snippet", "ingest_datetime", "ingest_date",
    )


def merge_landed(target: DataFrame, landed: DataFrame) -> DataFrame:
    """MERGE of rows that are in landing form already."""
    return upsert(
        target, dedupe(landed, ["url", "published_at"], "ingest_datetime", "article_id"),
        ["url", "published_at"], CONTENT, ["ingest_datetime", "ingest_date"], ["url"],
    )


def land_news(target: DataFrame, raw: DataFrame) -> DataFrame:
    return merge_landed(target, landing_rows(raw))


def relevance_by_day(news: DataFrame, topics=TOPICS) -> DataFrame:
    """Mean score per day and listed topic, and the count of all articles of the day.

    Topics without a column count too. Day and topic means come from one grouping by day: sums and
    counts per topic are combined on the map side, so a hot day or topic is no bottleneck.
    """
    topic = F.col("__topic")
    day = F.coalesce(F.col("published_at").cast("date"), F.col("ingest_date"))
    tagged = news.select(day.alias("date"), topic_norm("topic").alias("__topic"), "score")
    return tagged.groupBy("date").agg(
        *[F.avg(F.when(topic == t, F.col("score"))).alias(f"relevance_{t}") for t in topics],
        F.count(F.lit(1)).alias("num_articles_total"),
    )


def relevance_mart(target: DataFrame, news: DataFrame, as_of, days: int = 7, stamp=None, topics=TOPICS) -> DataFrame:
    """Score the days from ``as_of - days`` to ``as_of`` and upsert them; other columns keep their value."""
    day = F.coalesce(F.col("published_at").cast("date"), F.col("ingest_date"))
    end = F.lit(as_of).cast("date")
    recent = news.filter(day.between(F.date_sub(end, days), end))
    kind = news.schema["published_at"].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        # The same range on the plain columns, which scans can use to skip files.
        first, past = F.date_sub(end, days), F.date_add(end, 1)
        known = (F.col("published_at") >= first.cast(kind)) & (F.col("published_at") < past.cast(kind))
        recent = recent.filter(known | (F.col("published_at").isNull() & F.col("ingest_date").between(first, end)))
    scored = relevance_by_day(recent, topics).withColumn(
        "ingest_timestamp", F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp()
    )
    return upsert(target, scored, "date", overwrite_cols=[c for c in scored.columns if c != "date"])


def profile_news(df: DataFrame, text: str = "content", parts=("nulls", "domains", "topics", "dates", "lengths")) -> dict[str, DataFrame]:
    """Null shares, top domains, topic counts, date range and text lengths of a corpus; only the parts asked for are built."""
    build = {
        "nulls": lambda: null_profile(df, skip=()),
        "domains": lambda: top_values(df, "source_domain", 20),
        "topics": lambda: value_counts(df, "topic"),
        "dates": lambda: df.agg(F.min("published_at").alias("first"), F.max("published_at").alias("last")),
        "lengths": lambda: describe_long(df.select(text_len(text).alias("content_len")), ["content_len"]),
    }
    return {part: build[part]() for part in parts}


def dedupe_news(df: DataFrame, order: str, ties=()) -> DataFrame:
    """One row per url, with an id from url and title."""
    return dedupe(df, "url", order, ties).withColumn("article_id", article_id("url", "title"))


def news_digest(df: DataFrame, as_of, n: int = 50, key="topic", days: int = 30, ties=("title",)) -> DataFrame:
    """One text per group: its newest n articles of the last ``days`` days, newest first."""
    keys = names(key)
    end = F.lit(as_of).cast("timestamp")
    recent = df.filter((F.col("published_at") >= end - F.make_interval(days=F.lit(days))) & (F.col("published_at") <= end))
    newest = top_n_per_key(recent, keys, [F.col("published_at").desc(), *[F.col(t).asc() for t in ties]], n)
    line = F.concat_ws(" | ", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"), "topic", "title", "snippet")
    # At most n rows per group reach this list.
    lines = F.array_sort(
        F.collect_list(F.struct((-F.unix_micros("published_at")).alias("age"), *ties, line.alias("line")))
    )
    return newest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_articles"), F.array_join(F.transform(lines, lambda r: r["line"]), "\n").alias("digest")
    )


def split_sources(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source dimension (id from the domain) and article fact that points to it."""
    source_id = F.substring(F.sha2(F.coalesce(F.col("source_domain"), F.lit("")), 256), 1, 16)
    dimension = df.select("source_domain").distinct().select(source_id.alias("source_id"), "source_domain")
    fact = df.withColumn("source_id", source_id).drop("source_domain")
    return dimension, fact
