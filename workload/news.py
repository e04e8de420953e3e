"""News: normalise, upsert, land, relevance mart, profile, digest, sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.reshape import to_long
from tidemark.plans.news import (
    dedupe_news, land_news, landing_rows, news_digest, normalise_news, profile_news, relevance_by_day, relevance_mart, split_sources,
    upsert_raw_news,
)
from tidemark.schemas import TOPICS
from workload.frames import articles, cte, r6, table
from workload.register import query

NOW = "2024-02-01 00:00:00"
_TOPIC = "CASE lower(topic) WHEN 'fed' THEN 'fed_policy' WHEN 'layoffs' THEN 'layoff' WHEN 'inflation' THEN 'cpi' WHEN 'oil' THEN 'energy' ELSE lower(topic) END"


@query(
    "n01_normalise_news",
    f"""SELECT 'https://Site.example.com/a/' || event_id AS url, TIMESTAMP '{NOW}' AS ingest_datetime, event_type AS topic,
    CASE WHEN event_type = 'view' THEN 'wire' ELSE 'Site.example.com' END AS source_domain,
    CASE WHEN value >= 5 THEN date_trunc('second', ts) ELSE TIMESTAMP '{NOW}' END AS published_at, value AS score,
    CASE WHEN event_type = 'click' THEN 'long' ELSE 'short' END AS snippet FROM events WHERE event_type <> 'error'""",
)
def normalise(spark, sf):
    kind, ts = F.col("event_type"), F.col("ts").cast("timestamp")
    item = F.to_json(
        F.struct(
            F.when(kind != "error", F.concat(F.lit("https://Site.example.com/a/"), F.col("event_id"))).alias("url"),
            F.when(kind == "view", "wire").otherwise("").alias("source"),
            F.when(F.col("value") >= 5, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("published_date"),
            F.col("value").alias("score"),
            F.when(kind == "click", "long").alias("content"),
            F.lit("short").alias("snippet"),
        )
    )
    items = table(spark, sf, "events").select(kind.alias("topic"), item.alias("payload"))
    return normalise_news(items, NOW).select(
        "url", F.col("ingest_datetime").cast("timestamp_ntz").alias("ingest_datetime"), "topic", "source_domain",
        F.col("published_at").cast("timestamp_ntz").alias("published_at"), "score", "snippet",
    )


_PICK = "QUALIFY ROW_NUMBER() OVER (PARTITION BY url, published_at ORDER BY ingest_datetime DESC, topic, title NULLS LAST, snippet) = 1"
_SIDES = f""", held AS (SELECT * FROM articles WHERE ingest_date <= DATE '2024-01-20' {_PICK}),
    new AS (SELECT * FROM articles WHERE ingest_date >= DATE '2024-01-13' {_PICK}) """
_MERGED = """COALESCE(n.topic, h.topic) AS topic, COALESCE(n.title, h.title) AS title, COALESCE(n.score, h.score) AS score,
    COALESCE(n.snippet, h.snippet) AS snippet, COALESCE(n.ingest_datetime, h.ingest_datetime) AS ingest_datetime"""
_ON = "FROM held h FULL JOIN new n ON h.url = n.url AND h.published_at IS NOT DISTINCT FROM n.published_at"


def _sides(spark, sf):
    """News held up to a day, and a later fetch that brings a week of them again."""
    a = articles(spark, sf).drop("event_id").withColumn("raw_payload", F.col("snippet"))
    return a.filter(F.col("ingest_date") <= "2024-01-20"), a.filter(F.col("ingest_date") >= "2024-01-13")


def _shown(df):
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("published_at", "ingest_datetime")}
    return df.withColumns(ntz)


@query(
    "n02_upsert_raw_news",
    cte("articles") + _SIDES + f"SELECT COALESCE(h.url, n.url) AS url, COALESCE(h.published_at, n.published_at) AS published_at, {_MERGED}, COALESCE(n.snippet, h.snippet) AS raw_payload {_ON}",
)
def raw_upsert(spark, sf):
    held, new = _sides(spark, sf)
    empty = held.limit(0)
    merged = upsert_raw_news(upsert_raw_news(empty, held), new)
    return _shown(merged).select("url", "published_at", "topic", "title", "score", "snippet", "ingest_datetime", "raw_payload")


@query(
    "n03_land_news",
    cte("articles") + _SIDES
    + f"SELECT substr(sha256(COALESCE(h.url, n.url) || '||' || CAST(COALESCE(h.published_at, n.published_at) AS VARCHAR)), 1, 32) AS article_id, "
    f"COALESCE(h.url, n.url) AS url, COALESCE(h.published_at, n.published_at) AS published_at, {_MERGED} {_ON}",
)
def land(spark, sf):
    held, new = _sides(spark, sf)
    return _shown(land_news(landing_rows(held), new)).select(
        "article_id", "url", "published_at", "topic", "title", "score", "snippet", "ingest_datetime"
    )


def _mart(where: str) -> str:
    cols = ", ".join(f"AVG(CASE WHEN t = '{t}' THEN score END) AS relevance_{t}" for t in TOPICS)
    return f"SELECT date, {cols}, COUNT(*) AS num_articles_total FROM (SELECT COALESCE(CAST(published_at AS DATE), ingest_date) AS date, {_TOPIC} AS t, score FROM articles) WHERE {where} GROUP BY 1"


_REL = [f"relevance_{t}" for t in TOPICS]


@query(
    "a04_relevance_by_day",
    cte("articles") + f", m AS ({_mart('TRUE')}) SELECT date, {', '.join(f'ROUND({c}, 6) AS {c}' for c in _REL)}, num_articles_total FROM m",
)
def by_day(spark, sf):
    return r6(relevance_by_day(articles(spark, sf)), *_REL)


_WEEK = "date BETWEEN DATE '2024-01-18' AND DATE '2024-01-25'"


@query(
    "n05_relevance_mart",
    cte("articles")
    + f""", t AS ({_mart("date <= DATE '2024-01-20'")}), s AS ({_mart(_WEEK)})
    SELECT COALESCE(s.date, t.date) AS date, {', '.join(f'ROUND(CASE WHEN s.date IS NOT NULL THEN s.{c} ELSE t.{c} END, 6) AS {c}' for c in _REL)},
    COALESCE(s.num_articles_total, t.num_articles_total) AS num_articles_total, CASE WHEN t.date IS NOT NULL THEN 'kept' END AS notes,
    CASE WHEN s.date IS NOT NULL THEN TIMESTAMP '{NOW}' END AS ingest_timestamp FROM t FULL JOIN s ON s.date = t.date""",
)
def mart(spark, sf):
    a = articles(spark, sf)
    held = relevance_by_day(a.filter(F.col("published_at") < "2024-01-21")).withColumns(
        {"ingest_timestamp": F.lit(None).cast("timestamp"), "notes": F.lit("kept")}
    )
    out = r6(relevance_mart(held, a, "2024-01-25", stamp=NOW), *_REL)
    return out.withColumn("ingest_timestamp", F.col("ingest_timestamp").cast("timestamp_ntz"))


def _profile(spark, sf, part):
    a = articles(spark, sf)
    return profile_news(a.drop("event_id"), text="snippet", parts=[part])[part]


_ART = ["url", "published_at", "ingest_datetime", "ingest_date", "topic", "title", "score", "source_domain", "snippet"]


@query(
    "n06_profile_nulls",
    cte("articles")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT({c}) AS non_null_rows, COUNT(*) - COUNT({c}) AS null_rows, "
        f"ROUND((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) * 100, 6) AS null_percentage FROM articles"
        for c in _ART
    ),
)
def profile_nulls(spark, sf):
    return r6(_profile(spark, sf, "nulls"), "null_percentage")


@query("n06_profile_domains", cte("articles") + "SELECT source_domain, COUNT(*) AS n FROM articles GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def profile_domains(spark, sf):
    return _profile(spark, sf, "domains")


@query("n06_profile_topics", cte("articles") + "SELECT topic, COUNT(*) AS n FROM articles GROUP BY 1")
def profile_topics(spark, sf):
    return _profile(spark, sf, "topics")


@query("n06_profile_dates", cte("articles") + "SELECT MIN(published_at) AS first, MAX(published_at) AS last FROM articles")
def profile_dates(spark, sf):
    return _profile(spark, sf, "dates").select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first", "last")])


@query(
    "n06_profile_lengths",
    """SELECT 'content_len' AS column_name, COUNT(l) AS n, ROUND(AVG(l), 6) AS mean, ROUND(stddev_samp(l), 6) AS std, CAST(MIN(l) AS DOUBLE) AS min,
    quantile_cont(l, 0.25) AS p25, quantile_cont(l, 0.5) AS p50, quantile_cont(l, 0.75) AS p75, CAST(MAX(l) AS DOUBLE) AS max
    FROM (SELECT CAST(length(text) AS DOUBLE) AS l FROM documents)""",
)
def profile_lengths(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("source_domain"), F.col("lang").alias("topic"), F.lit(None).cast("timestamp").alias("published_at"), "text"
    )
    return r6(profile_news(docs, text="text")["lengths"], "mean", "std")


@query(
    "n07_dedupe_news",
    cte("articles")
    + "SELECT url, event_id, substr(sha256(url || '||' || COALESCE(title, '')), 1, 32) AS article_id FROM articles "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY ingest_datetime DESC, event_id) = 1",
)
def dedup(spark, sf):
    return dedupe_news(articles(spark, sf), "ingest_datetime", "event_id").select("url", "event_id", "article_id")


@query(
    "n08_news_digest",
    cte("articles")
    + """, n AS (SELECT * FROM articles WHERE published_at BETWEEN TIMESTAMP '2024-01-25' - INTERVAL 20 DAY AND TIMESTAMP '2024-01-25'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY published_at DESC, event_id) <= 50)
    SELECT topic, COUNT(*) AS n_articles, string_agg(concat_ws(' | ', strftime(published_at, '%Y-%m-%d %H:%M:%S'), topic, title, snippet), chr(10) ORDER BY published_at DESC, event_id) AS digest
    FROM n GROUP BY 1""",
)
def digest(spark, sf):
    return news_digest(articles(spark, sf), "2024-01-25", 50, "topic", 20, ties=("event_id",))


@query("n09_source_dimension", cte("articles") + "SELECT DISTINCT substr(sha256(source_domain), 1, 16) AS source_id, source_domain FROM articles")
def sources(spark, sf):
    return split_sources(articles(spark, sf))[0]


@query("n09_article_fact", cte("articles") + "SELECT event_id, url, substr(sha256(source_domain), 1, 16) AS source_id FROM articles")
def fact(spark, sf):
    return split_sources(articles(spark, sf))[1].select("event_id", "url", "source_id")


@query(
    "n05_relevance_long",
    cte("articles") + f", m AS ({_mart('TRUE')}) SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT date, '{c}' AS topic, ROUND({c}, 6) AS score FROM m" for c in _REL) + ") WHERE score IS NOT NULL",
)
def relevance_long(spark, sf):
    return r6(to_long(relevance_by_day(articles(spark, sf)), "date", _REL, "topic", "score"), "score")
