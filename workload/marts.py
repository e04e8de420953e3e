"""Tables kept load by load, and wide correlation matrices."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from tidemark.operators.relate import corr_matrix, cross_corr
from tidemark.plans import relevance as R
from tidemark.plans.news import landing_rows, merge_landed, upsert_raw_news
from tidemark.schemas import TOPICS
from tidemark.session import stage
from tidemark.sources.sinks import read_days, upsert_days, write_days
from tidemark.streaming.streams import stream_mart
from workload.frames import PRIORITIES, articles, cte, r6, scratch, table
from workload.news import _MERGED, _ON, _REL, _SIDES, _TOPIC, NOW, _shown, _sides
from workload.register import query
from workload.streams import _arrive, _as_news

# --- Relevance mart -------------------------------------------------------------------------------

_DAY = f"""SELECT CAST(published_at AS DATE) AS date, {', '.join(f"ROUND(AVG(CASE WHEN t = '{t}' THEN score END), 9) AS relevance_{t}" for t in TOPICS)},
    COUNT(*) AS num_articles_total FROM (SELECT *, {_TOPIC} AS t FROM articles) GROUP BY 1"""


def _loads(spark, sf):
    """Articles in three loads: a fifth of the first days comes late, with the last, which also brings the second load again."""
    a = articles(spark, sf).withColumn("url", F.concat("url", F.lit("/"), "event_id"))
    early, middle = F.col("ingest_date") <= "2024-01-12", F.col("ingest_date").between("2024-01-13", "2024-01-22")
    late = early & (F.col("event_id") % 5 == 0)
    a = a.withColumn("raw_payload", F.col("snippet"))
    return [a.filter(p).drop("event_id") for p in (early & ~late, middle, late | middle | (F.col("ingest_date") > "2024-01-22"))]


def _loaded(spark, sf):
    root = scratch(spark, "mart")
    R.create(spark, root)
    for batch in _loads(spark, sf):
        R.load(batch, root, NOW)
    return root


@query("n05_incremental_mart", cte("articles") + _DAY)
def incremental(spark, sf):
    """After three loads with late and repeated articles, each of which touched its own days only: the mart of a full rebuild."""
    return r6(R.read_mart(spark, _loaded(spark, sf)), *_REL, digits=9).select("date", *_REL, "num_articles_total")


@query(
    "x04_trailing_weeks",
    cte("articles")
    + f""", s AS (SELECT CAST(published_at AS DATE) AS d, {_TOPIC} AS t, score FROM articles), w AS (SELECT DISTINCT CAST(d + CAST(i AS INTEGER) AS DATE) AS date FROM s, generate_series(0, 6) g(i))
    SELECT date, {', '.join(f"ROUND(AVG(CASE WHEN t = '{t}' THEN score END), 9) AS relevance_{t}" for t in TOPICS)}, COUNT(*) AS num_articles_total
    FROM w JOIN s ON d BETWEEN date - 6 AND date WHERE date <= (SELECT MAX(d) FROM s) GROUP BY 1""",
)
def weeks(spark, sf):
    """Trailing weeks rolled up from sums per day and topic: every article is read once."""
    return r6(R.trailing_weeks(stage(R.day_topic_state(articles(spark, sf)), "state")), *_REL, digits=9)


@query("x04_refreshed_weeks", cte("articles") + f""", s AS (SELECT CAST(published_at AS DATE) AS d, {_TOPIC} AS t, score FROM articles), w AS (SELECT CAST(UNNEST(generate_series(DATE '2024-01-05', DATE '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT date, {', '.join(f"ROUND(AVG(CASE WHEN t = '{t}' THEN score END), 9) AS relevance_{t}" for t in TOPICS)}, COUNT(*) AS num_articles_total FROM w JOIN s ON d BETWEEN date - 6 AND date GROUP BY 1""")
def refreshed(spark, sf):
    """The trailing weeks that two touched days change, from the state's days around them."""
    touched = [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    return r6(R.refreshed_weeks(spark, _loaded(spark, sf), touched), *_REL, digits=9)


@query("x02_stream_mart", cte("articles") + _DAY)
def streamed(spark, sf):
    """The events as a stream in three loads, each a load of the mart."""
    root = scratch(spark, "stream-mart")
    R.create(spark, root)
    unique = lambda e: _as_news(e.withColumn("user_id", F.concat("user_id", F.lit("/"), "event_id")))
    _arrive(spark, sf, lambda events: stream_mart(unique(events), root, f"{root}-checkpoint", NOW))
    return r6(R.read_mart(spark, root), *_REL, digits=9).select("date", *_REL, "num_articles_total")


# --- Upserts by day -------------------------------------------------------------------------------


def _by_day(spark, held, new, name, merge):
    """``new`` merged into the days it falls on of a table that holds ``held``."""
    path = scratch(spark, name)
    write_days(held, path, "published_at")
    upsert_days(new, path, held.schema, "published_at", merge)
    return read_days(spark, path, held.schema)


@query(
    "n02_upsert_raw_news_days",
    cte("articles") + _SIDES + f"SELECT COALESCE(h.url, n.url) AS url, COALESCE(h.published_at, n.published_at) AS published_at, {_MERGED}, COALESCE(n.snippet, h.snippet) AS raw_payload {_ON}",
)
def raw_days(spark, sf):
    held, new = _sides(spark, sf)
    out = _by_day(spark, upsert_raw_news(held.limit(0), held), new, "raw-news", upsert_raw_news)
    return _shown(out).select("url", "published_at", "topic", "title", "score", "snippet", "ingest_datetime", "raw_payload")


@query(
    "n03_land_news_days",
    cte("articles") + _SIDES
    + f"SELECT substr(sha256(COALESCE(h.url, n.url) || '||' || CAST(COALESCE(h.published_at, n.published_at) AS VARCHAR)), 1, 32) AS article_id, "
    f"COALESCE(h.url, n.url) AS url, COALESCE(h.published_at, n.published_at) AS published_at, {_MERGED} {_ON}",
)
def land_days(spark, sf):
    held, new = _sides(spark, sf)
    out = _by_day(spark, landing_rows(held), landing_rows(new), "landed-news", merge_landed)
    return _shown(out).select("article_id", "url", "published_at", "topic", "title", "score", "snippet", "ingest_datetime")


# --- Wide correlations ----------------------------------------------------------------------------

NATIONS = {k: f"n_{k}" for k in range(25)}
_WIDE = [*NATIONS.values(), *PRIORITIES.values(), "same"]


def _daily_wide(spark, sf):
    """31 daily columns: orders of each nation, NULL on days without, of each priority, and one that never changes."""
    own = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    cents = lambda c: F.sum(F.when(c, F.col("o_totalprice").cast("decimal(18,2)"))).cast("double")
    return own.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        *[cents(F.col("c_nationkey") == k).alias(n) for k, n in NATIONS.items()], *[cents(F.col("o_orderpriority") == p).alias(n) for p, n in PRIORITIES.items()],
        F.lit(7.0).alias("same"))


_SUM = "CAST(SUM(CAST(CASE WHEN {} THEN o_totalprice END AS DECIMAL(18,2))) AS DOUBLE)"
_WIDE_SQL = "WITH w AS MATERIALIZED (SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(
    [f"{_SUM.format(f'c_nationkey = {k}')} AS {n}" for k, n in NATIONS.items()] + [_SUM.format(f"o_orderpriority = '{p}'") + f" AS {n}" for p, n in PRIORITIES.items()]
) + ", 7.0 AS same FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) "


def _corr_rows(pairs):
    """All pairs in one row of aggregates, then a row each."""
    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': CASE WHEN var_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND var_pop({b}) FILTER ({a} IS NOT NULL) > 0 THEN ROUND(corr({a}, {b}), 8) END}}" for a, b in pairs)
    return f", k AS (SELECT [{rows}] AS l FROM w) SELECT u.a AS a, u.b AS b, u.r AS r FROM (SELECT UNNEST(l) AS u FROM k)"


@query("a19_corr_wide", _WIDE_SQL + _corr_rows(list(combinations(_WIDE, 2))))
def wide_matrix(spark, sf):
    """465 pairs of columns with NULLs and a constant from one matrix of sums."""
    return r6(corr_matrix(stage(_daily_wide(spark, sf), "wide"), _WIDE), "r", digits=8)


@query("a20_cross_wide", _WIDE_SQL + _corr_rows([(a, b) for a in PRIORITIES.values() for b in NATIONS.values()]))
def wide_cross(spark, sf):
    return r6(cross_corr(stage(_daily_wide(spark, sf), "wide"), list(PRIORITIES.values()), list(NATIONS.values())), "r", digits=8)
