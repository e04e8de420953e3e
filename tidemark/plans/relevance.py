"""The relevance mart built load by load: sums per day and topic in a table, from which days and trailing weeks are rolled up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.text import topic_norm
from tidemark.operators.merge import upsert
from tidemark.operators.select import news_valid
from tidemark.plans.news import landing_rows, merge_landed
from tidemark.schemas import TOPICS, schema
from tidemark.session import stage
from tidemark.sources.sinks import read_days, upsert_days, write_days

NEWS, STATE, MART = "landing.news", "landing.relevance_state", "landing.relevance"


def day_topic_state(news: DataFrame) -> DataFrame:
    """Sum and number of scores, and number of articles, per day of publication and normalised topic."""
    tagged = news.select(F.col("published_at").cast("date").alias("date"), topic_norm("topic").alias("topic"), F.col("score").cast("double").alias("score"))
    return tagged.groupBy("date", "topic").agg(
        F.sum("score").alias("score_sum"), F.count("score").alias("score_count"), F.count(F.lit(1)).alias("articles"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows together, from states of disjoint sets of rows."""
    whole = states[0]
    for state in states[1:]:
        whole = whole.unionByName(state)
    return whole.groupBy("date", "topic").agg(*[F.sum(c).alias(c) for c in ("score_sum", "score_count", "articles")])


def rolled_up(state: DataFrame, topics=TOPICS) -> DataFrame:
    """Mean score per day and listed topic, and the count of all articles, as ``relevance_by_day`` has them."""
    own = lambda t, c: F.sum(F.when(F.col("topic") == t, F.col(c)))
    return state.groupBy("date").agg(
        *[F.try_divide(own(t, "score_sum"), own(t, "score_count")).alias(f"relevance_{t}") for t in topics], F.sum("articles").alias("num_articles_total"))


def trailing_weeks(state: DataFrame, days: int = 7, topics=TOPICS, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The same over the ``days`` days up to each day, for the days from ``first`` to ``last`` (by default those of the state) that
    have an article in their window. A state row counts in ``days`` days, so sums of days, not articles, are multiplied."""
    ahead = state.filter("date IS NOT NULL").withColumn("date", F.explode(F.sequence("date", F.date_add("date", days - 1))))
    end = F.lit(last).cast("date") if last else state.agg(F.max("date").alias("d")).scalar()
    shown = ahead.filter(F.col("date") <= end)
    return rolled_up(shown if first is None else shown.filter(F.col("date") >= F.lit(first).cast("date")), topics)


def create(spark: SparkSession, root: str) -> None:
    """Empty tables of articles, state and mart, in folders by day."""
    for name, kind, by in (("news", NEWS, "published_at"), ("state", STATE, "date"), ("mart", MART, "date")):
        write_days(spark.createDataFrame([], schema(kind)), f"{root}/{name}", by)


def load(batch: DataFrame, root: str, stamp=None, topics=TOPICS) -> list:
    """One load of raw news into the tables under ``root``; the days it touched.

    Articles are merged into the days they were published on. The state of these days, and only of these, is counted anew
    from their articles, so a changed or repeated article counts once and a late one changes one day. The mart's
    rows of these days are replaced; its other columns (notes) keep their values. Every step may be repeated: a load
    that died is simply run again. Articles without a url are dropped, as they could not be told from their repeats. Articles without a time of publication and of ingest have a folder, but no day in the mart.
    """
    spark = batch.sparkSession
    days = upsert_days(landing_rows(news_valid(batch)), f"{root}/news", schema(NEWS), "published_at", merge_landed)
    if not days:
        return days
    state = stage(day_topic_state(read_days(spark, f"{root}/news", schema(NEWS), days)), "day-state")
    write_days(state, f"{root}/state", "date", "overwrite")
    when = F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp()
    scored = rolled_up(state.filter("date IS NOT NULL"), topics).withColumn("ingest_timestamp", when)
    upsert_days(scored, f"{root}/mart", schema(MART), "date", lambda held, new: upsert(held, new, "date", overwrite_cols=[c for c in new.columns if c != "date"]))
    return days


def read_state(spark: SparkSession, root: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The state, or its days from ``first`` to ``last``: other folders are not read."""
    return read_days(spark, f"{root}/state", schema(STATE), None if first is None or last is None else [first + dt.timedelta(i) for i in range((last - first).days + 1)])


def refreshed_weeks(spark: SparkSession, root: str, days: list, span: int = 7, topics=TOPICS) -> DataFrame:
    """Trailing weeks that a load changed: of each touched day and of the ``span - 1`` days after it, from the state's days
    around them."""
    known = sorted(d for d in days if d is not None)
    wanted = sorted({d + dt.timedelta(i) for d in known for i in range(span)})
    needed = sorted({d - dt.timedelta(i) for d in wanted for i in range(span)})
    state = read_days(spark, f"{root}/state", schema(STATE), needed)
    return trailing_weeks(state, span, topics, last=wanted[-1] if wanted else None).filter(F.col("date").isin(wanted))


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    return read_days(spark, f"{root}/mart", schema(MART))
