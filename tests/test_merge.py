import datetime as dt
import re

from pyspark.sql import functions as F

from helpers import day, rows
from tidemark.operators.merge import dedupe, incremental, upsert
from tidemark.plans import news as P
from tidemark.schemas import schema
from tidemark.sources.sinks import read_days, upsert_days, write_days

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def article(url, published=None, title=None, ingest=T0, topic="cpi", score=1.0):
    return (ingest, ingest.date(), topic, title, url, "d", published, score, None, "{}")


def frame(spark, *articles):
    return spark.createDataFrame(list(articles), schema("raw.news"))


def test_upsert_matches_null_times_and_keeps_known_titles(spark):
    held = frame(spark, article("a", None, "old"), article("b", T0, "kept"))
    new = frame(spark, article("a", None, None, T1, score=2.0), article("c", T1, "c", T1), article("b", None, "b2", T1))
    out = rows(P.upsert_raw_news(held, new), "url", "published_at", "title", "score", "ingest_datetime")
    assert out == rows(
        spark.createDataFrame(
            [("a", None, "old", 2.0, T1), ("b", None, "b2", 1.0, T1), ("b", T0, "kept", 1.0, T0), ("c", T1, "c", 1.0, T1)],
            "url STRING, published_at TIMESTAMP, title STRING, score DOUBLE, ingest_datetime TIMESTAMP",
        )
    )


def test_upsert_twice_is_upsert_once(spark):
    held = frame(spark, article("a", T0, "x"))
    new = frame(spark, article("a", T0, "y", T1), article("z", T0, "z", T1), article("z", T0, "z0", T0))
    once = P.upsert_raw_news(held, new)
    assert rows(P.upsert_raw_news(once, new)) == rows(once)


def test_null_urls_never_match(spark):
    held = frame(spark, article(None, T0, "a"), article(None, T0, "b"))
    new = frame(spark, article(None, T0, "c", T1))
    assert P.upsert_raw_news(held, new).count() == 3


def test_empty_source_changes_nothing(spark):
    held = frame(spark, article("a", T0, "x"), article("b", None, None))
    assert rows(P.upsert_raw_news(held, held.limit(0))) == rows(held)


def test_many_rows_of_one_key(spark):
    hot = spark.range(20000).select(
        F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v")
    ).union(spark.createDataFrame([("x", 1, 2)], "k STRING, t LONG, v LONG"))
    assert rows(dedupe(hot, "k", "t")) == [("hot", 19999, 39998), ("x", 1, 2)]


def test_upsert_other_columns_keep_their_value(spark):
    held = spark.createDataFrame([(1, 10, "note")], "d INT, n INT, notes STRING")
    new = spark.createDataFrame([(1, 11), (2, 12)], "d INT, n INT")
    assert rows(upsert(held, new, "d", overwrite_cols="n")) == [(1, 11, "note"), (2, 12, None)]


def test_incremental(spark):
    ddl = "k STRING, date DATE"
    held = spark.createDataFrame([("a", day("2024-01-10")), ("a", day("2024-01-05")), (None, day("2024-01-01"))], ddl)
    new = spark.createDataFrame(
        [("a", day("2024-01-09")), ("a", day("2024-01-10")), ("a", day("2024-01-11")), (None, day("2024-01-02")),
         ("b", day("2023-01-01")), ("b", day("2024-01-11"))], ddl,
    )
    everything = rows(incremental(new, held, "k"))
    assert everything == [(None, day("2024-01-02")), ("a", day("2024-01-11")), ("b", day("2023-01-01")), ("b", day("2024-01-11"))]
    assert rows(incremental(new, held, "k", overlap_days=7)) == everything
    assert ("b", day("2023-01-01")) not in rows(incremental(new, held, "k", default_days=30))
    assert rows(incremental(new, new, "k")) == []


def test_relevance_mart_keeps_notes(spark):
    news = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 5, 9), "FOMC", 1.0), ("b", dt.datetime(2024, 1, 5, 10), "fed", 3.0), ("c", dt.datetime(2024, 1, 6), "weather", 1.0),
         ("d", dt.datetime(2023, 1, 6), "cpi", 1.0), ("e", None, "cpi", 2.0)],
        "url STRING, published_at TIMESTAMP, topic STRING, score DOUBLE",
    ).withColumn("ingest_date", F.lit("2024-01-06").cast("date"))
    held = spark.createDataFrame(
        [(day("2024-01-05"), *([None] * 7), 9, None, "mine"), (day("2023-12-01"), *([0.5] * 7), 1, None, "old")], schema("landing.relevance")
    )
    out = {r.date: r for r in P.relevance_mart(held, news, "2024-01-07", stamp="2024-01-07").collect()}
    assert set(out) == {day("2023-12-01"), day("2024-01-05"), day("2024-01-06")}
    first, second = out[day("2024-01-05")], out[day("2024-01-06")]
    assert (first.relevance_fed_policy, first.num_articles_total, first.notes) == (2.0, 2, "mine")
    assert (second.relevance_cpi, second.num_articles_total, second.notes) == (2.0, 2, None)
    assert out[day("2023-12-01")].relevance_cpi == 0.5


def test_landing_is_stable_when_a_row_without_time_returns(spark):
    first, again = frame(spark, article("a", None, "t", T0)), frame(spark, article("a", None, "t", T1))
    ids = {P.landing_rows(f).first().article_id for f in (first, again)}
    assert len(ids) == 1


def test_digest_is_capped_and_newest_first(spark):
    items = spark.range(500).select(
        F.lit("cpi").alias("topic"), F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("title"), F.lit("s").alias("snippet"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("published_at"),
    )
    row = P.news_digest(items, "2024-01-20", 5, "topic").first()
    lines = row.digest.split("\n")
    assert row.n_articles == 5 and lines[0].startswith("2024-01-20 00:00:00 | cpi | t0456 | s") and lines[4].startswith("2024-01-19 20")


def test_mart_prunes_old_news_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "news")
    frame(spark, article("a", T0), article("b", None), article("c", dt.datetime(2020, 1, 1))).write.parquet(path)
    held = spark.createDataFrame([], schema("landing.relevance"))
    mart = P.relevance_mart(held, spark.read.parquet(path), "2024-01-02")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.split("PushedFilters")[1:] if "GreaterThanOrEqual(published_at" in line]
    assert pushed and rows(mart, "date", "num_articles_total") == [(T0.date(), 2)]


def test_upsert_reads_and_replaces_touched_days_only(spark, tmp_path):
    path, kind = str(tmp_path / "days"), schema("raw.news")
    days = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    held = frame(spark, *[article("a", d, "old") for d in days], article("n", None, "old"))
    write_days(held, path, "published_at")
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").glob("*=2024-01-0[134]/*.parquet")}
    new = frame(spark, article("a", days[1], "new", T1), article("z", days[1], "z", T1), article("n", None, "late", T1))
    upsert_days(new, path, kind, "published_at", P.upsert_raw_news)
    assert rows(read_days(spark, path, kind)) == rows(P.upsert_raw_news(held, new))
    assert len(kept) == 3 and kept == {f: f.stat().st_mtime_ns for f in kept if f.exists()}
    plan = read_days(spark, path, kind, [T1.date(), None])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*partition_day#", plan), plan
    assert rows(read_days(spark, path, kind, [days[3].date()]), "title") == [("old",)]
    upsert_days(new.limit(0), path, kind, "published_at", P.upsert_raw_news)
    assert read_days(spark, path, kind).count() == 6
