"""Streams equal their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from tidemark.plans.news import upsert_raw_news
from tidemark.schemas import schema
from tidemark.sources.sinks import read_current, write_overwrite
from tidemark.streaming.streams import stream_append, stream_dedupe, stream_relevance, stream_source, stream_upsert


def article(url, published, title, ingest):
    return (ingest, ingest.date(), "cpi", title, url, "d", published, 1.0, None, "{}")


def test_files_are_read_once_and_upserts_accumulate(spark, tmp_path):
    ddl = schema("raw.news")
    source, table, point = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "cp")
    write_overwrite(spark.createDataFrame([], ddl), table)
    t = dt.datetime(2024, 1, 1)
    loads = [
        [article("a", t, "a", t), article("b", None, "b", t)],
        [article("a", t, None, t + dt.timedelta(days=1)), article("c", t, "c", t + dt.timedelta(days=1))],
    ]
    want = spark.createDataFrame([], ddl)
    for load in loads:
        batch = spark.createDataFrame(load, ddl)
        batch.coalesce(1).write.mode("append").parquet(source)
        stream_upsert(stream_source(spark, source, ddl), table, point).awaitTermination()
        want = upsert_raw_news(want, batch)
        assert rows(read_current(spark, table)) == rows(want)
    versions = len(list((tmp_path / "table").glob("snapshot=*")))
    stream_upsert(stream_source(spark, source, ddl), table, point).awaitTermination()
    assert len(list((tmp_path / "table").glob("snapshot=*"))) == versions


def test_windows_equal_batch_once_closed(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(hours=5 * i), "FOMC" if i % 2 else "jobs", float(i)) for i in range(60)]
    ddl = "ts TIMESTAMP, topic STRING, score DOUBLE"
    df = spark.createDataFrame(data, ddl)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    end = max(r[0] for r in data) - dt.timedelta(days=1)
    for i, slide in enumerate([None, "1 day"]):
        window = "7 days" if slide else "1 day"
        stream = stream_relevance(stream_source(spark, str(tmp_path / "in"), ddl), "1 day", window, slide)
        out = str(tmp_path / f"out{i}")
        stream_append(stream, out, str(tmp_path / f"cp{i}")).awaitTermination()
        batch = stream_relevance(df, "1 day", window, slide).filter(F.col("window_end") <= end)
        assert rows(spark.read.schema(stream.schema).parquet(out)) == rows(batch) and batch.count()


def test_dedupe(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    ddl = "ts TIMESTAMP, url STRING"
    spark.createDataFrame([(t, "a"), (t, "a"), (t, "b")], ddl).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream_append(stream_dedupe(stream_source(spark, str(tmp_path / "in"), ddl)), out, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(out), "url") == [("a",), ("b",)]


def test_dedupe_does_not_depend_on_batches(spark, tmp_path):
    t, ddl, loads = dt.datetime(2024, 1, 1), "ts TIMESTAMP, url STRING", 4
    for name, watermark in (("all", None), ("near", "1 day")):
        source, out, point = (str(tmp_path / f"{name}-{x}") for x in ("in", "out", "cp"))
        for i in range(loads):
            late = t + dt.timedelta(days=2 * i)
            spark.createDataFrame([(late, "a"), (late, "a"), (late, f"u{i}")], ddl).write.mode("append").parquet(source)
            stream_append(stream_dedupe(stream_source(spark, source, ddl), watermark=watermark), out, point).awaitTermination()
        given = rows(spark.read.parquet(out), "url", "ts")
        assert {u for u, _ in given} == {"a", *(f"u{i}" for i in range(loads))}
        times = [at for u, at in given if u == "a"]
        assert len(times) == 1 if watermark is None else all(b - a > dt.timedelta(days=1) for a, b in zip(times, times[1:]))
