"""Ingest, upsert, windowed relevance and duplicate suppression on streams.

Each function equals its batch twin on the data the watermark has closed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.text import topic_norm
from tidemark.plans.news import upsert_raw_news
from tidemark.plans.relevance import load as load_mart
from tidemark.sources.sinks import is_snapshot_table, read_current, upsert_days, write_overwrite


def stream_source(spark: SparkSession, folder: str, table_schema: StructType | str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """New files of a folder; the query's checkpoint remembers the files already read."""
    reader = spark.readStream.schema(table_schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(folder)


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need an instant: zone-less timestamps are read as UTC, the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_upsert(
    df: DataFrame, table: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame] = upsert_raw_news,
    by: str | None = "published_at",
) -> StreamingQuery:
    """Merge each micro-batch into a table: into the days of ``by`` that its rows fall on, for a table kept in folders
    by day, which is the default. A table that is kept in snapshots, or any with ``by=None``, is written anew as a whole. The merge is idempotent, so a batch that is
    run again after a failure leaves the same table."""

    def apply(batch: DataFrame, _: int) -> None:
        if by is not None and not is_snapshot_table(batch.sparkSession, table):
            upsert_days(batch, table, df.schema, by, merge)
        else:
            write_overwrite(merge(read_current(batch.sparkSession, table), batch), table)

    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_mart(df: DataFrame, root: str, checkpoint: str, stamp=None) -> StreamingQuery:
    """Each micro-batch of raw news as a load of the relevance mart under ``root``: only the days it falls on are read and
    replaced. A batch that is run again leaves the same tables."""

    def apply(batch: DataFrame, _: int) -> None:
        load_mart(batch, root, stamp)

    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_relevance(df: DataFrame, watermark: str = "1 day", window: str = "1 day", slide: str | None = None, ts: str = "ts") -> DataFrame:
    """Mean score and count per topic and time window: tumbling, or sliding when ``slide`` is given."""
    timed = with_event_time(df, ts).withColumn("topic", topic_norm("topic"))
    if df.isStreaming:
        timed = timed.withWatermark(ts, watermark)
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return timed.groupBy(span.alias("w"), "topic").agg(
        F.avg("score").alias("avg_score"), F.count(F.lit(1)).alias("n_articles")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "topic", "avg_score", "n_articles")


def stream_dedupe(df: DataFrame, key="url", watermark: str | None = None, ts: str = "ts") -> DataFrame:
    """One row per key, the same keys however the stream is cut into batches; the state holds every key seen.

    With a watermark the state stays small and the promise is less: two rows given for a key lie further apart than
    the watermark, and no key goes missing unless all its rows come late. A key may be given again after that.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = with_event_time(df, ts)
    if not df.isStreaming or watermark is None:
        return timed.dropDuplicates(keys)
    return timed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)
