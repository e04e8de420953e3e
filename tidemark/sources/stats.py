"""Table statistics, freshness, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.numbers import greatest_strict
from tidemark.sources.readers import inventory


def stack_frames(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _latest(df: DataFrame, candidates) -> Column:
    """Latest value of the first candidate column that holds one."""
    present = [F.max(F.col(c).cast("timestamp")) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("timestamp")


# Columns that may carry a table's time, in order of preference.
TIME_COLUMNS = ["ingest_timestamp", "timestamp", "created_at", "updated_at", "date"]


def table_stats(frames: dict[str, DataFrame], candidates=TIME_COLUMNS) -> DataFrame:
    """Row count and latest time per table, one aggregate pass each."""
    return stack_frames(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), _latest(df, candidates).alias("latest"))
            .select(F.lit(name).alias("table_name"), "row_count", "latest")
            for name, df in frames.items()
        ]
    )


def table_size(df: DataFrame) -> DataFrame:
    """Size of a file-backed table in MB, two decimals, from file metadata."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.round(F.coalesce(F.sum("file_size"), F.lit(0)) / (1024 * 1024), 2).alias("size_mb"))


def folder_size(spark: SparkSession, folder: str) -> DataFrame:
    """Number of files and size in MB, two decimals, of a table's folder or file: names and sizes are listed, no row is read."""
    return inventory(spark, folder).agg(F.count(F.lit(1)).alias("files"), F.round(F.coalesce(F.sum("size"), F.lit(0)) / (1024 * 1024), 2).alias("size_mb"))


def freshness(frames: dict[str, tuple[DataFrame, str]], as_of, cap: bool = True) -> DataFrame:
    """Latest date and age in days; with ``cap`` an age above 14 days shows as 7."""
    rows = stack_frames(
        [
            df.agg(F.max(F.col(c).cast("date")).alias("latest")).select(F.lit(name).alias("table_name"), "latest")
            for name, (df, c) in frames.items()
        ]
    )
    age = F.datediff(F.lit(as_of).cast("date"), "latest")
    return rows.withColumn("age_days", F.when(age > 14, 7).otherwise(age) if cap else age)


def latest_key_date(df: DataFrame, key: str, value, date: str = "date") -> DataFrame:
    """Latest date held for one key; the key value is a bound parameter, never spliced text."""
    return df.sparkSession.sql(
        f"SELECT max(`{date}`) AS latest FROM {{df}} WHERE `{key}` = :value", args={"value": value}, df=df
    )


def bounds(frames: dict[str, DataFrame], date: str = "date") -> DataFrame:
    """Greatest of the latest dates; NULL when one table is empty."""
    latest = [df.agg(F.max(date).alias("d")).scalar() for df in frames.values()]
    one = next(iter(frames.values())).sparkSession.range(1)
    return one.select(*[c.alias(f"latest_{name}") for name, c in zip(frames, latest)]).select(
        greatest_strict(*[f"latest_{name}" for name in frames]).alias("end_date")
    )


def total_records(frames: dict[str, DataFrame]) -> DataFrame:
    return stack_frames([df.agg(F.count(F.lit(1)).alias("n")) for df in frames.values()]).agg(
        F.sum("n").alias("total_records")
    )


def completeness_score(frames: dict[str, DataFrame], full: int = 1000) -> DataFrame:
    """Mean over tables of min(rows / full, 1), in percent."""
    counts = stack_frames([df.agg(F.count(F.lit(1)).alias("n")) for df in frames.values()])
    return counts.agg((F.avg(F.least(F.col("n") / full, F.lit(1.0))) * 100).alias("completeness"))


def quick_stats(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Total records, tables with rows, and days between the first and last date of all."""
    per_table = stack_frames(
        [
            df.agg(
                F.count(F.lit(1)).alias("n"),
                F.min(F.col(c).cast("date")).alias("first"),
                F.max(F.col(c).cast("date")).alias("last"),
            )
            for df, c in frames.values()
        ]
    )
    return per_table.agg(
        F.sum("n").alias("total_records"),
        F.count_if(F.col("n") > 0).alias("active_tables"),
        F.datediff(F.max("last"), F.min("first")).alias("covered_days"),
    )


def dataset_snapshot(df: DataFrame, version: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(version).alias("data_version"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("feature_count")
    )
