"""Sinks: appends, snapshots that replace a table as a whole, declared tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.session import stage

#: Folder column of tables kept by day.
DAY = "partition_day"


def write_batch(df: DataFrame, path: str, key: str, stamp=None) -> None:
    """Append one batch, stamped with its ingest time, in folders by key.

    Rows are ranged over (key, all other columns' order), so one large key is written by many tasks.
    """
    stamped = df.withColumn("ingest_timestamp", F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp())
    rest = [c for c in df.columns if c != key]
    stamped.repartitionByRange(key, *rest).write.mode("append").partitionBy(key).parquet(path)


def write_overwrite(df: DataFrame, path: str) -> int:
    """Replace the table: write a new snapshot folder, then commit its number.

    Readers follow the last commit, so a table may be rewritten from itself and a job that dies
    half-way changes nothing.
    """
    spark = df.sparkSession
    version = time.time_ns()
    df.write.parquet(f"{path}/snapshot={version}")
    spark.createDataFrame([(version,)], "version BIGINT").coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


def is_snapshot_table(spark: SparkSession, path: str) -> bool:
    commits = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    return commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(commits)


def read_current(spark: SparkSession, path: str, table_schema: StructType | None = None) -> DataFrame:
    """The last committed snapshot, with the declared schema if one is given."""
    commits = spark.read.schema("version BIGINT").parquet(f"{path}/commits")
    version = commits.agg(F.max("version")).first()[0]
    reader = spark.read if table_schema is None else spark.read.schema(table_schema)
    return reader.parquet(f"{path}/snapshot={version}")


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Removes all but the last ``keep`` committed snapshots, and folders older than the last commit that were never committed. Returns
    the versions removed. Readers of an older snapshot lose it, so keep as many as a job may still be reading; a newer folder
    without a commit belongs to a job that is writing and stays."""
    if keep < 1:
        raise ValueError("at least the last snapshot is kept")
    commits = spark.read.schema("version BIGINT").parquet(f"{path}/commits")
    kept = {r[0] for r in commits.select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()}
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "snapshot=*")):
        version = int(status.getPath().getName().split("=")[1])
        if version not in kept and version < max(kept):
            files.delete(status.getPath(), True)
            removed.append(version)
    return sorted(removed)


def write_days(df: DataFrame, path: str, by: str, mode: str = "append") -> None:
    """Write a table in folders by the day of ``by``, a date or timestamp; NULL has a folder of its own. Days are ranged
    together with all columns of a fixed order, so one heavy day is written by many tasks."""
    kept = df.withColumn(DAY, F.col(by).cast("date"))
    spread = kept.repartitionByRange(DAY, F.xxhash64(*df.columns))
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, table_schema: StructType, days: list | None = None) -> DataFrame:
    """A table of ``write_days``, or only the named days of it (None among them: rows without a day). The other folders
    are not read."""
    kept = spark.read.schema(StructType([*table_schema.fields, StructField(DAY, DateType())])).parquet(path)
    if days is not None:
        known = F.col(DAY).isin([d for d in days if d is not None])
        kept = kept.filter(known | F.col(DAY).isNull() if None in days else known)
    return kept.select(*table_schema.names)


def upsert_days(source: DataFrame, path: str, table_schema: StructType, by: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list:
    """Merge rows into a table of ``write_days``, reading and replacing only the days that the rows fall on. Returns these.

    ``by`` must be one of the keys that ``merge`` compares and must come out of it as it went in, so that a row and its match lie
    on one day (normalise a batch first, not in ``merge``). The days of a
    batch are collected: they are as few as the folders the file index lists anyway. The merged days are written to
    the shared folder first and then take the place of the old ones, folder by folder. A job that dies before that
    changes nothing; one that dies while folders are replaced may leave some days old or missing, and plain files offer
    no more. Use the snapshots of ``write_overwrite`` where readers need all or nothing.
    """
    new = stage(source, "batch")
    days = [r[0] for r in new.select(F.col(by).cast("date")).distinct().collect()]
    if days:
        held = read_days(source.sparkSession, path, table_schema, days)
        write_days(stage(merge(held, new), "merged"), path, by, "overwrite")
    return days


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def ensure_table(
    spark: SparkSession, name: str, table_schema: StructType, partition_by=(), cluster_by=(), location: str | None = None
) -> None:
    """Create the table when it is missing. ``cluster_by`` is kept as a property for the writer."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    props = f" TBLPROPERTIES ('cluster_by' = '{','.join(cluster_by)}')" if cluster_by else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{parts}{where}{props}")


def write_clustered(df: DataFrame, path: str, partition_by, cluster_by, rows_per_file: int = 5_000_000) -> None:
    """Append in folders by partition column, sorted by the cluster columns inside a file.

    The range shuffle runs over both, so one heavy partition value is split over tasks.
    """
    order = [*partition_by, *cluster_by]
    (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(path)
    )


def align_to_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of the target by name and type: absent ones NULL, extra ones dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def insert_rows(df: DataFrame, table: str) -> None:
    """Insert into a catalog table, columns matched by name, absent ones NULL."""
    align_to_schema(df, df.sparkSession.table(table).schema).write.insertInto(table)
