"""File sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import schema


def read_series_csv(spark: SparkSession, path, table_schema: StructType | str) -> DataFrame:
    """CSV files with one header row. Path may be a glob or a list."""
    return spark.read.schema(table_schema).option("header", True).csv(path)


#: Above this many keys the newest files are told by a join instead of a list of paths.
MOST_PATHS = 1000


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, modified) of every file under a folder. Names, sizes and times are listed, contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def plain_path(c) -> Column:
    """A path with one slash after its scheme, so that listed and read paths are equal."""
    return F.regexp_replace(c, "^([A-Za-z0-9]+):/+", "$1:/")


def newest_files(spark: SparkSession, folder: str, key_pattern: str | None = None) -> DataFrame:
    """(key, path) of the newest file per key, by modification time, then path; the key is group 1 of a pattern on the path."""
    key = F.regexp_extract("path", key_pattern, 1) if key_pattern else F.lit("")
    return inventory(spark, folder).groupBy(key.alias("key")).agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def read_latest_file(
    spark: SparkSession, folder: str, table_schema: StructType | str, fmt: str = "csv", key_pattern: str | None = None,
    unit: str = "file", most_paths: int = MOST_PATHS,
) -> DataFrame:
    """Rows of the newest file under a folder, or of the newest one per key. ``unit="folder"`` takes the folder of the newest file
    instead, for loads of many part files.

    Up to ``most_paths`` keys only these files are opened. Beyond, the table of newest files stays distributed: all files
    are read and joined to it by their path.
    """
    newest = newest_files(spark, folder, key_pattern)
    part = F.col("path") if unit == "file" else F.regexp_replace("path", "/[^/]*$", "")
    wanted = newest.select(plain_path(part).alias("__path")).distinct()
    reader = spark.read.schema(table_schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    few = wanted.limit(most_paths + 1).collect()
    if not few:
        return spark.createDataFrame([], table_schema)
    if len(few) <= most_paths:
        return reader.format(fmt).load(sorted(r[0] for r in few))
    rows = reader.option("recursiveFileLookup", "true").format(fmt).load(folder)
    own = plain_path(F.col("_metadata.file_path"))
    named = rows.withColumn("__path", own if unit == "file" else F.regexp_replace(own, "/[^/]*$", ""))
    return named.join(wanted, "__path", "left_semi").drop("__path")


def flatten_observations(df: DataFrame, keys=("series",)) -> DataFrame:
    """One row per observation; a value that is no number becomes NULL."""
    rows = df.select(*keys, F.explode("observations").alias("o"))
    return rows.select(
        *keys,
        F.col("o.date").try_cast("date").alias("date"),
        F.col("o.value").try_cast("double").alias("value"),
    )


def read_news_json(spark: SparkSession, path) -> DataFrame:
    """JSON lines in the raw news schema; the payload object is kept as JSON text."""
    return spark.read.schema(schema("raw.news")).json(path)
