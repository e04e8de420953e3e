import time

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import day, rows
from tidemark.schemas import schema, tables
from tidemark.sources import readers as R, sinks as S, stats as Z
from tidemark.sources.stats import folder_size
from tidemark.operators.select import drop_bad_dates

POINT = "series STRING, date DATE, value DOUBLE"


def test_every_schema_parses(spark):
    assert all(schema(t).fields for t in tables())


def test_csv_and_latest_file(spark, tmp_path):
    for name, value in (("DGS2_1.csv", 1.0), ("DGS10_1.csv", 5.0), ("DGS2_2.csv", 2.0)):
        (tmp_path / name).write_text(f"series,date,value\n{name[:-6]},2024-01-01,{value}\n")
        time.sleep(0.05)
    everything = R.read_series_csv(spark, f"{tmp_path}/DGS2_*.csv", POINT)
    assert [r[2] for r in rows(everything)] == [1.0, 2.0]
    newest = R.read_latest_file(spark, str(tmp_path), POINT, key_pattern=r"/([A-Z0-9]+)_\d+\.csv")
    assert rows(newest, "series", "value") == [("DGS10", 5.0), ("DGS2", 2.0)]


def test_old_snapshots_go(spark, tmp_path):
    path = str(tmp_path / "t")
    versions = [S.write_overwrite(spark.range(i).toDF("x"), path) for i in range(1, 5)]
    spark.range(9).toDF("x").write.parquet(f"{path}/snapshot={versions[2] + 1}")  # died before its commit
    spark.range(9).toDF("x").write.parquet(f"{path}/snapshot={versions[3] + 1}")  # still being written
    assert S.expire_snapshots(spark, path, 2) == [versions[0], versions[1], versions[2] + 1]
    assert sorted(int(f.name.split("=")[1]) for f in (tmp_path / "t").glob("snapshot=*")) == [versions[2], versions[3], versions[3] + 1]
    assert S.read_current(spark, path, StructType.fromDDL("x BIGINT")).count() == 4
    assert S.expire_snapshots(spark, path, 5) == []


def test_newest_files_by_join(spark, tmp_path):
    for name, value in (("DGS2_1.csv", 1.0), ("DGS10_1.csv", 5.0), ("DGS2_2.csv", 2.0)):
        (tmp_path / name).write_text(f"series,date,value\n{name[:-6]},2024-01-01,{value}\n")
        time.sleep(0.05)
    pattern = r"/([A-Z0-9]+)_\d+\.csv"
    joined = R.read_latest_file(spark, str(tmp_path), POINT, key_pattern=pattern, most_paths=1)
    assert rows(joined, "series", "value") == [("DGS10", 5.0), ("DGS2", 2.0)]
    assert R.read_latest_file(spark, str(tmp_path), POINT, key_pattern=pattern, most_paths=0).count() == 2


def test_inventory_is_the_file_system(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(5000).withColumn("k", F.col("id") % 3).write.partitionBy("k").parquet(str(path))
    files = [f for f in path.rglob("*.parquet")]
    listed = {"/".join(r["path"].rsplit("/", 2)[1:]): r["size"] for r in R.inventory(spark, str(path)).collect()}
    assert {f"{f.parent.name}/{f.name}": f.stat().st_size for f in files} == {n: s for n, s in listed.items() if n.endswith(".parquet")}
    got = folder_size(spark, str(path)).first()
    assert got["files"] == len(listed) and got["size_mb"] == round(sum(listed.values()) / 2**20, 2)


def test_observations(spark):
    df = spark.createDataFrame(
        [("A", [("2024-01-01", "1.5"), ("2024-01-02", "."), ("2024-01-03", "")]), ("B", [])], schema("raw.observations")
    )
    assert rows(R.flatten_observations(df)) == [("A", day("2024-01-01"), 1.5), ("A", day("2024-01-02"), None), ("A", day("2024-01-03"), None)]


def test_snapshot_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_overwrite(spark.range(5).toDF("x"), path)
    S.write_overwrite(S.read_current(spark, path).withColumn("x", F.col("x") + 10), path)
    assert rows(S.read_current(spark, path)) == [(i,) for i in range(10, 15)]


def test_uncommitted_snapshot_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_overwrite(spark.range(3).toDF("x"), path)
    spark.range(9).toDF("x").write.parquet(f"{path}/snapshot=99999999999999999999")
    assert S.read_current(spark, path).count() == 3


def test_batches_are_stamped(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([("A", day("2024-01-01"), 1.0)], POINT)
    S.write_batch(df, path, "series", "2024-01-02")
    S.write_batch(df, path, "series", "2024-01-03")
    got = spark.read.parquet(path)
    assert got.count() == 2 and got.select("ingest_timestamp").distinct().count() == 2


def test_align_and_insert(spark, tmp_path):
    target = StructType.fromDDL("a INT, b STRING, c DOUBLE")
    df = spark.createDataFrame([(1.0, "x")], "c DOUBLE, extra STRING")
    assert rows(S.align_to_schema(df, target)) == [(None, None, 1.0)]
    spark.sql("DROP TABLE IF EXISTS t_insert")
    S.ensure_table(spark, "t_insert", target, location=str(tmp_path / "ins"))
    S.ensure_table(spark, "t_insert", target, location=str(tmp_path / "ins"))
    S.insert_rows(df, "t_insert")
    assert rows(spark.table("t_insert")) == [(None, None, 1.0)]
    spark.sql("DROP TABLE t_insert")


def test_bad_dates(spark):
    df = spark.createDataFrame([("xlf", "XLF"), ("2024-01-01", "XLF"), ("soon", "XLK"), (None, "XLK")], "date STRING, ticker STRING")
    assert rows(drop_bad_dates(df)) == [(day("2024-01-01"), "XLF")]


def test_stats(spark):
    a = spark.createDataFrame([(day("2024-01-01"), None), (day("2024-01-05"), None)], "date DATE, created_at TIMESTAMP")
    empty = a.limit(0)
    got = {r.table_name: (r.row_count, r.latest and r.latest.date()) for r in Z.table_stats({"a": a, "e": empty}).collect()}
    assert got == {"a": (2, day("2024-01-05")), "e": (0, None)}
    assert Z.bounds({"a": a, "e": empty}).first()[0] is None and Z.bounds({"a": a}).first()[0] == day("2024-01-05")
    fresh = {r.table_name: r.age_days for r in Z.freshness({"a": (a, "date"), "e": (empty, "date")}, "2024-02-01").collect()}
    assert fresh == {"a": 7, "e": None}
    assert Z.freshness({"a": (a, "date")}, "2024-02-01", cap=False).first().age_days == 27
    assert Z.latest_key_date(a, "date", day("2024-01-01")).first()[0] == day("2024-01-01")
    assert Z.completeness_score({"a": a, "e": empty}).first()[0] == 0.1
