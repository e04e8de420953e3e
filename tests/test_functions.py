import datetime as dt
import math

from pyspark.sql import functions as F

from helpers import day, rows
from tidemark.functions import dates as D, numbers as N, payload as J, text as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'STRING' if isinstance(v, str) or v is None else 'DOUBLE'}" for k, v in values.items()))
    return df.select(column).first()[0]


def test_week_u_equals_strftime_for_decades(spark):
    days = spark.range(0, 17000).select(F.date_add(F.lit("1980-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    bad = [r for r in days.select("d", D.week_u("d").alias("w")).collect() if int(r.d.strftime("%U")) != r.w]
    assert not bad


def test_iso_week_equals_python(spark):
    year, week = D.iso_year_week("d")
    days = spark.range(0, 17000).select(F.date_add(F.lit("1980-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    assert all((r.y, r.w) == r.d.isocalendar()[:2] for r in days.select("d", year.alias("y"), week.alias("w")).collect())


def test_parse_any_ts(spark):
    cases = {
        "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05+02:00": dt.datetime(2024, 1, 2, 1, 4, 5),
        "2024-01-02": dt.datetime(2024, 1, 2),
        "Tue, 02 Jan 2024 03:04:05 GMT": dt.datetime(2024, 1, 2, 3, 4, 5),
        "Tue, 2 Jan 2024 03:04:05 -0530": dt.datetime(2024, 1, 2, 8, 34, 5),
        "Tue, 02 Jan 2024 03:04 EST": dt.datetime(2024, 1, 2, 8, 4),
        "2 Jan 2024 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "Tue, 32 Jan 2024 03:04:05 GMT": None,
        "yesterday": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s STRING")
    found = {r.s: r.t for r in df.select("s", D.parse_any_ts("s").cast("timestamp_ntz").alias("t")).collect()}
    assert found == cases


def test_published_at(spark):
    payloads = {
        '{"published_at": "2024-01-02T00:00:00Z", "date": "2020-01-01"}': day("2024-01-02"),
        '{"published_at": "bad", "pub_date": "2024-01-03"}': day("2024-01-03"),
        '{"meta": {"publishedAt": "2024-01-04"}, "metadata": {"date": "2020-01-01"}}': day("2024-01-04"),
        '{"meta": {}, "metadata": {"date": "2024-01-05"}}': day("2024-01-05"),
        '{"title": "x"}': None,
        "not json": None,
    }
    df = spark.createDataFrame([(k,) for k in payloads], "p STRING")
    assert {r.p: r.d for r in df.select("p", J.published_at("p").cast("date").alias("d")).collect()} == payloads


def test_finite_or_null_and_division(spark):
    texts = ["1.5", "NaN", "Infinity", "-Infinity", "x", None, "-2"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(N.finite_or_null("t")).collect()] == [1.5, None, None, None, None, None, -2.0]
    assert one(spark, N.safe_div("a", "b"), a=1.0, b=0.0) is None


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (0.375,), (-0.125,)], "x DOUBLE")
    got = df.select(N.round_half_up("x").alias("up"), N.round_half_even("x").alias("even")).collect()
    assert [r.up for r in got] == [1.01, 0.13, 0.38, -0.13]
    assert [r.even for r in got] == [1.0, 0.12, 0.38, -0.12]


def test_row_std(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (None, 5.0, None), (None, None, None)], "a DOUBLE, b DOUBLE, c DOUBLE")
    got = [r[0] for r in df.select(N.row_std(["a", "b", "c"])).collect()]
    assert math.isclose(got[0], math.sqrt(0.5)) and got[1:] == [None, None]


def test_greatest_strict(spark):
    assert one(spark, N.greatest_strict("a", "b"), a=1.0, b=2.0) == 2.0
    df = spark.createDataFrame([(1.0, None)], "a DOUBLE, b DOUBLE")
    assert df.select(N.greatest_strict("a", "b")).first()[0] is None


def test_urls(spark):
    urls = {
        "https://WWW.Example.com:8080/a?b#c": ("www.example.com:8080", "WWW.Example.com:8080"),
        "//cdn.example.com/x": ("cdn.example.com", None),
        "example.com/x": ("", None),
        None: ("", None),
        "http://host?x": ("host", "host?x"),
    }
    df = spark.createDataFrame([(u,) for u in urls], "u STRING")
    assert {r.u: (r.d, r.h) for r in df.select("u", T.url_domain("u").alias("d"), T.url_host_token("u").alias("h")).collect()} == urls


def test_article_id_is_stable(spark):
    import hashlib

    df = spark.createDataFrame([("https://a", "T"), (None, "T"), ("https://a", None)], "u STRING, t STRING")
    want = [hashlib.sha256(f"{u or ''}||{t or ''}".encode()).hexdigest()[:32] for u, t in [("https://a", "T"), (None, "T"), ("https://a", None)]]
    assert [r[0] for r in df.select(T.article_id("u", "t")).collect()] == want


def test_topics(spark):
    df = spark.createDataFrame([("FOMC",), ("layoffs",), ("Oil",), ("housing",), ("Weather",), (None,)], "t STRING")
    assert [r[0] for r in df.select(T.topic_norm("t")).collect()] == ["fed_policy", "layoff", "energy", "real_estate", "weather", None]


def test_strip_fence(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```',), ('  ```\n{"a": 1}```  ',), ('{"a": 1}',)], "t STRING")
    assert {r[0] for r in df.select(T.strip_fence("t")).collect()} == {'{"a": 1}'}


def test_metrics_from_json(spark):
    df = spark.createDataFrame(
        [(1, '{"MAE": 1.5, "smape": "2", "mae": 3, "Extra": 4, "test_count": 100, "r2": "NaN"}'), (2, "oops"), (3, None)],
        "id INT, metrics STRING",
    )
    wide = {r.id: (r.MAE, r.SMAPE) for r in J.metric_columns(df, "metrics").collect()}
    assert wide == {1: (3.0, 2.0), 2: (None, None), 3: (None, None)}
    maps = {r.id: r.metrics_all for r in J.metric_map(df.withColumn("MASE", F.lit(9.0)), "metrics").collect()}
    assert maps[1] == {"MAE": 3.0, "EXTRA": 4.0, "MASE": 9.0}
    assert maps[2] == {"MASE": 9.0} and maps[3] == {"MASE": 9.0}
    odd = spark.createDataFrame([('{"a": NaN, "b": -Infinity, "c": 1e3, "d": true, "e": null, "f": {"g": 1}, "h": 12.50, "C": "7"}',)], "metrics STRING")
    assert J.metric_map(odd, "metrics").first().metrics_all == {"C": 1000.0, "H": 12.5}


def test_metric_payloads_are_read_once_a_row(spark):
    df = spark.createDataFrame([(1, '{"smape": 2, "MAE": 1.5}')], "id INT, metrics STRING").withColumn("MASE", F.lit(9.0))
    for out in (J.metric_map(df, "metrics").select("metrics_all"), J.metric_columns(df, "metrics").select("SMAPE")):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    many = spark.createDataFrame([("{" + ", ".join(f'"k{i % 700}": {i}' for i in range(900)) + "}",)], "metrics STRING")
    assert J.metric_map(many, "metrics").first().metrics_all["K0"] == 700.0


def test_json_key_count(spark):
    df = spark.createDataFrame([(1, None, "x")], "a INT, b INT, c STRING")
    assert df.select(J.json_key_count(df)).first()[0] == 3


def test_months_and_labels(spark):
    df = spark.createDataFrame([("2023-11-30", 2023, 5)], "d STRING, y INT, w INT").withColumn("d", F.col("d").cast("date"))
    row = df.select(D.month_range("d", 3).alias("m"), D.week_label("y", "w").alias("l"), D.week_end("d").alias("s")).first()
    assert row.m == [day("2023-12-01"), day("2024-01-01"), day("2024-02-01")] and row.l == "2023-W05" and row.s == day("2023-12-03")
    assert rows(spark.range(1).select(D.fmt_ts(F.lit(None).cast("timestamp")))) == [("–",)]


def test_metric_columns_keep_held_values(spark):
    from tidemark.functions import payload

    df = spark.createDataFrame([(1, '{"mae": 2.5}', 0.7, 9.0), (2, None, 0.4, None)], "id INT, metrics STRING, R2 DOUBLE, MAE DOUBLE")
    got = {r.id: (r.R2, r.MAE) for r in payload.metric_columns(df, "metrics").collect()}
    assert got == {1: (0.7, 2.5), 2: (0.4, None)}
