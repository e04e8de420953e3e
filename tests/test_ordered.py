"""Segmented operators equal a plain window per key, on skewed keys and NULL keys alike."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from helpers import SERIES, close, rows, skewed_series
from tidemark.operators import ordered as O
from tidemark.operators.fills import bfill, ffill, fill, interpolate_dates, interpolate_steps, on_calendar
from tidemark.operators.rolling import flag_spans, rolling_mean, rolling_z, time_split, with_lags


@pytest.fixture(params=[1000, 10**9], ids=["one_hot", "none_hot"], autouse=True)
def hot_rows(request, monkeypatch):
    """Rows from which on a key is split: only the hot key, or none."""
    monkeypatch.setattr(O, "HOT_ROWS", request.param)


@pytest.fixture(scope="module")
def series(spark):
    return spark.createDataFrame(skewed_series(), SERIES).cache()


def same(a, b, cols):
    left, right = rows(a, *cols), rows(b, *cols)
    assert len(left) == len(right) and left
    for x, y in zip(left, right):
        assert all(close(p, q) if isinstance(p, float) or isinstance(q, float) else p == q for p, q in zip(x, y)), (x, y)


@pytest.mark.parametrize("segment", [None, 40])
def test_row_index_equals_row_number(series, segment):
    plain = series.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("date")).cast("bigint") - 1)
    same(O.row_index(series, "date", "key", segment=segment), plain, ["key", "date", "rn"])


@pytest.mark.parametrize("segment", [None, 16])
def test_two_phase_carry_equals_global_windows(series, segment):
    past = Window.partitionBy("key").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("key").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    plain = series.select("key", "date", F.last("value", True).over(past).alias("f"), F.first("value", True).over(ahead).alias("b"))
    ours = ffill(series, "date", "value", "key", segment).select("key", "date", F.col("value").alias("f"))
    same(ours, plain, ["key", "date", "f"])
    ours = bfill(series, "date", "value", "key", segment).select("key", "date", F.col("value").alias("b"))
    same(ours, plain, ["key", "date", "b"])


def test_every_key_split(series, monkeypatch):
    monkeypatch.setattr(O, "HOT_ROWS", 0)
    rules = {"value": "steps"}
    same(fill(series, "date", rules, "key", 16), fill(series, "date", rules, "key", O.WHOLE), ["key", "date", "value"])


@pytest.mark.parametrize("rule", ["ffill", "bfill", "both", "dates", "dates_inner", "steps"])
def test_every_rule_agrees_with_the_whole_window(series, rule):
    a = fill(series, "date", {"value": rule}, "key", segment=16)
    b = fill(series, "date", {"value": rule}, "key", segment=O.WHOLE)
    same(a, b, ["key", "date", "value"])


def test_fills_are_idempotent_and_keep_values(series):
    once = interpolate_dates(series, "date", "value", "key")
    twice = interpolate_dates(once, "date", "value", "key")
    same(once, twice, ["key", "date", "value"])
    kept = series.filter("value is not null").join(once.withColumnRenamed("value", "filled"), ["key", "date"])
    assert kept.filter("value <> filled").count() == 0


def test_unkeyed_series(series):
    hot = series.filter("key = 'hot'").drop("key")
    plain = hot.withColumn("value", F.last("value", True).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)))
    same(ffill(hot, "date", "value", segment=12), plain, ["date", "value"])


@pytest.mark.parametrize("block", [16, 64])
def test_rolling_frames_cross_blocks(series, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    w = Window.partitionBy("key").orderBy("date").rowsBetween(-29, 0)
    plain = series.withColumn("value_mean", F.when(F.count("value").over(w) >= 10, F.avg("value").over(w)))
    same(rolling_mean(series, "date", "value", 30, "key", min_periods=10, segment=9), plain, ["key", "date", "value_mean"])


def test_leads_and_lags_cross_blocks(series, monkeypatch):
    monkeypatch.setattr(O, "BLOCK_ROWS", 8)
    w = Window.partitionBy("key").orderBy("date")
    plain = series.withColumns({"a": F.lag("value", 5).over(w), "b": F.lead("date", 3).over(w)})
    ours = O.over_rows(series, "date", lambda v: {"a": F.lag("value", 5).over(v), "b": F.lead("date", 3).over(v)}, "key", 5, 3, segment=9)
    same(ours, plain, ["key", "date", "a", "b"])


def test_composite_order(spark):
    data = [("a", y, w, None if (y + w) % 3 else float(w)) for y in range(2000, 2012) for w in range(54)]
    df = spark.createDataFrame(data, "key STRING, year INT, week INT, value DOUBLE")
    same(
        interpolate_steps(df, ["year", "week"], "value", "key"), interpolate_steps(df, ["year", "week"], "value", "key", segment=O.WHOLE),
        ["key", "year", "week", "value"],
    )


def test_step_interpolation_edges(spark):
    data = [(1, i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])]
    df = spark.createDataFrame(data, "year INT, week INT, value DOUBLE")
    assert [r[2] for r in rows(interpolate_steps(df, ["year", "week"], "value"))] == [None, 2.0, 4.0, 6.0, 8.0, 8.0]


def test_date_interpolation_edges(spark):
    data = [("1980-01-01", None), ("1980-01-02", 1.0), ("1980-01-06", None), ("1980-01-12", 3.0), ("1980-01-20", None)]
    df = spark.createDataFrame(data, "date STRING, value DOUBLE").withColumn("date", F.col("date").cast("date"))
    assert [r[1] for r in rows(interpolate_dates(df, "date", "value"))] == [1.0, 1.0, 1.8, 3.0, 3.0]
    assert [r[1] for r in rows(interpolate_dates(df, "date", "value", edges="null"))] == [None, 1.0, 1.8, 3.0, None]


def test_segments_of_doubles_and_text(spark):
    df = spark.createDataFrame([(1.5, "c"), (0.5, "a"), (None, "b"), (float("nan"), "d")], "x DOUBLE, t STRING")
    assert [r[1:] for r in sorted(map(tuple, O.row_index(df, "x", segment=3).select("rn", "t").collect()))] == [("b",), ("a",), ("c",), ("d",)]
    assert rows(O.row_index(df, "t", segment=3), "t", "rn") == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


@pytest.mark.parametrize("keyed", [True, False])
def test_a_dense_day_is_cut_by_rows(spark, monkeypatch, keyed):
    """Rows of one date, most of them without a value, part by number; fills and numbers still follow one total order."""
    monkeypatch.setattr(O, "HOT_ROWS", 100)
    data = [("a", dt.date(2020, 1, 1), 5.0 if i == 7 else None, i) for i in range(4000)]
    df = spark.createDataFrame(data, "key STRING, date DATE, value DOUBLE, id INT")
    keys = ["key"] if keyed else []
    for tied in (None, ["value"]):
        told, order = O._tied(df, ["date"], tied)
        sizes = [r["count"] for r in O._split(told, order, keys, 8).groupBy(O._SEG).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1500
    total = Window.partitionBy("key").orderBy("date", F.xxhash64("key", "value", "id"))
    plain = df.withColumn("rn", F.row_number().over(total).cast("bigint") - 1)
    same(O.row_index(df, "date", keys, segment=8), plain, ["id", "rn"])
    by_value = Window.partitionBy("key").orderBy("date", F.xxhash64("value")).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("value", F.last("value", True).over(by_value))
    same(ffill(df, "date", "value", keys, 8), plain, ["value"])


def test_calendar_keeps_every_key(series):
    dense = on_calendar(series.filter("value is not null"), e="key")
    per_key = {r["key"]: r["n"] for r in dense.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(set(per_key.values())) == 1 and None in per_key


def test_time_split(series):
    out = time_split(series, "date", 24, "key")
    tests = {r["key"]: r["n"] for r in out.filter("split = 'test'").groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert tests == {"hot": 24, "b": 24, None: 24, "one": 1, "void": 5}


def test_rolling_z_is_zero_without_spread(spark):
    data = [(f"2020-01-{i:02d}", 5.0) for i in range(1, 32)]
    df = spark.createDataFrame(data, "date STRING, x DOUBLE").withColumn("date", F.col("date").cast("date"))
    assert {r[0] for r in rows(rolling_z(df, "date", "x"), "x_zscore")} == {0.0}


def test_flag_spans(spark):
    data = [(i, f) for i, f in enumerate([1, 1, 0, None, 1, 0, 0, 1, 1, 1])]
    df = spark.createDataFrame(data, "t INT, flag INT")
    assert rows(flag_spans(df, "t", "flag")) == [(0, 1), (4, 4), (7, 9)]


def test_attach_null_keys(series):
    totals = series.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    out = O.attach(series, totals, "key")
    assert out.filter("n is null").count() == 0 and out.count() == series.count()


def test_lag_zero_is_not_needed(series):
    assert "value__lag_2" in with_lags(series, "date", "value", [1, 2], "key").columns


@pytest.mark.parametrize("hot,parts", [(0, 6), (5, None), (10**9, 6)])
@pytest.mark.parametrize("keyed", [True, False])
def test_null_and_tied_order_values(spark, monkeypatch, hot, keyed, parts):
    """NULL dates come first, ties are settled alike on both paths, and all answers follow one total order."""
    from pyspark.sql import functions as F

    from tidemark.operators import fills, ordered, rolling

    rows = [("a", None if i % 9 == 0 else dt.date(2000 + i // 25, 1 + i % 3, 1), None if i % 4 == 0 else float(i), i) for i in range(80)]
    rows += [("b", None, 1.0, 100), ("b", None, 2.0, 101), ("b", dt.date(2001, 1, 1), None, 102)]
    df = spark.createDataFrame(rows, "key STRING, date DATE, value DOUBLE, id INT")
    keys = "key" if keyed else ()
    part = Window.partitionBy("key") if keyed else Window.partitionBy()
    tie = F.xxhash64(*[c for c in df.columns if c != "date"])
    total = part.orderBy("date", tie)
    monkeypatch.setattr(ordered, "HOT_ROWS", hot)
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 7)

    want = df.withColumn("rn", F.row_number().over(total) - 1)
    assert rows_of(ordered.row_index(df, "date", keys, segment=parts), "id", "rn") == rows_of(want, "id", "rn")
    split = rolling.time_split(df, "date", 2, keys, parts)
    pieces = split if isinstance(split, tuple) else (split,)
    assert all(set(df.columns) <= set(p.columns) for p in pieces)
    moved = df.withColumn("d", F.col("value") - F.lag("value").over(total))
    assert rows_of(rolling.diff(df, "date", "value", keys, "d", parts), "id", "d") == rows_of(moved, "id", "d")
    by_value = part.orderBy("date", F.xxhash64("value")).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumn("value", F.last("value", True).over(by_value))
    assert rows_of(fills.ffill(df, "date", "value", keys, parts), "id", "value") == rows_of(filled, "id", "value")


def test_order_by_text_needs_no_segment(spark):
    from tidemark.operators import ordered

    df = spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "z")], "key STRING, name STRING")
    assert rows_of(ordered.row_index(df, "name", "key"), "name", "rn") == [("w", 0), ("x", 1), ("z", 0)]


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
