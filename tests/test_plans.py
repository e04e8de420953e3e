"""Physical plans: no task that takes a whole table or key, no Python in the plan."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from helpers import SERIES, skewed_series
from tidemark.operators import ordered, relate, rolling
from tidemark.operators.fills import ffill
from tidemark.operators.profile import zscore


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "series")
    spark.createDataFrame(skewed_series(), SERIES).write.parquet(path)
    return spark.read.schema(SERIES).parquet(path)


def windows_over_rows(text: str) -> list[str]:
    """Windows over table rows; those over segment summaries read only their counts and end values."""
    return [l for l in text.splitlines() if re.search(r"\bWindow \[", l) and not re.search(r"__last_|__first_|__n#", l)]


@pytest.mark.parametrize(
    "make",
    [
        lambda d: ffill(d, "date", "value", "key"),
        lambda d: rolling.rolling_z(d, "date", "value", 30, "key"),
        lambda d: rolling.diff(d, "date", "value", "key"),
        lambda d: rolling.time_split(d, "date", 10, "key"),
        lambda d: relate.df_stat(d, "date", "value", "key"),
    ],
)
def test_no_window_over_a_hot_key(stored, make, monkeypatch):
    monkeypatch.setattr(ordered, "HOT_ROWS", 1000)
    text = plan(make(stored))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    for line in windows_over_rows(text):
        assert "__segment" in line or "__block" in line, line


def test_one_shuffle_when_no_key_is_hot(stored):
    text = plan(rolling.rolling_z(stored, "date", "value", 30, "key"))
    assert text.count("Exchange") == 1 and "Join" not in text, text


def test_unkeyed_windows_run_on_segments(stored):
    text = plan(ffill(stored.filter("key = 'hot'").drop("key"), "date", "value"))
    assert windows_over_rows(text) and all("__segment" in l for l in windows_over_rows(text))


def test_top_n_limits_before_the_shuffle(stored):
    text = plan(rolling.top_n_per_key(stored, "key", [F.desc("date")], 3))
    assert text.count("WindowGroupLimit") == 2, text


def test_filter_and_columns_reach_the_scan(stored):
    text = plan(stored.filter(F.col("date") >= F.lit("1995-01-01").cast("date")).groupBy("key").agg(F.max("date")))
    assert "GreaterThanOrEqual(date" in text and re.search(r"ReadSchema: struct<key:string,date:date>", text)


def test_keyed_statistics_do_not_shuffle_the_table(stored):
    text = plan(zscore(stored, "value", "key"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_last_n_is_a_partial_top_k(stored):
    assert "TakeOrderedAndProject" in plan(rolling.last_n(stored, "date", 24))
