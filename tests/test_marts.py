"""The relevance mart load by load, wide correlations, tied dates."""

import datetime as dt
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import close, day, rows
from tidemark.operators.fills import resample_month_last
from tidemark.operators.relate import MANY_PAIRS, corr_matrix, cross_corr, total_return
from tidemark.operators.select import news_valid
from tidemark.operators.rolling import latest_nonnull_per_key, latest_values
from tidemark.plans import gold as G, models as M, relevance as R
from tidemark.plans.news import land_news, landing_rows, relevance_by_day
from tidemark.schemas import TOPICS, schema
from tidemark.sources.sinks import read_days

STAMP = "2024-02-01 00:00:00"
REL = [f"relevance_{t}" for t in TOPICS]


def news(spark, items):
    """(url, published day of January or None, topic, score, hour of ingest)"""
    at = lambda d, h=0: None if d is None else dt.datetime(2024, 1, d, h)
    full = [(at(1 + h // 24, h % 24), day("2024-01-01"), t, f"title {u}", u, "site", at(p), s, "text", "{}") for u, p, t, s, h in items]
    return spark.createDataFrame(full, schema("raw.news"))


LOADS = [
    [("a", 3, "Fed", 1.0, 0), ("b", 3, "oil", 5.0, 1), ("c", 4, "unheard", 2.0, 2), (None, 4, "labor", 1.0, 2)],
    [("d", 9, "labor", 3.0, 30), ("a", 3, "FOMC", 4.0, 31), ("e", None, "cpi", 7.0, 32)],
    [("f", 3, "labor", 2.0, 60), ("b", 3, "oil", None, 61), ("d", 9, "labor", 3.0, 62), ("g", 12, "energy", 1.5, 63)],
]


def test_loads_equal_the_rebuild(spark, tmp_path):
    root = str(tmp_path / "mart")
    R.create(spark, root)
    table = spark.createDataFrame([], schema("landing.news"))
    touched = []
    for items in LOADS:
        batch = news(spark, items)
        touched.append(sorted(str(d) for d in R.load(batch, root, STAMP)))
        table = land_news(table, news_valid(batch))
        table = spark.createDataFrame(table.collect(), table.schema)
        want = relevance_by_day(table)
        cols = ["date", *REL, "num_articles_total"]
        assert rows(R.read_mart(spark, root), *cols) == rows(want, *cols)
        R.load(batch, root, STAMP)  # a load that is run again changes nothing
        assert rows(R.read_mart(spark, root), *cols) == rows(want, *cols)
    assert touched[1] == ["2024-01-02", "2024-01-03", "2024-01-09"]  # the undated one by its day of ingest
    assert touched[2] == ["2024-01-03", "2024-01-09", "2024-01-12"]
    assert R.load(news(spark, []), root, STAMP) == []
    shown = rows(R.trailing_weeks(R.read_state(spark, root)), "date", "relevance_labor", "num_articles_total")
    by_day = {d: rows_ for d, rows_ in ((r["date"], r) for r in R.read_mart(spark, root).collect())}
    for d, _, n in shown:
        assert n == sum(r["num_articles_total"] for x, r in by_day.items() if x <= d < x + dt.timedelta(7))
    some = R.refreshed_weeks(spark, root, [day("2024-01-03")])
    assert rows(some, "date", "relevance_labor", "num_articles_total") == [r for r in shown if day("2024-01-03") <= r[0] <= day("2024-01-09")]


def test_a_load_reads_touched_days_only(spark, tmp_path):
    root = str(tmp_path / "mart")
    R.create(spark, root)
    R.load(news(spark, [(f"u{i}", 1 + i % 25, "labor", 1.0, 0) for i in range(100)]), root, STAMP)
    plan = read_days(spark, f"{root}/news", schema("landing.news"), [day("2024-01-07")])
    scanned = plan.select(F.input_file_name()).distinct().collect()
    assert {r[0].split("partition_day=")[1].split("/")[0] for r in scanned} == {"2024-01-07"}
    before = R.read_mart(spark, root).filter("date = DATE'2024-01-20'").select(F.input_file_name()).first()[0]
    assert R.load(news(spark, [("late", 7, "labor", 9.0, 400)]), root, STAMP) == [day("2024-01-07")]
    assert R.read_mart(spark, root).filter("date = DATE'2024-01-20'").select(F.input_file_name()).first()[0] == before


def test_states_merge(spark):
    table = landing_rows(news(spark, [i for load in LOADS for i in load if i[0]]))
    whole = R.day_topic_state(table)
    parts = [R.day_topic_state(table.filter(F.pmod(F.xxhash64("url"), F.lit(3)) == k)) for k in range(3)]
    assert rows(R.merge_states(*parts)) == rows(whole.select("date", "topic", "score_sum", "score_count", "articles"))


def wide(spark, n, k, seed=2):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        base = rng.gauss(0, 1)
        data.append(tuple(None if rng.random() < 0.3 else 1e6 + base * (j % 3 - 1) + rng.gauss(0, 1 + j) for j in range(k - 3)) + (7.0, None, 5.0 if rng.random() < 0.5 else None))
    cols = [f"c{j}" for j in range(k)]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols)), cols, data


def test_wide_correlations_match_pairs(spark):
    df, cols, data = wide(spark, 200, 14)
    assert len(list(combinations(cols, 2))) > MANY_PAIRS
    got = {(r["a"], r["b"]): r["r"] for r in corr_matrix(df, cols).collect()}
    own = np.array(data, dtype=float)
    for i, j in combinations(range(len(cols)), 2):
        both = own[~np.isnan(own[:, i]) & ~np.isnan(own[:, j])][:, [i, j]]
        r = got[cols[i], cols[j]]
        if len(both) < 2 or both[:, 0].std() == 0 or both[:, 1].std() == 0:
            assert r is None
        else:
            assert close(r, np.corrcoef(both.T)[0, 1], 1e-9)
    cross = {(r["a"], r["b"]): r["r"] for r in cross_corr(df, cols[:8], cols[4:]).collect()}
    assert all(close(cross[a, b], got[a, b], 1e-9) for a, b in cross if (a, b) in got) and cross["c5", "c5"] == pytest.approx(1)
    assert {r["r"] for r in corr_matrix(df.limit(0), cols).collect()} == {None} and {r["r"] for r in corr_matrix(df.limit(1), cols).collect()} == {None}


def test_tied_dates_have_one_answer(spark):
    d1, d2 = day("2024-01-05"), day("2024-01-31")
    data = [("k", d, v, str(v)) for d in (d1, d2) for v in (3.0, 1.0, 2.0)] + [("k", None, 9.0, "9"), ("k", d2, None, "0")]
    results = set()
    for seed in range(6):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "ticker string, date date, close_price double, note string").repartition(1 + seed)
        results.add(tuple(map(str, (
            rows(total_return(df)), rows(latest_values(df, "date", ["close_price"], "ticker")), rows(latest_nonnull_per_key(df, "ticker", "date", ["close_price", "note"])),
            rows(resample_month_last(df, "date", ["close_price"], "ticker")), rows(M.fit_ar1(df.filter("date IS NOT NULL"), "date", "close_price", "ticker"))))))
    assert len(results) == 1
    assert rows(total_return(df, ties=["close_price"])) == [("k", pytest.approx(200.0))]
    assert rows(latest_values(df, "date", ["close_price", "note"], "ticker", ties=["close_price"]).select("close_price")) == [(3.0,)]
    assert rows(resample_month_last(df, "date", ["close_price"], "ticker", ties=["close_price"]).dropna(subset=["date"])) == [("k", d2, 3.0)]


def landing(spark, seed=1, years=4):
    """Four landing tables with gaps of all lengths; one column ends early, one has no value at all."""
    rng = random.Random(seed)
    start = dt.date(1999, 12, 20)
    days = [start + dt.timedelta(i) for i in range(365 * years)]
    daily_ = [(d, rng.random()) for d in days if rng.random() < 0.6]
    monthly = [(d, rng.random(), rng.random() if d < dt.date(2001, 2, 1) else None, None) for d in days if d.day == 1]
    sector = [(d, rng.random() if rng.random() < 0.5 else None) for d in days]
    credit = [(d, rng.random()) for d in days if d.month % 3 == 1 and d.day == 1 and rng.random() < 0.8]
    make = spark.createDataFrame
    return [make(daily_, "date date, rate double"), make(monthly, "date date, cpiurban double, fedfundrate double, realgdp double"), make(sector, "date date, tech_price double"), make(credit, "date date, delinq double")]


RULES = {"fedfundrate": "ffill", "cpiurban": "steps", "realgdp": "steps", "delinq": "steps"}


def test_gold_loads_equal_a_rebuild(spark, tmp_path):
    tables = landing(spark)
    columns = [c for t in tables for c in t.columns if c != "date"]
    root, before = str(tmp_path / "gold"), None
    cuts = [dt.date(2000, 6, 14), dt.date(2000, 6, 21), dt.date(2001, 1, 1), dt.date(2002, 11, 5), dt.date(2004, 1, 1)]
    for cut in cuts:
        upto = [t.filter(F.col("date") < F.lit(cut)) for t in tables]
        first = G.load_weeks(*upto, root, before, RULES)
        assert rows(G.read_gold(spark, root, columns, RULES), "year", "week", *columns) == rows(G.weekly_features(*upto, rules=RULES), "year", "week", *columns)
        before = cut
    # The last load closes the gap of the quarterly column and leaves the years before it alone.
    assert first >= (2002, 1)
    files = G.read_weeks(spark, root, columns, RULES).filter("year = 2001").select(F.input_file_name()).distinct().collect()
    # A late row: everything from its week on, and what lies in gaps it closes.
    late = [tables[0], tables[1], tables[2], tables[3].unionByName(spark.createDataFrame([(dt.date(2003, 2, 20), 99.0)], "date date, delinq double"))]
    assert G.load_weeks(*late, root, dt.date(2003, 2, 20), RULES) >= (2002, 1)
    assert rows(G.read_gold(spark, root, columns, RULES), "year", "week", *columns) == rows(G.weekly_features(*late, rules=RULES), "year", "week", *columns)
    assert G.read_weeks(spark, root, columns, RULES).filter("year = 2001").select(F.input_file_name()).distinct().collect() == files


def test_gold_load_reads_from_the_touched_week(spark):
    assert G.week_start(dt.date(2001, 1, 3)) == dt.date(2001, 1, 1) and G.week_start(dt.date(2001, 1, 10)) == dt.date(2001, 1, 7)
    assert G.week_start(dt.date(2001, 1, 7)) == dt.date(2001, 1, 7)
