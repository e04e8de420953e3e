"""Profiles, correlations, returns, risk, scenarios, registry and models against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from helpers import close, day, rows
from tidemark.operators import profile as Q, relate as L, reshape as H, rolling as W
from tidemark.plans import gold, landing, models as M, registry as G, risk as R, scenario as C
from tidemark.schemas import schema


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.normal(size=n).cumsum()
    frame = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n).date, "x": x, "y": 0.7 * x + rng.normal(size=n), "z": rng.normal(size=n)})
    frame.loc[frame.index % 17 == 3, "z"] = None
    ddl = "date DATE, x DOUBLE, y DOUBLE, z DOUBLE"
    data = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    return frame, spark.createDataFrame(data, ddl).cache()


@pytest.mark.parametrize("limit", [1, 7, 100, 10_000])
def test_exact_quantiles_when_a_task_holds_few_rows(spark, limit):
    rng = random.Random(1)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [0.5] * 2000 + [9.0] * 1500 + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v, float(i % 3)) for i, v in enumerate(values)], "v DOUBLE, k DOUBLE")
    got = Q.exact_quantiles(df, ["v", "k"], (0.0, 0.25, 0.5, 0.75, 0.9, 1.0), limit, error=0.01)
    held = np.array([v for v in values if v is not None])
    for name, data in (("v", held), ("k", np.arange(len(values)) % 3)):
        want = np.quantile(data, (0.0, 0.25, 0.5, 0.75, 0.9, 1.0))
        assert all(close(a, float(b)) for a, b in zip(got[name], want)), (name, got[name], want)


def test_describe_both_ways(panel):
    _, df = panel
    a, b = rows(Q.describe_long(df, ["x", "z"])), rows(Q.describe_long(df, ["x", "z"], limit=20))
    assert all(close(p, q) if isinstance(p, float) else p == q for r, s in zip(a, b) for p, q in zip(r, s))


def test_empty_describe(spark):
    out = Q.describe_long(spark.createDataFrame([], "v DOUBLE"), "v").first()
    assert out.n == 0 and out.p50 is None


def test_correlations_match_numpy(panel):
    frame, df = panel
    got = {(r.a, r.b): r.r for r in L.corr_matrix(df, ["x", "y", "z"]).collect()}
    want = frame[["x", "y", "z"]].astype(float).corr()
    assert all(close(v, want.loc[k]) for k, v in got.items())
    lagged = {r.lag: r.r for r in L.lag_corr(df, "date", "x", "y", (0, 3, 12)).collect()}
    assert all(close(lagged[k], frame.x.shift(k).corr(frame.y)) for k in (0, 3, 12))


def test_ccf_matches_definition(panel):
    frame, df = panel
    xc, yc = frame.x - frame.x.mean(), frame.y - frame.y.mean()
    got = {r.lag: r.r for r in L.ccf(df, "date", "x", "y", 5).collect()}
    for k in range(6):
        want = (xc.values[k:] * yc.values[: len(yc) - k]).sum() / (len(xc) - k) / (xc.std(ddof=0) * yc.std(ddof=0))
        assert close(got[k], want)


def test_dickey_fuller_matches_least_squares(panel):
    frame, df = panel
    x = frame.x.values
    a = np.column_stack([np.ones(len(x) - 1), x[:-1]])
    beta, rest, *_ = np.linalg.lstsq(a, np.diff(x), rcond=None)
    se = math.sqrt(rest[0] / (len(a) - 2) * np.linalg.inv(a.T @ a)[1, 1])
    got = L.df_stat(df, "date", "x").first()
    assert close(got.slope, beta[1], 1e-8) and close(got.df_t, beta[1] / se, 1e-8)


def test_rolling_frames_match_pandas(panel):
    frame, df = panel
    z = frame.z.astype(float)
    for got, want in (
        (W.rolling_mean(df, "date", "z", 12).select("date", "z_mean"), z.rolling(12).mean()),
        (W.rolling_mean(df, "date", "z", 3, min_periods=1).select("date", "z_mean"), z.rolling(3, min_periods=1).mean()),
        (W.rolling_std(df, "date", "x", 52).select("date", "x_std"), frame.x.rolling(52).std()),
        (W.rolling_corr(df, "date", "x", "y", 104).select("date", "corr"), frame.x.rolling(104).corr(frame.y)),
    ):
        values = [r[1] for r in rows(got)]
        assert all(close(a, None if pd.isna(b) else b, 1e-7) for a, b in zip(values, want)), want.name


def test_market_ratios_pad_gaps_as_pandas(spark):
    rng = random.Random(5)
    data = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 100 + rng.random() * 9, None if i < 4 or i % 7 == 0 else 50 + rng.random()) for i in range(90)]
    frame = pd.DataFrame(data, columns=["date", "a", "b"]).set_index("date").astype(float)
    returns = frame.ffill().pct_change().dropna()
    got = {r.ticker: r for r in L.market_ratios(spark.createDataFrame(data, "date DATE, a DOUBLE, b DOUBLE"), "date", ["a", "b"]).collect()}
    for t in ("a", "b"):
        assert close(got[t].annual_vol, returns[t].std() * 252**0.5 * 100, 1e-8)
        assert close(got[t].sharpe, (returns[t].mean() * 252 - 0.02) / (returns[t].std() * 252**0.5), 1e-8)


def test_flat_price_has_no_sharpe(spark):
    data = [(dt.date(2024, 1, i), "t", 5.0) for i in range(1, 9)] + [(dt.date(2024, 1, i), "zero", 0.0) for i in range(1, 9)]
    df = spark.createDataFrame(data, "date DATE, ticker STRING, close_price DOUBLE")
    out = {r.ticker: r.sharpe for r in L.sharpe(df.filter("ticker = 't'")).collect()}
    assert out == {"t": None}
    assert W.market_features(df).filter("ticker = 'zero' and return_1d is not null").count() == 0


def test_market_features_need_history(spark):
    data = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "t", 100.0 + i) for i in range(21)]
    out = W.market_features(spark.createDataFrame(data, "date DATE, ticker STRING, close_price DOUBLE"))
    assert out.filter("return_1m is not null or volatility_1m is not null").count() == 0
    assert out.filter("momentum_4w is not null").count() == 1


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, day("2024-01-01")), (None, None, None)], "a INT, b STRING, date DATE")
    assert rows(Q.null_profile(df)) == [("a", 2, 1, 1, 50.0), ("b", 2, 0, 2, 100.0)]
    assert {r[4] for r in rows(Q.null_profile(df.limit(0)))} == {0.0}


def test_zscore_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x DOUBLE")
    assert {r[0] for r in rows(Q.zscore(df, "x"))} == {0.0}


def test_pivot_and_unpivot_are_inverse(spark):
    data = [(i, k, float(i)) for i in range(20) for k in "abc" if (i + ord(k)) % 3]
    df = spark.createDataFrame(data, "t INT, k STRING, v DOUBLE")
    wide = H.pivot_max(df, "t", "k", {k: k for k in "abc"}, "v")
    assert rows(H.to_long(wide, "t", list("abc"), "k", "v")) == rows(df)


def test_outer_align_takes_the_maximum_of_repeats(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 4.0), (2, 2.0)], "date INT, value DOUBLE")
    b = spark.createDataFrame([(1, 7.0), (1, 6.0), (3, 3.0)], "date INT, value DOUBLE")
    assert rows(H.outer_align({"a": a, "b": b}), "date", "a", "b") == [(1, 4.0, 7.0), (2, 2.0, None), (3, None, 3.0)]


# --- Landing and gold ----------------------------------------------------------------------------


def raw(spark, data):
    return spark.createDataFrame([(s, day(d), v, dt.datetime.fromisoformat(i)) for s, d, v, i in data], schema("raw.series"))


def test_monthly_modes(spark):
    df = raw(spark, [
        ("FEDFUNDS", "2000-01-01", 1.0, "2024-01-01"), ("FEDFUNDS", "2000-01-01", 3.0, "2024-01-02"), ("FEDFUNDS", "2000-03-01", 2.0, "2024-01-01"),
        ("UNRATE", "2000-02-01", 5.0, "2024-01-01"), ("GDPC1", "2000-01-01", 10.0, "2024-01-01"), ("GDPC1", "2000-03-01", 16.0, "2024-01-01"),
        ("UNRATE", "2000-04-01", 6.0, "2024-01-01"), ("CPIAUCSL", "2000-05-01", None, "2024-01-01"), ("CPIAUCSL", "1979-05-01", 1.0, "2024-01-01"),
        ("OTHER", "2000-06-01", 1.0, "2024-01-01"),
    ])
    got = rows(landing.monthly_macro(df), "date", "fedfundrate", "realgdp")
    assert got == [(day("2000-01-01"), 3.0, 10.0), (day("2000-02-01"), None, 13.1), (day("2000-03-01"), 2.0, 16.0), (day("2000-04-01"), None, None)]
    full = rows(landing.monthly_macro(df, mode="full"), "date", "fedfundrate", "realgdp")
    assert full[1][1] == 2.48 and full[3][1:] == (2.0, 16.0)


def test_daily_takes_the_latest_ingest(spark):
    df = raw(spark, [
        ("DGS2", "1980-01-02", 1.0, "2024-01-01"), ("DGS2", "1980-01-02", 2.0, "2024-01-02"), ("DGS2", "1980-01-04", 3.0, "2024-01-01"),
        ("DGS10", "1980-01-05", 7.0, "2024-01-01"),
    ])
    got = rows(landing.daily_macro(df), "date", "marketyield2yr", "marketyield10yr", "inflationrate")
    assert [r[1] for r in got] == [2.0, 2.0, 2.5, 3.0, 3.0] and {r[2] for r in got} == {7.0} and {r[3] for r in got} == {None}


def test_weekly_features_drop_partial_weeks_after_the_fills(spark):
    days = [dt.date(1998, 12, 20) + dt.timedelta(days=i) for i in range(60)]
    daily = spark.createDataFrame([(d, 1.0, 2.0, 3.0, 4.0) for d in days], schema("landing.macro_daily"))
    monthly = spark.createDataFrame([(days[0], 1.0, 10.0, None, None, None, None), (days[49], 2.0, 17.0, None, None, None, None)], schema("landing.macro_monthly"))
    credit = spark.createDataFrame([(days[7], 2.5)], schema("landing.credit"))
    out = gold.weekly_features(daily, monthly, spark.createDataFrame([], schema("landing.sector")), credit)
    got = rows(out, "year", "week", "fedfundrate", "cpiurban", "delinq")
    assert [r[:2] for r in got] == [(1999, w) for w in range(1, 8)]
    assert [r[2] for r in got] == [1.0] * 5 + [2.0] * 2 and {r[4] for r in got} == {2.5}
    # Weeks 51 and 52 of 1998 and week 0 of 1999 are positions between the two known values as well.
    assert [round(r[3], 6) for r in got] == [round(10 + 7 * k / 8, 6) for k in range(3, 8)] + [17.0] * 2
    assert set(schema("gold.weekly").names) == set(out.columns)


# --- Risk ----------------------------------------------------------------------------------------


def test_components_and_index(spark, panel):
    frame, _ = panel
    n = 60
    rng = np.random.default_rng(8)
    macro = pd.DataFrame(rng.normal(size=(n, 4)), columns=["fedfundrate", "unemployrate", "cpiurban", "realgdp"])
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    df = spark.createDataFrame([(d, *map(float, r)) for d, r in zip(dates, macro.values)], "date DATE, fedfundrate DOUBLE, unemployrate DOUBLE, cpiurban DOUBLE, realgdp DOUBLE")
    z = ((macro - macro.rolling(30).mean()) / macro.rolling(30).std()).fillna(0)
    want = z.unemployrate * 0.3 + z.cpiurban * 0.3 + z.fedfundrate * 0.2 - z.realgdp * 0.2
    m = R.macro_risk(df)
    assert all(close(a[1], b, 1e-7) for a, b in zip(rows(m, "date", "macro_risk"), want))
    assert {r[0] for r in rows(R.macro_risk(df.select("date")), "macro_risk")} == {0.0}

    market = spark.createDataFrame([(dates[-1] + dt.timedelta(days=1), 0.5)], "date DATE, market_risk DOUBLE")
    news = spark.createDataFrame([(dates[0], 1.0)], "date DATE, news_risk DOUBLE")
    index = R.composite(m, market, news)
    mix = {d: 0.4 * v for d, v in zip(dates, want)}
    mix[dates[0]] += 0.25
    mix[dates[-1] + dt.timedelta(days=1)] = 0.175
    lo, hi = min(mix.values()), max(mix.values())
    got = {r.date: r for r in index.collect()}
    assert set(got) == set(mix) and all(close(got[d].cmri_normalized, (v - lo) / (hi - lo), 1e-7) for d, v in mix.items())

    level = lambda x: "Low" if x < 0.3 else "Medium" if x < 0.6 else "High"
    ordered = [got[d] for d in sorted(got)]
    alerts = set()
    for before, now in zip(ordered, ordered[1:]):
        if now.risk_level == "High":
            alerts.add((now.date, "warning"))
        if now.cmri_normalized - before.cmri_normalized > 0.1:
            alerts.add((now.date, "trend"))
        if level(now.cmri_normalized) != level(before.cmri_normalized):
            alerts.add((now.date, "level_change"))
    assert {(r.date, r.type) for r in R.risk_alerts(index).collect()} == alerts
    summary = R.risk_summary(index).first()
    tail = [r.cmri_normalized for r in ordered]
    assert close(summary.current_cmri, tail[-1]) and close(summary.week_average, sum(tail[-7:]) / 7) and close(summary.month_average, sum(tail[-30:]) / 30)
    short = R.risk_summary(index.filter(F.col("date") <= dates[9])).first()
    assert close(short.month_average, short.week_average)
    few = R.risk_summary(index.filter(F.col("date") <= dates[3])).first()
    assert few.week_average == few.current_cmri == few.month_average and few.trend_direction == "decreasing"


def test_flat_index_is_half(spark):
    assert rows(R.min_max(spark.createDataFrame([(1.0,), (1.0,)], "x DOUBLE"), "x"), "x_normalized") == [(0.5,), (0.5,)]


def test_news_risk_without_a_topic(spark):
    data = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "labor", float(i)) for i in range(31)]
    out = R.news_risk(spark.createDataFrame(data, "date DATE, topic STRING, avg_sentiment_score DOUBLE"))
    last = rows(out, "date", "news_risk")[-1][1]
    window = pd.Series(range(1, 31), dtype=float)
    assert close(last, -0.2 * (30 - window.mean()) / window.std())


# --- Scenarios -----------------------------------------------------------------------------------


def test_scenarios(spark):
    docs = [
        (1, '```json\n{"rows": [{"date": "2025-01-05", "rate": 1, "gdp": "2"}, {"date": "2025-01-12", "rate": "NaN"}, {"date": "2025-01-19", "rate": 9}]}\n```'),
        (2, '{"rows": [{"date": "2025-02-05", "rate": 3}, {"date": "2025-02-12", "rate": 5}]}'),
        (3, "no json"), (4, '{"rows": []}'), (5, None),
    ]
    df = spark.createDataFrame(docs, "run_id INT, text STRING")
    assert tuple(C.failed_scenarios(df).first()) == (3, 5)
    long = C.parse_scenarios(df)
    got = {(r.step, r.feature): (r.date, r.mean, r["std"]) for r in C.ensemble(long).collect()}
    assert got == {
        (0, "rate"): (day("2025-01-05"), 2.0, 1.0), (1, "rate"): (day("2025-01-12"), 5.0, 0.0), (0, "gdp"): (day("2025-01-05"), 2.0, 0.0),
    }


def test_recession_shock(spark):
    df = spark.createDataFrame(
        [(day("2024-01-15"), 4.0, 100.0, 0.0), (day("2024-11-30"), 5.0, 200.0, 0.0)], "date DATE, unemployrate DOUBLE, realgdp DOUBLE, recessionindicator DOUBLE"
    )
    out = rows(C.shock(df, ["unemployrate", "realgdp", "recessionindicator"]), "date", "unemployrate", "realgdp", "recessionindicator")
    assert [r[0] for r in out] == [day("2024-12-01")] + [day(f"2025-0{m}-01") for m in range(1, 6)] and {r[1:] for r in out} == {(9.0, 194.0, 1.0)}


# --- Registry ------------------------------------------------------------------------------------


def run(run_id, metrics, status="completed", model="m", data="d", at=1):
    return (run_id, model, data, '{"algorithm": "gb"}', metrics, "a", status, dt.datetime(2024, 1, at))


def test_best_run_and_promotion(spark):
    runs = spark.createDataFrame(
        [run("r1", '{"smape": 5}'), run("r2", '{"smape": 3}'), run("r3", '{"smape": 1}', "failed"), run("r4", "{}"), run("r0", '{"smape": 3}'),
         run("x", "oops", model="other")],
        schema("registry.training_run"),
    )
    best = G.best_run(runs)
    assert rows(best, "model_id", "run_id") == [("m", "r0"), ("other", "x")]

    def decide(metric, traffic=1.0):
        d = spark.createDataFrame([("m", "d1", traffic, dt.datetime(2024, 1, 1), metric)], "model_id STRING, deployment_id STRING, traffic_split DOUBLE, deployed_at TIMESTAMP, metrics STRING")
        return {r.model_id: r.decision for r in G.promotion(best, d).collect()}

    assert decide('{"smape": 3.04}') == {"m": "approved", "other": "approved"}
    assert decide('{"smape": 3.02}')["m"] == "candidate"
    assert decide('{"smape": 0}')["m"] == "candidate"
    assert decide('{"smape": "NaN"}')["m"] == "approved"
    assert decide('{"smape": 1}', traffic=0.0)["m"] == "approved"


def test_deploy_switches_one_model(spark):
    t = dt.datetime(2024, 1, 1)
    held = spark.createDataFrame(
        [("d1", "v1", "e", 1.0, t, "", "", ""), ("d2", "v2", "e", 0.5, t, "", "", ""), ("d3", "v3", "e", 1.0, t, "", "", "")], schema("registry.deployment")
    )
    versions = spark.createDataFrame([("v1", "m"), ("v2", "m"), ("v3", "n")], "model_version_id STRING, model_id STRING")
    new = spark.createDataFrame([("d4", "v4", "m", "approved"), ("d5", "v5", "n", "candidate")], "deployment_id STRING, model_version_id STRING, model_id STRING, decision STRING")
    assert rows(G.deploy(held, versions, new), "deployment_id", "traffic_split") == [("d1", 0.0), ("d2", 0.0), ("d3", 1.0), ("d4", 1.0)]
    staged = rows(G.deploy(held, versions, new, stage_candidates=True), "deployment_id", "traffic_split")
    assert ("d5", 0.0) in staged


def test_latest_metrics_skip_nulls(spark):
    runs = spark.createDataFrame([run("a", '{"mae": 1, "smape": 2}', at=1), run("b", '{"smape": 9}', at=2)], schema("registry.training_run"))
    row = G.latest_runs(runs).first()
    assert (row.model_name, row.MAE, row.SMAPE, row.R2) == ("gb", 1.0, 9.0, None)


def test_timeline(spark):
    t = dt.datetime(2024, 1, 1)
    d = spark.createDataFrame([("1", "a", 1.0, t), ("2", "b", 0.0, t), ("3", "b", None, None)], "deployment_id STRING, model_name STRING, traffic_split DOUBLE, deployed_at TIMESTAMP")
    assert rows(G.deployment_timeline(d, ["a", "b"])) == [("", "", "Inactive"), ("2024-01-01 00:00:00", "Active", "Inactive")]
    assert tuple(G.deployment_counts(d).first()) == (3, 1, 2)


# --- Models --------------------------------------------------------------------------------------


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(2)
    y, f = rng.normal(size=40), rng.normal(size=40)
    y[3] = f[3] = 0.0
    df = spark.createDataFrame([(2000, i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, f))], "year INT, week INT, y DOUBLE, f DOUBLE")
    got = M.forecast_metrics(df, ["year", "week"], "y", "f").first()
    assert close(got.smape, 100 * np.mean(np.abs(y - f) / np.maximum((np.abs(y) + np.abs(f)) / 2, 1e-8)))
    assert close(got.mase, np.mean(np.abs(y - f)) / (np.mean(np.abs(np.diff(y))) + 1e-8))
    assert close(got.rmse_recent6, math.sqrt(np.mean((y[-6:] - f[-6:]) ** 2)))
    assert close(got.r2, 1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum()) and close(got.pearson_r, np.corrcoef(y, f)[0, 1])
    flat = M.forecast_metrics(df.withColumn("f", F.lit(1.0)), ["year", "week"], "y", "f").first()
    assert flat.pearson_r is None
    single = M.forecast_metrics(df.limit(1), ["year", "week"], "y", "f").first()
    assert single.pearson_r is None and single.mase is None


def test_boosting_learns_from_equal_rows_as_one(spark):
    rng = np.random.default_rng(5)
    rows_ = [(float(i % 4), float(i % 3), float((i % 4) * (i % 3) + rng.normal())) for i in range(600)] + [(None, 1.0, 2.0), (1.0, None, None)]
    df = spark.createDataFrame(rows_, "a DOUBLE, b DOUBLE, y DOUBLE")
    filled = df.fillna(0.0)
    assert M._cells(filled, ["a", "b"], "y").count() == 12
    plain = M._fit(df, ["a", "b"], "y", GBTRegressor(labelCol="y", maxIter=4, stepSize=0.1, seed=M.SEED, maxDepth=2))
    told = lambda model: {(r.a, r.b): r.prediction for r in M.score(model, filled, ["a", "b"]).collect()}
    one, other = told(M.fit_gbt(df, ["a", "b"], "y", 4, max_depth=2)), told(plain)
    assert one.keys() == other.keys() and all(close(one[k], other[k]) for k in one)


def test_forest_of_many_rows_draws_them_into_sums(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(i % 4), float(i % 3), 10.0 * (i % 4) + (i % 3) + rng.normal()) for i in range(2400)], "a DOUBLE, b DOUBLE, y DOUBLE")
    told = lambda model: {(r.a, r.b): r.prediction for r in M.score(model, df, ["a", "b"]).collect()}
    plain = told(M.fit_forest(df, ["a", "b"], "y", 12, max_depth=4, feature_subset="all"))
    bags = {(r.t, r.n) for r in M._bags(df, ["a", "b"], "y", 12).groupBy(F.col("__tree").alias("t")).agg(F.sum(M.ROWS).alias("n")).collect()}
    # Each tree has draws of its own, as many as there are rows but for chance.
    assert len(bags) == 12 and all(2100 < n < 2700 for _, n in bags) and len({n for _, n in bags}) > 6
    monkeypatch.setattr(M, "BAG_ROWS", 100)
    model = M.fit_forest(df, ["a", "b"], "y", 12, max_depth=4, feature_subset="all")
    found = told(model)
    assert found.keys() == plain.keys() and all(abs(found[k] - plain[k]) < 0.2 for k in plain)
    assert model.stages[-1].getNumTrees == 12 and len({t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees}) > 1
    model.save(str(tmp_path / "forest"))
    assert told(PipelineModel.load(str(tmp_path / "forest"))) == found


def test_poisson_draws(spark):
    drawn = spark.range(200_000).withColumn("u", F.rand(3)).select(M._poisson(F.col("u")).alias("k"))
    mean, spread, zero = drawn.agg(F.avg("k"), F.var_pop("k"), F.avg((F.col("k") == 0).cast("double"))).first()
    assert abs(mean - 1) < 0.02 and abs(spread - 1) < 0.03 and abs(zero - 0.3679) < 0.01


def test_regimes_step_over_distinct_points(spark, monkeypatch):
    from tidemark.plans import clusters as K

    df = spark.createDataFrame([(float(i % 5), float(i % 2)) for i in range(300)] + [(50.0, 9.0)] * 20, "a DOUBLE, b DOUBLE")
    seen, lloyd = [], K.lloyd
    monkeypatch.setattr(K, "lloyd", lambda points, *rest: (seen.append(points), lloyd(points, *rest))[1])
    found = {(r.a, r.b): r.cluster for r in K.regimes(df, ["a", "b"], 2, 3).collect()}
    assert {k for k, c in found.items() if c == found[50.0, 9.0]} == {(50.0, 9.0)}
    assert seen[0].count() == 11 and seen[0].agg(F.sum("n")).first()[0] == 320
    single = df.select(F.array("a", "b").alias("x"))
    counted = single.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    centres = {0: [[0.0, 0.0], [40.0, 5.0]], 1: [[1.0, 1.0], [3.0, 0.0]]}
    one, other = K.lloyd_step(single, centres), K.lloyd_step(counted, centres)
    for s in centres:
        assert np.allclose(one[s][0], other[s][0]) and close(one[s][1], other[s][1])


def test_fits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = 3 * x[:, 0] - x[:, 1] + 5 + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "t INT, a DOUBLE, b DOUBLE, y DOUBLE")
    train, test = df.filter("t < 200"), df.filter("t >= 200")
    error = lambda m: M.score(m, test, ["a", "b"]).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error(M.fit_linear(train, ["a", "b"], "y")) < 0.15
    assert error(M.fit_forest(train, ["a", "b"], "y", 20, None, 2)) < 1.0
    assert error(M.fit_gbt(train, ["a", "b"], "y", 20)) < 1.0
    assert error(M.fit_gbt(train, ["a", "b"], "y", 10, num_leaves=31, subsample=0.8, colsample_bytree=0.8)) < 1.5
    model, params, mae = M.random_search(train, test, ["a", "b"], "y", "elastic_net", n=4)
    assert close(mae, error(model)) and set(params) == {"alpha", "l1_ratio"} and mae < 1.5
    with pytest.raises(RuntimeError):
        M.random_search(train, test, ["a", "b"], "y", "elastic_net", space={"nonsense": [1]}, n=2)
    _, shares = M.pca(df, ["a", "b", "y"], 2)
    frame = pd.DataFrame(np.column_stack([x, y]))
    want = np.sort(np.linalg.eigvalsh(frame.corr()))[::-1] / 3
    assert all(close(a, b, 1e-8) for a, b in zip(shares, want))


def test_elastic_net_optimum(spark):
    """At the optimum of the restated problem the subgradient of every active coefficient is zero."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2]
    y = 30 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=400)
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    alpha, ratio = 0.5, 0.3
    fitted = M.fit_elastic(df, ["a", "b", "c"], "y", alpha, ratio).stages[-1]
    b = np.array(fitted.coefficients)
    rest = y - x @ b - fitted.intercept
    for j in range(3):
        grad = -(x[:, j] * rest).mean() + alpha * (1 - ratio) * b[j]
        assert abs(grad + alpha * ratio * np.sign(b[j])) < 1e-3 if b[j] else abs(grad) <= alpha * ratio + 1e-6


def test_regimes_find_three_groups(spark):
    rng = np.random.default_rng(9)
    # On raw columns the second one, a thousand times as wide, would decide alone.
    data = [(g, float(g * 10 + rng.normal()), float(10_000 * (g == 1) + 500 * rng.normal())) for g in range(3) for _ in range(50)]
    out = M.regimes(spark.createDataFrame(data, "g INT, a DOUBLE, b DOUBLE"), ["a", "b"], 3, starts=3)
    assert out.groupBy("g").agg(F.countDistinct("cluster").alias("n")).filter("n > 1").count() == 0
    assert M.cluster_profile(out, ["a"]).count() == 3


def test_forecast_recursion(spark):
    data = [("s", i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 5.0])] + [("t", i, 2.0**i) for i in range(6)]
    fit = M.fit_ar1(spark.createDataFrame(data, "k STRING, t INT, y DOUBLE"), "t", "y", "k")
    got = {(r.k, r.step): r.forecast for r in M.forecast_ar1(fit, 2).collect()}
    assert all(close(got[k], v) for k, v in {("s", 1): 6.0, ("s", 2): 7.0, ("t", 1): 64.0, ("t", 2): 128.0}.items())


def test_lag_search_finds_the_second_lag(spark):
    rng = np.random.default_rng(11)
    y = [0.0, 1.0]
    for _ in range(400):
        y.append(0.9 * y[-2] + float(rng.normal()))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(y)], "t INT, y DOUBLE")
    _, p, mae = M.search_arx(df, "t", "y", ps=[1, 2], holdout=100)
    assert p == 2 and mae < 1.2


def test_error_columns(spark):
    df = spark.createDataFrame([(2.0, 2.5), (0.0, 1.0)], "y DOUBLE, prediction DOUBLE")
    assert rows(M.with_errors(df, "y"), "error", "abs_error", "pct_error") == [(0.5, 0.5, 25.0), (1.0, 1.0, None)]
    assert M.draws({"a": [1, 2]}, 5, 1) == M.draws({"a": [1, 2]}, 5, 1) and M.draws({}) == [{}]


def test_quantiles_take_nan_as_null(spark):
    from tidemark.operators import profile

    rng = np.random.default_rng(3)
    values = [float(v) for v in rng.integers(0, 40, 3000)] + [float("nan")] * 300 + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    clean = np.array([v for v in values if v is not None and v == v])
    want = np.quantile(clean, [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])
    for limit in (1, 30, 10**6):
        got = profile.exact_quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0], limit=limit, error=0.05)["v"]
        assert np.allclose(got, want)
        row = profile.describe_long(df, "v", limit=limit).first()
        assert close(row["mean"], clean.mean()) and close(row["p25"], float(want[2]))
