"""Stored models, multi-step forecasts, least squares, searches."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import close
from tidemark.functions.linear import co_moments, fitted, least_squares
from tidemark.operators.relate import adf_stat
from tidemark.plans import clusters as K, forecast as A, models as M, search as S, serving as V
from tidemark.schemas import schema

NOW = dt.datetime(2025, 1, 1)


def weekly(spark, n=160, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.uniform(-3, 3), rng.uniform(0, 5)
        rows.append((2000 + i // 52, 1 + i % 52, a if i % 17 else None, b, 2 * a + 10 * (b > 2.5) + rng.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "year int, week int, a double, b double, delinq double")


def test_least_squares_matches_numpy(spark):
    rng = np.random.default_rng(4)
    rows = []
    for key, n in (("x", 60), ("y", 9), ("flat", 20), ("few", 3)):
        for i in range(n):
            z = rng.normal(size=3)
            z[2] = 5.0 if key == "flat" else z[2]
            rows.append((key, *map(float, z), float(1 + z @ [2.0, -1.0, 0.5] + rng.normal() * 0.3)))
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, y double")
    sums = df.groupBy("k").agg(*[c.alias(n) for n, c in co_moments(["a", "b", "c"], "y").items()])
    got = {r["k"]: r for r in sums.withColumns(least_squares(3)).select("k", *[c.alias(n) for n, c in fitted(3).items()]).collect()}
    for key in ("x", "y"):
        own = np.array([r[1:] for r in rows if r[0] == key])
        z = np.column_stack([np.ones(len(own)), own[:, :3]])
        beta, rest, *_ = np.linalg.lstsq(z, own[:, 3], rcond=None)
        error = np.sqrt(np.diag(np.linalg.inv(z.T @ z)) * rest[0] / (len(own) - 4))
        assert np.allclose([got[key]["intercept"], *got[key]["coefs"]], beta) and close(got[key]["rss"], rest[0], 1e-8)
        assert np.allclose(got[key]["errors"], error[1:])
    assert got["flat"]["intercept"] is None and got["few"]["errors"] == [None] * 3


def test_forecast_carries_on(spark):
    rng = np.random.default_rng(1)
    rows, truth = [], {}
    for key, n in (("a", 90), (None, 70)):
        y, x = [1.0, 2.0], rng.normal(size=n + 15)
        for t in range(2, n):
            y.append(0.5 + 0.6 * y[-1] - 0.3 * y[-2] + 2 * x[t] + rng.normal() * 0.1)
        rows += [(key, t, float(y[t]), float(x[t])) for t in range(n)]
        truth[key] = y, x, n
    rows += [("short", 0, 1.0, 1.0), ("short", 1, 2.0, 1.0)] + [("hole", t, None if t == 29 else float(t % 5), float(t % 3)) for t in range(30)]
    df = spark.createDataFrame(rows, "k string, t int, y double, x double")
    ahead = spark.createDataFrame([(k, n + i, float(x[n + i])) for k, (_, x, n) in truth.items() for i in range(15)] + [("hole", 30, 1.0), ("short", 2, 1.0), ("new", 0, 1.0)], "k string, t int, x double")
    got = {}
    for r in A.forecast(A.fit_ar(df, "t", "y", ["x"], 2, "k"), ahead, "t", ["x"], "k").collect():
        got.setdefault(r["k"], []).append((r["step"], r["t"], r["forecast"]))
    for key, (y, x, n) in truth.items():
        z = np.array([[1, y[t - 1], y[t - 2], x[t]] for t in range(2, n)])
        beta = np.linalg.lstsq(z, np.array(y[2:]), rcond=None)[0]
        path = list(y)
        for t in range(n, n + 15):
            path.append(beta @ [1, path[-1], path[-2], x[t]])
        assert [(s, t) for s, t, _ in sorted(got[key])] == [(i + 1, n + i) for i in range(15)]
        assert np.allclose([v for _, _, v in sorted(got[key])], path[n:])
    assert got["hole"] == [(1, 30, None)] and got["short"] == [(1, 2, None)] and got["new"] == [(1, 0, None)]


def test_forecast_without_key_or_driver(spark):
    df = spark.createDataFrame([(t, float((-1) ** t) + 0.01 * t) for t in range(40)], "t int, y double")
    params = A.fit_ar(df, "t", "y", p=1, segment=3)
    got = [r["forecast"] for r in A.forecast(params, spark.range(40, 43).selectExpr("cast(id as int) t"), "t").orderBy("step").collect()]
    a, b = M.fit_ar1(df, "t", "y").select("intercept", "slope").first()
    want, last = [], df.orderBy(F.desc("t")).first()["y"]
    for _ in range(3):
        last = a + b * last
        want.append(last)
    assert np.allclose(got, want)
    best = A.search_ar(df, "t", "y", ps=(1, 2), holdout=8).collect()
    assert len(best) == 1 and best[0]["p"] in (1, 2)


def test_search_picks_lags_per_key(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key, coefs in (("one", (0.8,)), ("three", (0.2, 0.1, 0.6))):
        y = [1.0, 2.0, 0.5]
        for t in range(3, 300):
            y.append(sum(c * y[-1 - i] for i, c in enumerate(coefs)) + rng.normal() * 0.01)
        rows += [(key, t, float(v)) for t, v in enumerate(y)]
    df = spark.createDataFrame(rows, "k string, t int, y double")
    got = {r["k"]: (r["p"], r["mae"]) for r in A.search_ar(df, "t", "y", holdout=10, e="k").collect()}
    for key in ("one", "three"):
        errors = {}
        for p in (1, 2, 3):
            own = [r[2] for r in rows if r[0] == key]
            train, test = own[:-10], own[-10:]
            z = np.array([[1, *train[t - p:t][::-1]] for t in range(p, len(train))])
            beta = np.linalg.lstsq(z, np.array(train[p:]), rcond=None)[0]
            path = list(train)
            for _ in range(10):
                path.append(beta @ [1, *path[-p:][::-1]])
            errors[p] = np.mean(np.abs(np.array(path[-10:]) - test))
        best = min(errors, key=errors.get)
        assert got[key][0] == best and close(got[key][1], errors[best], 1e-6)


@pytest.mark.parametrize("name,params", [("base", {}), ("linear_regression", {}), ("random_forest", {"n_estimators": 5, "max_depth": 3}), ("gradient_boosting", {"n_estimators": 5})])
def test_a_stored_model_serves_what_was_fitted(spark, tmp_path, name, params):
    df = weekly(spark)
    split = df.withColumn("split", F.when(F.col("year") >= 2002, "test").otherwise("train")).cache()
    run = V.train_run(split, "delinq", ["a", "b"], root=str(tmp_path), run_id="r1", model_id="m", dataset_id="d", name=name, created_at=NOW, params=params)
    assert run.schema.names == schema("registry.training_run").names and run.first()["status"] == "completed"
    versions, deployments = V.release(run, *V.empty_registry(spark), NOW)
    live = V.deployed(deployments, versions, run, "m")
    assert (live.algorithm, live.model_version_id) == (name, "version_r1")
    assert V.features_of(live.model) == ([] if name == "base" else ["a", "b"])
    test = split.filter("split = 'test'").drop("split")
    served = {(r["year"], r["week"]): r for r in V.serve_history(test, live, limit=None).collect()}
    fitted_ = V.fit_algorithm(name, split.filter("split = 'train'"), ["a", "b"], "delinq", ["year", "week"], params)
    for r in M.score(fitted_, test, ["a", "b"]).collect():
        own = served[r["year"], r["week"]]
        assert own["prediction"] == r["prediction"] and close(own["error"], r["prediction"] - r["delinq"]) and own["label"] == f"{r['year']}-W{r['week']:02d}"
    assert len(served) == test.count() and close(float(PipelineModel.load(live.model and run.first()["artifact"]).transform(test.fillna(0.0)).first()["prediction"]), served[2002, 1]["prediction"])


def test_serving_filters_missing_columns_and_order(spark, tmp_path):
    df = weekly(spark)
    split = df.withColumn("rn", F.lit(1.0)).withColumn("split", F.when(F.col("year") >= 2002, "test").otherwise("train")).cache()
    run = V.train_run(split, "delinq", ["a", "b", "rn"], root=str(tmp_path), run_id="r1", model_id="m", dataset_id="d", name="random_forest", created_at=NOW, params={"n_estimators": 3, "max_depth": 2})
    versions, deployments = V.release(run, *V.empty_registry(spark), NOW)
    live = V.deployed(deployments, versions, run, "m")
    assert V.serve_history(df, live, limit=7).count() == 7
    assert {(r["year"], r["week"]) for r in V.serve_history(df, live, day="2001-03-11").select("year", "week").collect()} == {(2001, 10)}
    dated = spark.createDataFrame([(dt.date(2025, 1, 5), 1.0), (dt.date(2025, 1, 12), None), (dt.date(2025, 2, 2), 2.0)], "date date, a double")
    got = V.serve_scenario(dated, live, start="2025-01-10").orderBy("date").collect()
    assert [r["label"] for r in got] == ["2025-01-12", "2025-02-02"] and all(r["prediction"] is not None for r in got)
    with pytest.raises(LookupError):
        V.deployed(deployments, versions, run, "another")


def test_release_replaces_on_a_gain_only(spark):
    def run(id_, smape, model="m", status="completed"):
        return (id_, model, "d", '{"algorithm":"x"}', None if smape is None else f'{{"smape":{smape}}}', f"path/{id_}", status, NOW)

    def runs(*rows):
        return spark.createDataFrame(list(rows), schema("registry.training_run"))

    first = runs(run("r1", 10.0), run("r2", None, status="failed"), run("q1", 3.0, "other"))
    versions, deployments = V.release(first, *V.empty_registry(spark), NOW)
    assert sorted((r["deployment_id"], r["traffic_split"]) for r in deployments.collect()) == [("deployment_q1", 1.0), ("deployment_r1", 1.0)]
    for smape, status, traffic in ((9.95, "candidate", {"deployment_r1": 1.0, "deployment_q1": 1.0}), (9.0, "approved", {"deployment_r1": 0.0, "deployment_q1": 1.0, "deployment_r3": 1.0})):
        later = first.unionByName(runs(run("r3", smape)))
        v, d = V.release(later, versions, deployments, NOW + dt.timedelta(days=1))
        assert {r["model_version_id"]: r["status"] for r in v.collect()}["version_r3"] == status
        assert {r["deployment_id"]: r["traffic_split"] for r in d.collect()} == traffic


def test_failed_run(spark, tmp_path):
    split = weekly(spark).withColumn("split", F.when(F.col("year") >= 2002, "test").otherwise("train"))
    run = V.train_run(split, "delinq", ["a"], root=str(tmp_path), run_id="bad", model_id="m", dataset_id="d", name="random_forest", created_at=NOW, params={"n_estimators": -1}).first()
    assert run["status"] == "failed" and run["artifact"] is None and run["metrics"] is None


def test_rungs():
    assert S.rungs(20, 3) == [1 / 9, 1 / 3, 1] and S.rungs(1, 3) == [1] and S.rungs(3, 3) == [1] and S.rungs(4, 3) == [1 / 3, 1]
    assert S.reduced("random_forest", {"n_estimators": 300}, 1 / 9)["n_estimators"] == 33
    assert S.reduced("gradient_boosting", {"n_estimators": 2}, 1 / 9)["n_estimators"] == 2


def test_halving_finds_the_full_searchs_winner(spark):
    df = weekly(spark, 400).coalesce(1).cache()
    train, valid = df.filter("year < 2006"), df.filter("year >= 2006")
    space = {"n_estimators": [1, 12], "learning_rate": [0.01, 0.4], "max_depth": [1, 3]}
    found = S.halving_search(train, valid, ["a", "b"], "delinq", "gradient_boosting", space, n=20)
    _, params, mae = M.random_search(train, valid, ["a", "b"], "delinq", "gradient_boosting", space, n=20)
    assert found.params == params and close(found.mae, mae)
    by_rung = [sum(t[0] == r for t in found.tried) for r in range(2)]
    assert by_rung[1] == -(-by_rung[0] // 3) and {t[1] for t in found.tried} == {1 / 3, 1}
    stopped = S.halving_search(train, valid, ["a", "b"], "delinq", "gradient_boosting", {**space, "n_estimators": [40]}, n=6, stop_gain=0.05)
    assert stopped.model.stages[-1].getNumTrees < 40
    with pytest.raises(RuntimeError):
        S.halving_search(train, valid, ["a", "b"], "delinq", "elastic_net", {"alpha": [-1.0]}, n=3)


def test_adf_matches_least_squares(spark):
    rng = np.random.default_rng(11)
    series = {"walk": np.cumsum(rng.normal(size=120)), "back": None, "two": None}
    y = [0.0, 0.0]
    for _ in range(118):
        y.append(0.4 * y[-1] + 0.3 * (y[-1] - y[-2]) + rng.normal())
    series["back"] = np.array(y)
    series["two"] = np.array([1.0, 2.0])
    df = spark.createDataFrame([(k, t, float(v)) for k, s in series.items() for t, v in enumerate(s)], "k string, t int, v double")
    got = {r["k"]: r for r in adf_stat(df, "t", "v", 3, "k").collect()}
    assert got["two"]["adf_t"] is None

    def fit(s, p, first):
        d = np.diff(s)
        z = np.array([[1, s[t], *[d[t - j] for j in range(1, p + 1)]] for t in range(first, len(d))])
        target = d[first:]
        beta = np.linalg.lstsq(z, target, rcond=None)[0]
        rss = ((target - z @ beta) ** 2).sum()
        error = np.sqrt(np.linalg.inv(z.T @ z)[1, 1] * rss / (len(target) - p - 2))
        return len(target), beta[1], beta[1] / error, len(target) * np.log(rss / len(target)) + 2 * (p + 2)

    for key in ("walk", "back"):
        best = min(range(4), key=lambda p: fit(series[key], p, 3)[3])
        n, slope, t, _ = fit(series[key], best, best)
        assert (got[key]["lags"], got[key]["n_obs"]) == (best, n) and close(got[key]["slope"], slope, 1e-8) and close(got[key]["adf_t"], t, 1e-8)
    one = adf_stat(df.filter("k = 'walk'").drop("k"), "t", "v", 3).collect()
    assert len(one) == 1 and close(one[0]["adf_t"], got["walk"]["adf_t"])


def test_regimes_are_as_tight_as_single_fits(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.4, size=(80, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    df = spark.createDataFrame([tuple(map(float, p)) for p in points] + [(None, 1.0)], "a double, b double")
    found = K.regimes(df, ["a", "b"], 3, starts=10).collect()
    assert len(found) == 240 and len({r["cluster"] for r in found}) == 3
    z = (points - points.mean(0)) / points.std(0)
    own = {(r["a"], r["b"]): r["cluster"] for r in found}
    label = np.array([own[tuple(map(float, p))] for p in points])
    cost = sum(((z[label == j] - z[label == j].mean(0)) ** 2).sum() for j in range(3))
    scaled = spark.createDataFrame([(Vectors.dense(p),) for p in z], ["features"])
    assert cost <= min(KMeans(k=3, seed=s).fit(scaled).summary.trainingCost for s in range(5)) * (1 + 1e-9)
    assert K.regimes(df.limit(0), ["a", "b"]).count() == 0
    same = K.regimes(spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double"), ["a", "b"], 3, starts=2)
    assert same.count() == 5 and same.select("cluster").distinct().count() == 1
