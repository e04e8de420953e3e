"""Forecast models, metrics, regimes, scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.profile import zscore
from tidemark.operators.reshape import to_long
from tidemark.operators.rolling import with_lags
from tidemark.plans import clusters as K, models as M, scenario as C
from tidemark.session import stage
from workload.frames import PRIORITIES, cte, daily, daily_staged, dense_staged, r6, table, weekly, wide
from workload.register import query

X = ["l_quantity", "l_discount", "l_tax"]
Y = "l_extendedprice"
#: The centres move a little in the last iteration of k-means.
_SLACK = 0.01


def _line(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *X, Y)


def _train_test(spark, sf):
    """The last ship year is the hold-out."""
    line = _line(spark, sf)
    late = F.col("l_shipdate") >= F.lit("2001-01-01").cast("date")
    return line.filter(~late), line.filter(late)


def _coefficients(spark, model):
    fitted = model.stages[-1]
    return spark.createDataFrame(
        [(round(float(fitted.coefficients[0]), 3), round(float(fitted.intercept), 2))], "slope DOUBLE, intercept DOUBLE"
    )


@query(
    "m01_baseline",
    cte("daily") + "SELECT series, ROUND(AVG(value), 6) AS baseline FROM (SELECT * FROM daily QUALIFY ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) <= 3) GROUP BY 1",
)
def base(spark, sf):
    return r6(M.baseline(daily(spark, sf), "date", "value", "series"), "baseline")


@query("m02_linear", "SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 3) AS slope, ROUND(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem")
def linear(spark, sf):
    return _coefficients(spark, M.fit_linear(_line(spark, sf), ["l_quantity"], Y))


@query(
    "m03_elastic_net",
    """WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS v, AVG(l_extendedprice) AS my, AVG(l_quantity) AS mx FROM lineitem),
    b AS (SELECT sign(c) * greatest(abs(c) - 10.0 * 0.3, 0) / (v + 10.0 * 0.7) AS slope, mx, my FROM s)
    SELECT ROUND(slope, 3) AS slope, ROUND(my - slope * mx, 2) AS intercept FROM b""",
)
def elastic(spark, sf):
    return _coefficients(spark, M.fit_elastic(_line(spark, sf), ["l_quantity"], Y, alpha=10.0, l1_ratio=0.3))


def _quality(model, train, test, algorithm):
    """Rows of the hold-out, and whether the model's squared error on the rows it learnt from is below that of their
    mean. The price does not depend on the features, so that nothing is to be gained on the hold-out itself."""
    spread = train.agg(F.var_pop(Y)).first()[0]
    error = F.col(Y) - F.col("prediction")
    fitted = M.score(model, train, X).agg(F.avg(error * error)).first()[0] < spread
    return M.score(model, test, X).agg(
        F.lit(algorithm).alias("algorithm"), F.count("prediction").alias("n"), F.lit(fitted).alias("fits_train")
    )


def _staged_split(spark, sf):
    return [stage(part, "model") for part in _train_test(spark, sf)]


def _fits_train(algorithm):
    return f"SELECT '{algorithm}' AS algorithm, COUNT(*) AS n, TRUE AS fits_train FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'"


@query("m04_random_forest", _fits_train("random_forest"))
def forest(spark, sf):
    train, test = _staged_split(spark, sf)
    return _quality(M.fit_forest(train, X, Y, n_estimators=100, max_depth=5), train, test, "random_forest")


@query("m05_gradient_boosting", _fits_train("gradient_boosting"))
def boosting(spark, sf):
    train, test = _staged_split(spark, sf)
    return _quality(M.fit_gbt(train, X, Y, n_estimators=100), train, test, "gradient_boosting")


@query("m06_random_search", _fits_train("elastic_net"))
def search(spark, sf):
    """20 draws, chosen on the last year before the hold-out and fitted again on all training rows."""
    train, test = _staged_split(spark, sf)
    late = F.col("l_shipdate") >= F.lit("2000-01-01").cast("date")
    _, params, _ = M.random_search(train.filter(~late), train.filter(late), X, Y, "elastic_net")
    return _quality(M.FITS["elastic_net"](train, X, Y, **params), train, test, "elastic_net")


_LATE = "l_shipdate >= TIMESTAMP '2001-01-01'"


@query(
    "m06_random_search_linear",
    f"""WITH f AS (SELECT regr_intercept({Y}, l_quantity) AS a, regr_slope({Y}, l_quantity) AS b FROM lineitem WHERE NOT {_LATE})
    SELECT ROUND(AVG(abs({Y} - a - b * l_quantity)), 4) AS mae, COUNT(*) AS n FROM lineitem, f WHERE {_LATE}""",
)
def search_linear(spark, sf):
    train, test = _train_test(spark, sf)
    model, _, _ = M.random_search(train, test, ["l_quantity"], Y, "linear_regression")
    scored = M.score(model, test, ["l_quantity"])
    return scored.agg(F.round(F.avg(F.abs(F.col(Y) - F.col("prediction"))), 4).alias("mae"), F.count(F.lit(1)).alias("n"))


_AR = (
    cte("daily")
    + """, l AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p FROM daily),
    f AS (SELECT series, regr_intercept(value, p) AS a, regr_slope(value, p) AS b, arg_max(value, date) AS v FROM l GROUP BY 1),
    s1 AS (SELECT series, a, b, a + b * v AS f FROM f), s2 AS (SELECT series, a, b, a + b * f AS f FROM s1), s3 AS (SELECT series, a, b, a + b * f AS f FROM s2)
    SELECT series, CAST(1 AS INTEGER) AS step, ROUND(f, 4) AS forecast FROM s1 UNION ALL SELECT series, 2, ROUND(f, 4) FROM s2 UNION ALL SELECT series, 3, ROUND(f, 4) FROM s3"""
)


@query("m07_ar1_forecast", _AR)
def ar1(spark, sf):
    return r6(M.forecast_ar1(M.fit_ar1(daily_staged(spark, sf), "date", "value", "series"), 3), "forecast", digits=4)


_ARX = [f"{c}__lag_{k}" for c in ("value", "driver") for k in (1, 2)]


@query("m07_arx")
def arx(spark, sf, keep=False):
    d = stage(dense_staged(spark, sf).fillna(0.0, subset=["value"]).withColumn("driver", F.month("date").cast("double")), "arx")
    model = M.fit_arx(d, "date", "value", ["driver"], 2, "series")
    frame = M.arx_frame(d, "date", "value", ["driver"], 2, "series")
    scored = M.score(model, frame, _ARX)
    return scored if keep else scored.select("series", "date", "value", "prediction")


@query("m07_arx_normal_equations", cte("dense") + "SELECT COUNT(*) - 2 * COUNT(DISTINCT series) AS n, CAST(0 AS BIGINT) AS correlated FROM dense")
def arx_normal(spark, sf):
    """Residuals of a least-squares fit are orthogonal to every regressor; counts those that are not."""
    out = arx(spark, sf, keep=True)
    residual = F.col("value") - F.col("prediction")
    scale = F.sum(residual * residual)
    tests = [F.lit(1.0), *[F.col(c) for c in _ARX]]
    off = [F.abs(F.sum(residual * t)) > 1e-6 * F.sqrt(scale * F.sum(t * t)) for t in tests]
    return out.agg(F.count(F.lit(1)).alias("n"), sum((o.cast("long") for o in off[1:]), off[0].cast("long")).alias("correlated"))


@query(
    "m07_arx_pooled",
    cte("daily")
    + """, l AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p FROM daily), f AS (SELECT regr_intercept(value, p) AS a, regr_slope(value, p) AS b FROM l)
    SELECT series, date, ROUND(a + b * p, 3) AS prediction FROM l, f WHERE p IS NOT NULL""",
)
def arx_pooled(spark, sf):
    d = daily_staged(spark, sf)
    model = M.fit_arx(d, "date", "value", (), 1, "series")
    scored = M.score(model, M.arx_frame(d, "date", "value", (), 1, "series"), ["value__lag_1"])
    return r6(scored, "prediction", digits=3).select("series", "date", "prediction")


@query(
    "m07_search_arx",
    cte("daily")
    + """, l AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p, LAG(value, 2) OVER (PARTITION BY series ORDER BY date) AS q FROM daily),
    n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) <= 100 AS late FROM l WHERE p IS NOT NULL),
    f AS (SELECT regr_intercept(value, p) AS a, regr_slope(value, p) AS b FROM n WHERE NOT late),
    one AS (SELECT 1 AS lags, AVG(abs(value - a - b * p)) AS mae FROM n, f WHERE late),
    n2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) <= 100 AS late2 FROM l WHERE q IS NOT NULL),
    m AS (SELECT var_pop(p) AS vp, var_pop(q) AS vq, covar_pop(p, q) AS pq, covar_pop(p, value) AS py, covar_pop(q, value) AS qy,
        AVG(p) AS mp, AVG(q) AS mq, AVG(value) AS my FROM n2 WHERE NOT late2),
    g AS (SELECT (py * vq - qy * pq) / (vp * vq - pq * pq) AS b, (qy * vp - py * pq) / (vp * vq - pq * pq) AS c, mp, mq, my FROM m),
    two AS (SELECT 2 AS lags, AVG(abs(value - my - b * (p - mp) - c * (q - mq))) AS mae FROM n2, g WHERE late2)
    SELECT CAST(lags AS BIGINT) AS lags, ROUND(mae, 3) AS mae FROM (SELECT * FROM one UNION ALL SELECT * FROM two) ORDER BY mae, lags LIMIT 1""",
)
def arx_search(spark, sf):
    _, lags, mae = M.search_arx(daily_staged(spark, sf), "date", "value", ps=[1, 2], holdout=100, e="series")
    return spark.createDataFrame([(lags, round(mae, 3))], "lags BIGINT, mae DOUBLE")


_NAIVE = cte("daily") + ", n AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS yhat FROM daily), k AS (SELECT * FROM n WHERE yhat IS NOT NULL) "


def _naive(spark, sf):
    lagged = with_lags(daily_staged(spark, sf), "date", "value", [1], "series").withColumnRenamed("value__lag_1", "yhat")
    return stage(lagged.dropna(subset=["yhat"]), "naive")


@query(
    "m08_forecast_metrics",
    _NAIVE
    + """, z AS (SELECT *, abs(value - LAG(value) OVER (PARTITION BY series ORDER BY date)) AS st, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) AS k FROM k)
    SELECT series, COUNT(*) AS test_count, ROUND(100 * AVG(abs(value - yhat) / greatest((abs(value) + abs(yhat)) / 2, 1e-8)), 6) AS smape,
    ROUND(AVG(abs(value - yhat)), 4) AS mae, ROUND(sqrt(AVG((value - yhat) * (value - yhat)) FILTER (k <= 6)), 4) AS rmse_recent6,
    ROUND(AVG(abs(value - yhat)) / (AVG(st) + 1e-8), 6) AS mase, ROUND(1 - SUM((value - yhat) * (value - yhat)) / (var_pop(value) * COUNT(*)), 6) AS r2,
    ROUND(corr(value, yhat), 8) AS pearson_r FROM z GROUP BY 1""",
)
def metrics(spark, sf):
    out = M.forecast_metrics(_naive(spark, sf), "date", "value", "yhat", "series")
    out = r6(r6(out, "smape", "mase", "r2"), "mae", "rmse_recent6", digits=4)
    return r6(out, "pearson_r", digits=8)


@query(
    "m09_score_errors",
    _NAIVE + "SELECT series, date, ROUND(yhat - value, 4) AS error, ROUND(abs(yhat - value), 4) AS abs_error, ROUND((yhat - value) / value * 100, 2) + 0.0 AS pct_error FROM k",
)
def errors(spark, sf):
    out = M.with_errors(_naive(spark, sf), "value", "yhat")
    return r6(out, "error", "abs_error", digits=4).select("series", "date", "error", "abs_error", "pct_error")


@query("m10_pca")
def components(spark, sf):
    scores, shares = M.pca(_line(spark, sf), [*X, Y], 2)
    return scores.agg(
        *[F.lit(s).alias(f"share_{i + 1}") for i, s in enumerate(shares)], *[F.var_pop(f"pc{i + 1}").alias(f"variance_{i + 1}") for i in range(2)]
    )


@query("m10_pca_trace", "SELECT 1.0::DOUBLE AS share, 4.0::DOUBLE AS variance, COUNT(*) AS n FROM lineitem")
def components_trace(spark, sf):
    """All components of four standardised columns: their shares sum to 1, their variances to 4."""
    scores, shares = M.pca(_line(spark, sf), [*X, Y], 4)
    variance = sum((F.var_pop(f"pc{i}") for i in range(2, 5)), F.var_pop("pc1"))
    return scores.agg(F.lit(round(sum(shares), 8)).alias("share"), F.round(variance, 6).alias("variance"), F.count(F.lit(1)).alias("n"))


@query(
    "m10_pca_pair",
    "SELECT ROUND((1 + abs(corr(l_quantity, l_extendedprice))) / 2, 8) AS share_1, ROUND((1 - abs(corr(l_quantity, l_extendedprice))) / 2, 8) AS share_2 FROM lineitem",
)
def components_pair(spark, sf):
    """Two standardised columns have the eigenvalues 1 + |r| and 1 - |r|."""
    _, shares = M.pca(_line(spark, sf), ["l_quantity", Y], 2)
    return spark.createDataFrame([tuple(round(s, 8) for s in shares)], "share_1 DOUBLE, share_2 DOUBLE")


@query("m11_regimes")
def regime(spark, sf):
    return M.cluster_profile(M.regimes(_line(spark, sf), X, 3, starts=10), X)


@query("m11_nearest_centre", "SELECT CAST(3 AS BIGINT) AS clusters, COUNT(*) AS n, CAST(0 AS BIGINT) AS misplaced FROM lineitem")
def nearest(spark, sf):
    """Rows that lie nearer to another cluster's centre than to their own's, on standardised columns."""
    scaled = zscore(_line(spark, sf), X, suffix="_std")
    z = [f"{c}_std" for c in X]
    found = stage(M.regimes(scaled, X, 3, starts=10), "regimes")
    centres = found.groupBy("cluster").agg(F.array(*[F.avg(c) for c in z]).alias("at")).agg(
        F.map_from_entries(F.collect_list(F.struct("cluster", "at"))).alias("centres")).first()["centres"]
    far = {k: sum(((F.col(c) - F.lit(v)) ** 2 for c, v in zip(z, at)), F.lit(0.0)) for k, at in centres.items()}
    own = F.coalesce(*[F.when(F.col("cluster") == k, d) for k, d in far.items()])
    return found.agg(
        F.count_distinct("cluster").alias("clusters"), F.count(F.lit(1)).alias("n"), F.count_if(F.least(*far.values()) < own * (1 - _SLACK) - _SLACK).alias("misplaced")
    )


_Z = [f"z{i}" for i in range(len(X))]
_BEGIN = [[-1.0] * len(X), [0.0] * len(X), [1.0] * len(X)]


def _lloyd_sql(steps: int) -> str:
    """Steps of k-means in SQL, from the same first centres."""
    scaled = ", ".join(f"({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER () AS {z}" for c, z in zip(X, _Z))
    first = " UNION ALL ".join(f"SELECT {j} AS cluster, " + ", ".join(f"{v}::DOUBLE AS {z}" for v, z in zip(c, _Z)) for j, c in enumerate(_BEGIN))
    out = f"WITH p AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS id, {scaled} FROM lineitem), c0 AS ({first})"
    far = " + ".join(f"(p.{z} - c.{z}) * (p.{z} - c.{z})" for z in _Z)
    means = ", ".join(f"AVG({z}) AS {z}" for z in _Z)
    for i in range(steps):
        out += f", n{i} AS (SELECT id, arg_min(cluster, ({far}, cluster)) AS cluster FROM p, c{i} c GROUP BY id)" + f", c{i + 1} AS MATERIALIZED (SELECT cluster, {means}, COUNT(*) AS n FROM p JOIN n{i} USING (id) GROUP BY cluster)"
    return out + f" SELECT n, {', '.join(f'ROUND({z}, 6) AS {z}' for z in _Z)} FROM c{steps}"


@query("m11_three_steps", _lloyd_sql(3))
def three_steps(spark, sf):
    """Three steps of k-means from given centres: the centres and the rows nearest to those one step before."""
    scaled, zs = K.standardised(_line(spark, sf), X)
    points = stage(scaled.select(F.array(*zs).alias("x")), "points")
    at = {0: _BEGIN, 1: [list(c) for c in reversed(_BEGIN)]}
    for _ in range(2):
        at = {s: c for s, (c, _) in K.lloyd_step(points, at).items()}
    counts = K.nearest(points, at[0]).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    centres = K.lloyd_step(points, at)[0][0]
    rows = spark.createDataFrame([(j, *[float(v) for v in c]) for j, c in enumerate(centres)], "cluster INT, " + ", ".join(f"{z} DOUBLE" for z in _Z))
    return r6(rows.join(counts, "cluster"), *_Z).select("n", *_Z)


@query(
    "m12_cluster_profile",
    "SELECT l_returnflag AS cluster, ROUND(AVG(l_quantity), 6) AS l_quantity, ROUND(AVG(l_discount), 6) AS l_discount, ROUND(AVG(l_tax), 6) AS l_tax, COUNT(*) AS n_rows FROM lineitem GROUP BY 1",
)
def profile(spark, sf):
    line = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "cluster")
    return r6(M.cluster_profile(line, X), *X)


@query(
    "m13_impute_mean",
    cte("wide") + "SELECT date, " + ", ".join(f"ROUND(COALESCE({c}, (SELECT AVG({c}) FROM wide)), 4) AS {c}" for c in PRIORITIES.values()) + " FROM wide",
)
def imputed(spark, sf):
    cols = list(PRIORITIES.values())
    return r6(M.impute(wide(spark, sf), cols), *cols, digits=4)


# --- Scenarios ------------------------------------------------------------------------------------


def _documents(spark, sf):
    """One scenario document per event: two dated rows, fenced; those of errors are broken or empty."""
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    rows = F.format_string(
        '{"rows": [{"date": "2025-01-05", "rate": %s, "gdp": "n/a"}, {"date": "2025-01-12", "rate": "%s", "gdp": NaN}]}',
        F.col("value").cast("string"), (F.col("value") * 2).cast("string"),
    )
    text = (
        F.when((kind == "error") & (F.col("value") < 5), "{rows: oops").when(kind == "error", '{"rows": []}')
        .when(kind == "view", rows).otherwise(F.concat(F.lit("```json\n"), rows, F.lit("\n```")))
    )
    return e.select(F.col("event_id").alias("run_id"), text.alias("text"))


@query(
    "c01_parse_scenarios",
    "WITH g AS (SELECT * FROM events WHERE event_type <> 'error') "
    "SELECT event_id AS run_id, CAST(0 AS INTEGER) AS step, DATE '2025-01-05' AS date, 'rate' AS feature, value FROM g "
    "UNION ALL SELECT event_id, 1, DATE '2025-01-12', 'rate', value * 2 FROM g "
    "UNION ALL SELECT event_id, 0, DATE '2025-01-05', 'gdp', NULL FROM g UNION ALL SELECT event_id, 1, DATE '2025-01-12', 'gdp', NULL FROM g",
)
def parse(spark, sf):
    return C.parse_scenarios(_documents(spark, sf))


@query("c01_failed_scenarios", "SELECT COUNT(*) FILTER (event_type = 'error') AS failed, COUNT(*) AS documents FROM events")
def failed(spark, sf):
    return C.failed_scenarios(_documents(spark, sf))


_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _ensemble(spark, sf):
    """Line numbers are runs, months of a ship year are steps."""
    line = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("run_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("step"),
        F.trunc("l_shipdate", "MM").alias("date"), *_FEATURES,
    )
    long = to_long(line, ["run_id", "year", "step", "date"], _FEATURES, "feature", "value")
    return C.ensemble(long, e="year")


_ENS = (
    "WITH line AS (SELECT l_linenumber AS run_id, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS step, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, * FROM lineitem), "
    "long AS (" + " UNION ALL ".join(f"SELECT run_id, year, step, date, '{f}' AS feature, {f} AS value FROM line" for f in _FEATURES) + "), "
    "hz AS (SELECT year, MIN(m) AS h FROM (SELECT year, run_id, MAX(step) AS m FROM long GROUP BY 1, 2) GROUP BY 1), "
    "ens AS (SELECT year, step, feature, MIN(date) AS date, ROUND(AVG(value), 6) AS mean, ROUND(stddev_pop(value), 6) AS std, COUNT(value) AS n_values "
    "FROM long JOIN hz USING (year) WHERE step <= h GROUP BY 1, 2, 3) "
)


@query("c02_ensemble", _ENS + "SELECT * FROM ens")
def ensemble(spark, sf):
    return r6(_ensemble(spark, sf), "mean", "std")


@query("c02_scenario_wide", _ENS + "SELECT year, step, MIN(date) AS date, " + ", ".join(f"MAX(CASE WHEN feature = '{f}' THEN mean END) AS {f}" for f in _FEATURES) + " FROM ens GROUP BY 1, 2")
def scenario_wide(spark, sf):
    return C.scenario_wide(r6(_ensemble(spark, sf), "mean", "std"), _FEATURES, e="year")


@query(
    "c03_complete_features",
    cte("weekly")
    + "SELECT series, year, week, ROUND(COALESCE(value, 0), 6) AS value, ROUND(COALESCE(sparse, 0), 6) AS sparse, 0.0::DOUBLE AS absent, ROW_NUMBER() OVER (PARTITION BY series ORDER BY year, week) - 1 AS rn FROM weekly",
)
def complete(spark, sf):
    out = C.complete_features(stage(weekly(spark, sf)), ["value", "sparse", "absent"], ["year", "week"], "series")
    return r6(out, "value", "sparse")


@query(
    "c04_shock",
    cte("daily")
    + """, b AS (SELECT * FROM daily QUALIFY ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) = 1),
    m AS (SELECT series, value, CAST(UNNEST(generate_series(date_trunc('month', date) + INTERVAL 1 MONTH, date_trunc('month', date) + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS DATE) AS date FROM b)
    SELECT series, date, 'recession' AS scenario, value + 4.0 AS value, 1.0::DOUBLE AS flag FROM m UNION ALL SELECT series, date, 'mild', value * 0.97, 0.0 FROM m""",
)
def shock(spark, sf):
    steps = [("recession", "value", "add", 4.0), ("recession", "flag", "set", 1.0), ("mild", "value", "mul", 0.97)]
    return C.shock(daily(spark, sf).withColumn("flag", F.lit(0.0)), ["value", "flag"], steps, 6, "series")


@query("c05_label_scored", cte("daily") + "SELECT series, date, 'H' || ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) AS label FROM daily")
def label(spark, sf):
    return C.label_scored(daily_staged(spark, sf), "date", None, "series").select("series", "date", "label")
