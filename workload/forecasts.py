"""Multi-step forecasts of autoregressions with drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.rolling import time_split
from tidemark.plans import forecast as A
from tidemark.session import stage
from workload.frames import cte, daily_staged, r6
from workload.register import query

HORIZON = 100

_LAGGED = cte("daily").replace("WITH", "WITH RECURSIVE", 1) + f""", l AS (SELECT *, CAST(day(date) AS DOUBLE) AS x, LAG(value) OVER s AS p, LAG(value, 2) OVER s AS q,
    ROW_NUMBER() OVER (PARTITION BY series ORDER BY date DESC) AS back FROM daily WINDOW s AS (PARTITION BY series ORDER BY date)),
t AS (SELECT * FROM l WHERE back > {HORIZON}), h AS (SELECT series, {HORIZON} + 1 - back AS step, date, x, value FROM l WHERE back <= {HORIZON}),
tail AS (SELECT series, value AS y1, p AS y2 FROM l WHERE back = {HORIZON} + 1), """


def _with_driver(spark, sf):
    d = daily_staged(spark, sf).withColumn("x", F.dayofmonth("date").cast("double"))
    split = stage(time_split(d, "date", HORIZON, "series").drop("rn"), "split")
    return split.filter("split = 'train'").drop("split"), split.filter("split = 'test'").drop("split")


@query(
    "m07_ar2_driver_forecast",
    _LAGGED
    + """m AS (SELECT series, var_pop(p) AS pp, var_pop(q) AS qq, var_pop(x) AS xx, covar_pop(p, q) AS pq, covar_pop(p, x) AS px, covar_pop(q, x) AS qx,
    covar_pop(p, value) AS py, covar_pop(q, value) AS qy, covar_pop(x, value) AS xy, AVG(p) AS mp, AVG(q) AS mq, AVG(x) AS mx, AVG(value) AS my FROM t WHERE q IS NOT NULL GROUP BY 1),
    k AS (SELECT *, pp * (qq * xx - qx * qx) - pq * (pq * xx - qx * px) + px * (pq * qx - qq * px) AS det FROM m),
    c AS (SELECT series, (py * (qq * xx - qx * qx) - pq * (qy * xx - qx * xy) + px * (qy * qx - qq * xy)) / det AS b,
        (pp * (qy * xx - qx * xy) - py * (pq * xx - qx * px) + px * (pq * xy - qy * px)) / det AS c,
        (pp * (qq * xy - qy * qx) - pq * (pq * xy - qy * px) + py * (pq * qx - qq * px)) / det AS d, mp, mq, mx, my FROM k),
    f AS (SELECT *, my - b * mp - c * mq - d * mx AS a FROM c),
    r AS (SELECT series, 0 AS step, y1, y2 FROM tail UNION ALL
        SELECT r.series, r.step + 1, a + b * y1 + c * y2 + d * x, y1 FROM r JOIN f ON f.series = r.series JOIN h ON h.series = r.series AND h.step = r.step + 1)
    SELECT r.series, h.date, CAST(r.step AS INTEGER) AS step, ROUND(y1, 2) AS forecast FROM r JOIN h ON h.series = r.series AND h.step = r.step""",
)
def ar2(spark, sf):
    """Two lags and a driver, a hundred steps ahead, every series by its own coefficients."""
    train, test = _with_driver(spark, sf)
    params = stage(A.fit_ar(train, "date", "value", ["x"], 2, "series"), "ar")
    return r6(A.forecast(params, test, "date", ["x"], "series"), "forecast", digits=2).select("series", "date", "step", "forecast")


_TWO = _LAGGED + """m AS (SELECT series, var_pop(p) AS pp, var_pop(q) AS qq, covar_pop(p, q) AS pq, covar_pop(p, value) AS py, covar_pop(q, value) AS qy,
    AVG(p) AS mp, AVG(q) AS mq, AVG(value) AS my FROM t WHERE q IS NOT NULL GROUP BY 1),
g AS (SELECT series, 2 AS lags, (py * qq - qy * pq) / (pp * qq - pq * pq) AS b, (qy * pp - py * pq) / (pp * qq - pq * pq) AS c, mp, mq, my FROM m),
f AS (SELECT series, lags, my - b * mp - c * mq AS a, b, c FROM g UNION ALL SELECT series, 1, regr_intercept(value, p), regr_slope(value, p), 0 FROM t GROUP BY 1),
r AS (SELECT series, lags, 0 AS step, y1, y2 FROM tail JOIN f USING (series) UNION ALL
    SELECT r.series, r.lags, r.step + 1, a + b * y1 + c * y2, y1 FROM r JOIN f ON f.series = r.series AND f.lags = r.lags WHERE r.step < 100),
e AS (SELECT r.series, r.lags, AVG(abs(y1 - value)) AS mae FROM r JOIN h ON h.series = r.series AND h.step = r.step GROUP BY 1, 2) """


@query("m07_search_horizon", _TWO + "SELECT series, CAST(lags AS INTEGER) AS p, ROUND(mae, 3) AS mae FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY series ORDER BY mae, lags) = 1")
def search(spark, sf):
    """One or two lags, each series by the error of its forecast over the whole horizon."""
    out = A.search_ar(daily_staged(spark, sf), "date", "value", ps=(1, 2), holdout=HORIZON, e="series")
    return r6(out, "mae", digits=3).select("series", "p", "mae")


@query(
    "m07_standard_errors",
    cte("daily")
    + """, l AS (SELECT *, LAG(value) OVER (PARTITION BY series ORDER BY date) AS p FROM daily),
    f AS (SELECT series, regr_slope(value, p) AS b, regr_intercept(value, p) AS a, regr_sxx(value, p) AS sxx, regr_count(value, p) AS n,
        regr_syy(value, p) - regr_slope(value, p) * regr_sxy(value, p) AS rss FROM l GROUP BY 1)
    SELECT series, n, ROUND(a, 3) AS intercept, ROUND(b, 8) AS slope, ROUND(sqrt(rss / (n - 2) / sxx), 8) AS error FROM f""",
)
def standard_errors(spark, sf):
    out = A.fit_ar(daily_staged(spark, sf), "date", "value", (), 1, "series")
    picked = out.select("series", "n", "intercept", F.get("coefs", F.lit(0)).alias("slope"), F.get("errors", F.lit(0)).alias("error"))
    return r6(r6(picked, "slope", "error", digits=8), "intercept", digits=3)
