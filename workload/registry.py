"""Model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import registry as G
from tidemark.schemas import schema
from workload.frames import cte, deployments, runs, table, versions
from workload.register import query

MODELS = {"click": "click", "error": "error", "purchase": "purchase", "signup": "signup", "view": "view"}


@query("g01_append_runs", cte("runs") + "SELECT run_id, status, CAST(NULL AS VARCHAR) AS artifact FROM runs UNION ALL SELECT run_id || '_b', 'completed', NULL FROM runs")
def append(spark, sf):
    held = spark.createDataFrame([], schema("registry.training_run"))
    r = runs(spark, sf).drop("artifact")
    again = r.withColumns({"run_id": F.concat("run_id", F.lit("_b")), "status": F.lit("completed"), "extra": F.lit(1)})
    return G.append_runs(G.append_runs(held, r), again).select("run_id", "status", "artifact")


@query(
    "g01_register_model",
    "SELECT 'model_' || user_id AS model_id, CASE WHEN COUNT(*) FILTER (event_type = 'view') > 0 THEN 'new' ELSE 'old' END AS model_name FROM events GROUP BY user_id",
)
def register(spark, sf):
    e = table(spark, sf, "events").withColumn("model_id", F.concat(F.lit("model_"), "user_id"))

    def row(df, name):
        rows = df.select("model_id").distinct().withColumn("model_name", F.lit(name))
        return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema("registry.model")])

    held = row(e, "old")
    return G.register_model(held, row(e.filter(F.col("event_type") == "view"), "new")).select("model_id", "model_name")


@query("g02_metrics_wide", cte("runs") + 'SELECT run_id, algorithm AS model_name, mae AS "MAE", smape AS "SMAPE" FROM runs')
def wide_metrics(spark, sf):
    return G.metrics_wide(runs(spark, sf)).select("run_id", "model_name", "MAE", "SMAPE")


_BEST = ", best AS (SELECT * FROM runs WHERE status = 'completed' QUALIFY ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY smape NULLS LAST, run_id) = 1) "


@query("g03_k03_best_run", cte("runs") + _BEST.format(k="model_id, dataset_id") + "SELECT model_id, dataset_id, run_id, smape AS score FROM best")
def best(spark, sf):
    return G.best_run(runs(spark, sf)).select("model_id", "dataset_id", "run_id", "score")


@query(
    "g04_promotion",
    cte("runs", "deployments") + _BEST.format(k="model_id, dataset_id")
    + """, live AS (SELECT 'model_' || event_type AS model_id, smape AS base FROM deployments WHERE traffic_split = 1.0 QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY deployed_at DESC, deployment_id) = 1)
    SELECT b.model_id, dataset_id, ROUND((base - smape) / NULLIF(base, 0), 8) AS gain, CASE WHEN base IS NULL OR COALESCE((base - smape) / NULLIF(base, 0) >= 0.01, FALSE) THEN 'approved' ELSE 'candidate' END AS decision
    FROM best b LEFT JOIN live USING (model_id)""",
)
def promote(spark, sf):
    model = table(spark, sf, "events").select(
        F.concat(F.lit("deploy_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("deployment_id"),
        F.concat(F.lit("model_"), "event_type").alias("model_id"),
    )
    deployed = deployments(spark, sf).join(model, "deployment_id")
    out = G.promotion(G.best_run(runs(spark, sf)), deployed)
    return out.select("model_id", "dataset_id", F.round("gain", 8).alias("gain"), "decision")


@query(
    "g05_deploy",
    cte("deployments")
    + """, u AS (SELECT user_id, MAX(value) > 60 AS ok FROM events GROUP BY 1)
    SELECT deployment_id, CASE WHEN ok AND traffic_split > 0 THEN 0.0 ELSE traffic_split END AS traffic_split FROM deployments JOIN u USING (user_id)
    UNION ALL SELECT 'new_' || user_id, 1.0 FROM u WHERE ok""",
)
def deploy(spark, sf):
    tops = table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("top"))
    new = tops.select(
        F.concat(F.lit("new_"), "user_id").alias("deployment_id"),
        F.concat(F.lit("new_version_"), "user_id").alias("model_version_id"),
        F.concat(F.lit("model_"), "user_id").alias("model_id"),
        F.when(F.col("top") > 60, "approved").otherwise("candidate").alias("decision"),
    )
    return G.deploy(deployments(spark, sf), versions(spark, sf), new).select("deployment_id", "traffic_split")


@query(
    "g06_active_deployment",
    cte("deployments", "versions", "runs")
    + """SELECT d.deployment_id, v.model_id, r.dataset_id FROM deployments d JOIN versions v USING (model_version_id) JOIN runs r ON r.run_id = v.training_run_id
    WHERE traffic_split > 0 ORDER BY deployed_at DESC, d.deployment_id LIMIT 1""",
)
def active(spark, sf):
    return G.active_deployment(deployments(spark, sf), versions(spark, sf), runs(spark, sf)).select("deployment_id", "model_id", "dataset_id")


_LATEST = cte("runs") + ', l AS (SELECT algorithm AS model_name, arg_max(mae, created_at) AS "MAE", arg_max(smape, created_at) AS "SMAPE", MAX(created_at) AS created_at FROM runs GROUP BY 1) '


@query("g07_w21_latest_runs", _LATEST + "SELECT * FROM l")
def latest(spark, sf):
    out = G.latest_runs(runs(spark, sf))
    return out.select("model_name", "MAE", "SMAPE", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    "g07_compare_runs",
    _LATEST + "SELECT model_name, 'MAE' AS metric, \"MAE\" AS value FROM l UNION ALL SELECT model_name, 'SMAPE', \"SMAPE\" FROM l",
)
def compare(spark, sf):
    return G.compare_runs(G.latest_runs(runs(spark, sf)), ("MAE", "SMAPE"))


@query(
    "g07_recent_runs",
    cte("runs") + "SELECT algorithm AS model_name, run_id FROM runs QUALIFY ROW_NUMBER() OVER (PARTITION BY algorithm ORDER BY created_at DESC, run_id) <= 10",
)
def recent(spark, sf):
    return G.recent_runs(runs(spark, sf), 10).select("model_name", "run_id")


@query(
    "g08_metric_stability",
    cte("runs") + "SELECT algorithm AS model_name, COUNT(smape) AS n_runs, ROUND(AVG(smape), 4) AS mean, ROUND(stddev_samp(smape), 4) AS std FROM runs WHERE smape IS NOT NULL GROUP BY 1",
)
def stability(spark, sf):
    return G.metric_stability(G.metrics_wide(runs(spark, sf)), "SMAPE")


def _named(spark, sf):
    name = table(spark, sf, "events").select(
        F.concat(F.lit("deploy_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("deployment_id"), F.col("event_type").alias("model_name")
    )
    return deployments(spark, sf).join(name, "deployment_id")


@query(
    "g09_deployment_timeline",
    cte("deployments")
    + "SELECT strftime(deployed_at, '%Y-%m-%d %H:%M:%S') AS deployment_date, "
    + ", ".join(f"COALESCE(arg_max(CASE WHEN traffic_split > 0 THEN 'Active' ELSE 'Inactive' END, CASE WHEN event_type = '{m}' THEN lpad(epoch_us(deployed_at)::VARCHAR, 20, '0') || deployment_id END), '') AS {m}" for m in MODELS)
    + " FROM deployments GROUP BY 1",
)
def timeline(spark, sf):
    return G.deployment_timeline(_named(spark, sf), list(MODELS))


@query(
    "g09_deployment_counts",
    cte("deployments") + "SELECT COUNT(*) AS total, COUNT(*) FILTER (traffic_split > 0) AS active, COUNT(*) FILTER (traffic_split <= 0) AS inactive FROM deployments",
)
def counts(spark, sf):
    return G.deployment_counts(deployments(spark, sf))
