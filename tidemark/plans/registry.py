"""Model registry: best runs, promotion, deployments, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import fmt_ts
from tidemark.functions.numbers import finite_or_null
from tidemark.functions.payload import METRICS, algorithm, json_number, metric_columns
from tidemark.operators.merge import upsert
from tidemark.operators.reshape import to_long
from tidemark.operators.rolling import first_per_key, latest_nonnull_per_key, top_n, top_n_per_key
from tidemark.sources.sinks import align_to_schema


def append_runs(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with rows added, columns matched by name."""
    return table.unionByName(align_to_schema(rows, table.schema))


def register_model(models: DataFrame, row: DataFrame) -> DataFrame:
    """Insert a model, or refresh the row it already has."""
    rest = [c for c in models.columns if c not in ("model_id", "created_at")]
    return upsert(models, row, "model_id", overwrite_cols=rest)


def metrics_json(values: dict[str, str]):
    """JSON text of numeric columns, given as JSON key -> column; numbers that are not finite are NULL."""
    return F.to_json(F.struct(*[finite_or_null(c).alias(k) for k, c in values.items()]), {"ignoreNullFields": "false"})


def metrics_wide(df: DataFrame, metrics: str = "metrics", params: str | None = "params") -> DataFrame:
    out = metric_columns(df, metrics)
    return out if params is None else out.withColumn("model_name", algorithm(params))


def best_run(runs: DataFrame, metric: str = "$.smape", keys=("model_id", "dataset_id")) -> DataFrame:
    """Completed run with the lowest metric per model and dataset; runs without the metric come last."""
    scored = runs.filter(F.col("status") == "completed").withColumn("score", json_number("metrics", metric))
    return first_per_key(scored, keys, [F.col("score").asc_nulls_last(), F.col("run_id").asc()])


def promotion(best: DataFrame, deployed: DataFrame, min_gain: float = 0.01, metric: str = "$.smape", key: str = "model_id") -> DataFrame:
    """Status of the best run against the latest full deployment of its model: approved when there is
    none or the relative gain reaches ``min_gain``; candidate otherwise, also where no gain can be told."""
    live = first_per_key(
        deployed.filter(F.col("traffic_split") == 1.0), key, [F.col("deployed_at").desc(), F.col("deployment_id").asc()]
    )
    base = live.select(key, finite_or_null(json_number("metrics", metric)).alias("base_score"))
    joined = best.withColumn("new_score", finite_or_null("score")).join(base, key, "left")
    gain = F.try_divide(F.col("base_score") - F.col("new_score"), F.col("base_score"))
    approved = F.col("base_score").isNull() | F.coalesce(gain >= min_gain, F.lit(False))
    return joined.withColumn("gain", gain).withColumn("decision", F.when(approved, "approved").otherwise("candidate"))


def deploy(deployments: DataFrame, versions: DataFrame, new: DataFrame, stage_candidates: bool = False) -> DataFrame:
    """Switch the models of the approved new versions to them: active deployments of these models get no
    traffic, the new rows get all. Candidates are left out, or staged without traffic.

    ``new``: deployment columns plus ``model_id`` and ``decision``.
    """
    approved = new.filter(F.col("decision") == "approved")
    replaced = versions.join(approved.select("model_id"), "model_id", "left_semi").select("model_version_id").distinct()
    marked = deployments.join(replaced.withColumn("__replaced", F.lit(True)), "model_version_id", "left")
    archived = marked.withColumn(
        "traffic_split", F.when(F.col("__replaced") & (F.col("traffic_split") > 0), 0.0).otherwise(F.col("traffic_split"))
    ).select(*deployments.columns)
    incoming = new if stage_candidates else approved
    live = F.when(F.col("decision") == "approved", 1.0).otherwise(0.0)
    return archived.unionByName(align_to_schema(incoming.withColumn("traffic_split", live), deployments.schema))


def active_deployment(deployments: DataFrame, versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Latest deployment with traffic, with its version and run."""
    found = (
        deployments.filter(F.col("traffic_split") > 0)
        .select("deployment_id", "model_version_id", "endpoint_url", "traffic_split", "deployed_at")
        .join(versions.select("model_version_id", "model_id", "training_run_id", "artifact_path"), "model_version_id")
        .join(runs.select(F.col("run_id").alias("training_run_id"), "dataset_id", F.col("params").alias("run_params")),
              "training_run_id")
    )
    return top_n(found, [F.col("deployed_at").desc(), F.col("deployment_id").asc()], 1)


def enrich_model_name(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Model name of each version: from its run, else from its own parameters."""
    named = runs.select(F.col("run_id").alias("training_run_id"), algorithm("params").alias("__run_name"))
    own = versions.withColumn("__own_name", algorithm("params"))
    joined = own.join(named, "training_run_id", "left")
    return joined.withColumn("model_name", F.coalesce("__run_name", "__own_name")).drop("__run_name", "__own_name")


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest value of every metric per model name, each on its own."""
    named = metrics_wide(runs).filter(F.col("model_name").isNotNull())
    return latest_nonnull_per_key(named, "model_name", "created_at", [*METRICS.values(), "created_at"])


def compare_runs(latest: DataFrame, metrics=("MAE", "RMSE_RECENT6")) -> DataFrame:
    """Long form of chosen metrics, models lacking one left out."""
    return to_long(latest.dropna(subset=list(metrics)), "model_name", list(metrics), "metric", "value")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Newest n runs per model name."""
    named = metrics_wide(runs).filter(F.col("model_name").isNotNull())
    return top_n_per_key(named, "model_name", [F.col("created_at").desc(), F.col("run_id").asc()], n)


def metric_stability(runs: DataFrame, metric: str, key: str = "model_name", digits: int = 4) -> DataFrame:
    """Number, mean and spread of a metric by key. Keys without any value are left out after the sums: a filter before them
    would read every payload twice."""
    return runs.groupBy(key).agg(
        F.count(metric).alias("n_runs"),
        F.bround(F.avg(metric), digits).alias("mean"),
        F.bround(F.stddev_samp(metric), digits).alias("std"),
    ).filter("n_runs > 0")


def deployment_timeline(deployments: DataFrame, models: list[str]) -> DataFrame:
    """Time of deployment by model: Active, Inactive or blank. Times are shown to the second; of several deployments in
    one, the latest decides, then the larger id."""
    status = F.when(F.col("traffic_split") > 0, "Active").otherwise("Inactive")
    cell = lambda m: F.max_by(status, F.when(F.col("model_name") == m, F.struct("deployed_at", "deployment_id")))
    when = fmt_ts("deployed_at", missing="")
    return deployments.groupBy(when.alias("deployment_date")).agg(*[F.coalesce(cell(m), F.lit("")).alias(m) for m in models])


def deployment_counts(deployments: DataFrame) -> DataFrame:
    active = F.coalesce(F.col("traffic_split") > 0, F.lit(False))
    return deployments.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(active).alias("active"), F.count_if(~active).alias("inactive")
    )
