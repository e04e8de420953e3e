"""Stored models: train and evaluate, write the fitted pipeline, release it, and serve from the active deployment."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.payload import algorithm
from tidemark.operators.ordered import names, row_index
from tidemark.operators.rolling import first_per_key, last_n
from tidemark.operators.select import date_between, year_week_between
from tidemark.plans.models import FITS, baseline, forecast_metrics, label_history, score, with_errors
from tidemark.plans.registry import best_run, deploy, metrics_json, promotion
from tidemark.plans.scenario import label_scored
from tidemark.schemas import schema
from tidemark.session import stage
from tidemark.sources.sinks import align_to_schema

#: Keys of a run's metrics JSON, and the columns they come from.
RUN_METRICS = {c: c for c in ("pearson_r", "smape", "mae", "mase", "r2", "rmse_recent6", "test_count")}


def artifact_path(root: str, model_id: str, dataset_id: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/models/model_id={model_id}/dataset_id={dataset_id}/run_id={run_id}/model"


def constant_model(value: float) -> PipelineModel:
    """A pipeline that predicts one value whatever the features are. Like any other it can be written and loaded."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST('{float(value)!r}' AS DOUBLE) AS prediction FROM __THIS__")])


def features_of(model: PipelineModel) -> list[str]:
    """The columns a pipeline reads, in its own order: a stored model needs no list beside it."""
    return [c for part in model.stages if isinstance(part, VectorAssembler) for c in part.getInputCols()]


def fit_algorithm(name: str, train: DataFrame, xs, y: str, order, params: dict | None = None, fits: dict[str, Callable] = FITS) -> PipelineModel:
    """The fitted pipeline of an algorithm. ``base`` is the mean of the target's last three rows."""
    if name == "base":
        return constant_model(baseline(train, order, y).first()[0] or 0.0)
    return fits[name](train, xs, y, **(params or {}))


def train_run(
    split: DataFrame, y: str, xs, *, root: str, run_id: str, model_id: str, dataset_id: str, name: str, created_at: dt.datetime,
    params: dict | None = None, order=("year", "week"), fits: dict[str, Callable] = FITS,
) -> DataFrame:
    """One row of ``registry.training_run``: fit on the rows of ``split`` 'train', measure on 'test', and write the fitted pipeline
    under ``root``. ``split`` is read several times: stage it first. A set of parameters that the estimator refuses gives
    a failed run without an artifact; anything else is raised."""
    spark, order = split.sparkSession, names(order)
    path = artifact_path(root, model_id, dataset_id, run_id)
    told = json.dumps({"algorithm": name, "hyperparameters": params or {}})
    row = [F.lit(run_id).alias("run_id"), F.lit(model_id).alias("model_id"), F.lit(dataset_id).alias("dataset_id"), F.lit(told).alias("params")]
    when = F.lit(created_at).cast("timestamp").alias("created_at")
    try:
        model = fit_algorithm(name, split.filter("split = 'train'"), xs, y, order, params, fits)
    except (IllegalArgumentException, TypeError) as error:
        print(f"run {run_id} failed: {error}")
        nothing = F.lit(None).cast("string")
        return align_to_schema(spark.range(1).select(*row, nothing.alias("metrics"), nothing.alias("artifact"), F.lit("failed").alias("status"), when), schema("registry.training_run"))
    model.write().overwrite().save(path)
    test = score(model, split.filter("split = 'test'"), names(xs)).withColumn(y, F.coalesce(y, F.lit(0.0)))
    measured = forecast_metrics(test, order, y, "prediction").select(metrics_json(RUN_METRICS).alias("metrics"))
    return align_to_schema(measured.select(*row, "metrics", F.lit(path).alias("artifact"), F.lit("completed").alias("status"), when), schema("registry.training_run"))


def release(runs: DataFrame, versions: DataFrame, deployments: DataFrame, now: dt.datetime, min_gain: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Versions and deployments after the best completed run of each model and dataset was judged against what its model
    serves now: approved ones become the model's deployment, candidates a version only. A run that is a version already is left
    out. Of several approved datasets of a model the one with the lowest score is deployed."""
    fresh = runs.join(versions.select(F.col("training_run_id").alias("run_id")), "run_id", "left_anti")
    owners = versions.select("model_version_id", "model_id")
    judged = promotion(best_run(fresh), deployments.join(owners, "model_version_id"), min_gain)
    judged = judged.withColumns({
        "model_version_id": F.concat(F.lit("version_"), "run_id"), "deployment_id": F.concat(F.lit("deployment_"), "run_id"),
        "training_run_id": F.col("run_id"), "artifact_path": F.col("artifact"), "metrics_json": F.col("metrics"),
    })
    judged = stage(judged, "judged")
    added = judged.withColumn("status", F.col("decision")).withColumn("created_at", F.lit(now).cast("timestamp"))
    after = versions.unionByName(align_to_schema(added, versions.schema))
    chosen = first_per_key(judged.filter("decision = 'approved'"), "model_id", [F.col("score").asc_nulls_last(), F.col("run_id")])
    chosen = chosen.withColumn("deployed_at", F.lit(now).cast("timestamp")).withColumn("endpoint_url", F.col("artifact"))
    return after, deploy(deployments, versions, chosen)


@dataclass
class Deployed:
    deployment_id: str
    model_version_id: str
    model_id: str
    algorithm: str | None
    metrics_json: str | None
    model: PipelineModel


def deployed(deployments: DataFrame, versions: DataFrame, runs: DataFrame, model_id: str) -> Deployed:
    """The model's latest deployment with traffic, its pipeline loaded from the artifact path. Fails where there is none."""
    own = versions.filter(F.col("model_id") == model_id).select("model_version_id", "model_id", "training_run_id", "artifact_path", "metrics_json")
    live = deployments.filter(F.col("traffic_split") > 0).select("deployment_id", "model_version_id", "deployed_at").join(own, "model_version_id")
    named = live.join(runs.select(F.col("run_id").alias("training_run_id"), algorithm("params").alias("algorithm")), "training_run_id", "left")
    found = named.orderBy(F.col("deployed_at").desc(), F.col("deployment_id").asc()).first()
    if found is None:
        raise LookupError(f"no active deployment of {model_id}")
    return Deployed(*[found[c] for c in ("deployment_id", "model_version_id", "model_id", "algorithm", "metrics_json")], PipelineModel.load(found["artifact_path"]))


def iso_week(day: str | dt.date) -> tuple[int, int]:
    return (dt.date.fromisoformat(day) if isinstance(day, str) else day).isocalendar()[:2]


def _served(rows: DataFrame, live: Deployed, order) -> DataFrame:
    """Rows with a prediction of the deployed pipeline. Features the table lacks count 0, and so do NULL ones; a missing row
    number is counted from 0."""
    wanted = features_of(live.model)
    if "rn" in wanted and "rn" not in rows.columns:
        rows = row_index(rows, order, name="rn")
    rows = rows.withColumns({c: F.lit(0.0) for c in wanted if c not in rows.columns})
    return score(live.model, rows, wanted).withColumns({"deployment_id": F.lit(live.deployment_id), "algorithm": F.lit(live.algorithm)})


def serve_history(
    features: DataFrame, live: Deployed, y: str = "delinq", *, day=None, start=None, end=None, limit: int | None = 100,
) -> DataFrame:
    """Predictions for a table by (year, week), newest weeks first, with label and errors against ``y``. Days are read as ISO weeks."""
    if day is not None:
        start = end = day
    rows = year_week_between(features, start and iso_week(start), end and iso_week(end))
    if limit is not None:
        rows = last_n(rows, ["year", "week"], limit)
    return label_history(with_errors(_served(rows, live, ["year", "week"]), y))


def serve_scenario(scenario: DataFrame, live: Deployed, *, day=None, start=None, end=None, limit: int | None = 100, order="date") -> DataFrame:
    """Predictions for future rows, earliest first, labelled by date, or H1..Hn where ``order`` is another column."""
    if day is not None:
        start = end = day
    rows = scenario if order != "date" else date_between(scenario, "date", start, end)
    if limit is not None:
        rows = rows.orderBy(*names(order)).limit(limit)
    return label_scored(_served(rows, live, names(order)), order, order if order == "date" else None)


def empty_registry(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Versions and deployments before anything was released."""
    return tuple(spark.createDataFrame([], schema(f"registry.{t}")) for t in ("model_version", "deployment"))
