"""Scenario documents, ensembles and shock projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.dates import month_range
from tidemark.functions.numbers import finite_or_null
from tidemark.functions.text import strip_fence
from tidemark.operators.ordered import attach, names, row_index
from tidemark.operators.rolling import last_n
from tidemark.operators.select import fill_features
from tidemark.sources.sinks import align_to_schema


def _scenario_rows(df: DataFrame, text: str) -> DataFrame:
    document = F.from_json(strip_fence(text), "rows ARRAY<MAP<STRING,STRING>>")
    return df.withColumn("__rows", document["rows"])


def parse_scenarios(df: DataFrame, text: str = "text", run: str = "run_id") -> DataFrame:
    """Documents ``{"rows": [{...}]}``, fenced or not, to (run, step, date, feature, value). A document
    that does not parse or holds no rows gives nothing (see ``failed_scenarios``)."""
    steps = _scenario_rows(df, text).select(run, F.posexplode("__rows").alias("step", "__row"))
    cells = steps.select(
        run, "step", F.col("__row")["date"].try_cast("date").alias("date"), F.explode("__row").alias("feature", "__value")
    )
    return cells.filter(F.col("feature") != "date").select(
        run, "step", "date", "feature", finite_or_null("__value").alias("value")
    )


def failed_scenarios(df: DataFrame, text: str = "text") -> DataFrame:
    bad = F.coalesce(F.size("__rows"), F.lit(0)) <= 0
    return _scenario_rows(df, text).agg(F.count_if(bad).alias("failed"), F.count(F.lit(1)).alias("documents"))


def ensemble(df: DataFrame, run: str = "run_id", step: str = "step", e=()) -> DataFrame:
    """Mean and population std per step and feature over the runs, values that are no finite number
    left out. Steps reach as far as the shortest run; the date is that of the first run."""
    keys = names(e)
    lengths = df.groupBy(*keys, run).agg(F.max(step).alias("__last"))
    horizon = lengths.groupBy(*keys).agg(F.min("__last").alias("__horizon"))
    kept = attach(df, horizon, keys).filter(F.col(step) <= F.col("__horizon"))
    value = finite_or_null("value")
    return kept.groupBy(*keys, step, "feature").agg(
        F.min_by("date", run).alias("date"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
        F.count(value).alias("n_values"),
    )


def scenario_wide(df: DataFrame, features, measure: str = "mean", step: str = "step", e=()) -> DataFrame:
    """One row per step with a column per feature, as stored in the mean and std tables."""
    return df.groupBy(*names(e), step).agg(
        F.min("date").alias("date"), *[F.max(F.when(F.col("feature") == f, F.col(measure))).alias(f) for f in names(features)]
    )


def complete_features(df: DataFrame, features, order, e=(), segment=None) -> DataFrame:
    """The feature columns a model expects: absent or NULL ones 0, plus rn = 0..N-1 in date order."""
    features = names(features)
    keep = [*names(e), *names(order)]
    target = StructType.fromDDL(", ".join(f"`{f}` DOUBLE" for f in features))
    wanted = StructType([df.schema[k] for k in keep] + target.fields)
    return row_index(fill_features(align_to_schema(df, wanted), features), order, e, "rn", segment)


# The recession scenario.
RECESSION = [
    ("recession", "unemployrate", "add", 4.0),
    ("recession", "realgdp", "mul", 0.97),
    ("recession", "recessionindicator", "set", 1.0),
]


def shock(df: DataFrame, cols, shocks=RECESSION, horizon: int = 6, e=(), date: str = "date") -> DataFrame:
    """The latest row of each key, repeated for the next month starts and every scenario, with the
    scenario's shocks applied. ``shocks``: (scenario, column, add | mul | set, amount)."""
    keys, cols = names(e), names(cols)
    base = last_n(df.select(*keys, date, *cols), date, 1, keys)

    def shocked(scenario, c):
        out = F.col(c)
        for name, column, op, amount in shocks:
            if (name, column) == (scenario, c):
                out = {"add": out + amount, "mul": out * amount, "set": F.lit(amount)}[op]
        return out.cast("double").alias(c)

    scenarios = list(dict.fromkeys(s[0] for s in shocks))
    versions = F.array(*[F.struct(F.lit(s).alias("scenario"), *[shocked(s, c) for c in cols]) for s in scenarios])
    months = base.select(*keys, F.explode(month_range(date, horizon)).alias(date), versions.alias("__versions"))
    return months.select(*keys, date, F.inline("__versions"))


def label_scored(df: DataFrame, order, date: str | None = "date", e=(), segment=None) -> DataFrame:
    """Adds label: the date of a scored row, or H1..Hn where there is none."""
    if date is not None and date in df.columns:
        return df.withColumn("label", F.date_format(date, "yyyy-MM-dd"))
    return row_index(df, order, e, "__h", segment).withColumn(
        "label", F.concat(F.lit("H"), (F.col("__h") + 1).cast("string"))
    ).drop("__h")
