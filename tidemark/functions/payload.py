"""JSON payloads: numbers, metric maps, publish times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import col, parse_any_ts
from tidemark.functions.numbers import finite_or_null

# Keys under which a payload may carry its publish time, in order of trust.
PUBLISH_KEYS = [
    "published_at", "published_date", "published_time", "date_published", "date",
    "pubDate", "pub_date", "published", "publishedAt",
]

# Metric key in JSON -> metric column.
METRICS = {
    "mae": "MAE",
    "r2": "R2",
    "smape": "SMAPE",
    "rmse_recent6": "RMSE_RECENT6",
    "pearson_r": "PEARSON_R",
    "mase": "MASE",
}


def json_number(c, path: str) -> Column:
    return F.get_json_object(col(c), path).try_cast("double")


def json_map(c) -> Column:
    """Top-level members as text; NULL for anything that is not a JSON object."""
    return F.from_json(col(c), "MAP<STRING,STRING>")


def _once(c, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once per row, however often and in whichever inner function f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _first_time(members: Column) -> Column:
    raw = F.array(*[members[key] for key in PUBLISH_KEYS])
    parsed = F.transform(raw, parse_any_ts)
    return F.get(F.filter(parsed, lambda t: t.isNotNull()), F.lit(0))


def published_at(payload) -> Column:
    """First usable publish time of the item itself, else of its metadata object."""
    members = json_map(payload)
    empty = ["", "{}", "[]", "null", "false", "0"]
    meta = F.when(~members["meta"].isin(empty), members["meta"])
    return F.coalesce(_first_time(members), _first_time(json_map(F.coalesce(meta, members["metadata"]))))


def _number_members(c) -> Column:
    """(key, text) of the top-level members that are JSON numbers; quoted ones are text, NaN and infinities no numbers."""
    plain = F.regexp_replace(col(c), r":(\s*)-?(?:NaN|Infinity)", ":$1null")
    typed = F.map_entries(F.from_json(plain, "MAP<STRING,VARIANT>"))
    numbers = F.filter(typed, lambda e: F.rlike(F.schema_of_variant(e["value"]), F.lit("^(BIGINT|DECIMAL|FLOAT|DOUBLE)")))
    return F.transform(numbers, lambda e: F.struct(e["key"].alias("key"), e["value"].try_cast("string").alias("value")))


def _canonical_entries(members: Column, names: dict[str, str]) -> Column:
    """(metric, text) members with canonical names; of repeated names the last one stays."""
    canonical = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    entries = F.coalesce(
        F.transform(
            members,
            lambda e: F.struct(
                F.coalesce(canonical[F.lower(e["key"])], F.upper(e["key"])).alias("key"), e["value"].alias("value")
            ),
        ),
        F.array().cast("array<struct<key:string,value:string>>"),
    )
    later = lambda all_, i: F.transform(F.slice(all_, i + F.lit(2), F.size(all_)), lambda e: e["key"])
    return _once(entries, lambda all_: F.filter(all_, lambda e, i: ~F.array_contains(later(all_, i), e["key"])))


def metric_columns(df: DataFrame, c: str, names: dict[str, str] = METRICS) -> DataFrame:
    """One double column per known metric, keys matched without case. A column the table already has keeps its value
    where the JSON has no number for it."""
    read = df.withColumn("__metrics", F.map_from_entries(_canonical_entries(F.map_entries(json_map(c)), names)))
    told = {name: read["__metrics"][name].try_cast("double") for name in names.values()}
    out = {name: F.coalesce(c, F.col(name).try_cast("double")) if name in df.columns else c for name, c in told.items()}
    return read.withColumns(out).drop("__metrics")


def metric_map(df: DataFrame, c: str, name: str = "metrics_all", names: dict[str, str] = METRICS) -> DataFrame:
    """Every numeric metric of a row: JSON numbers first, then metric columns that no JSON number stands for."""
    numbers = F.filter(
        F.transform(
            _canonical_entries(_number_members(c), names),
            lambda e: F.struct(e["key"].alias("key"), finite_or_null(e["value"]).alias("value")),
        ),
        lambda e: e["value"].isNotNull() & (e["key"] != "TEST_COUNT"),
    )
    known = [v for v in names.values() if v in df.columns]
    if known:
        columns = F.array(*[F.struct(F.lit(v).alias("key"), finite_or_null(v).alias("value")) for v in known])

        def with_columns(told: Column) -> Column:
            held = F.transform(told, lambda e: e["key"])
            extra = lambda keys: F.filter(columns, lambda e: e["value"].isNotNull() & ~F.array_contains(keys, e["key"]))
            return F.concat(told, _once(held, extra))

        numbers = _once(numbers, with_columns)
    return df.withColumn(name, F.map_from_entries(numbers))


def algorithm(c) -> Column:
    return F.get_json_object(col(c), "$.algorithm")


def json_key_count(df: DataFrame) -> Column:
    """Number of members a row has once written as JSON, NULL members counted."""
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return F.size(F.json_object_keys(text))
