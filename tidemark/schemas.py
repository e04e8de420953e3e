"""Declared table schemas. Sources never infer a schema."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Sector ticker -> column stem of the wide sector table.
SECTORS = {
    "XLY": "consumerdisc",
    "XLP": "consumerstaple",
    "XLF": "financial",
    "XLK": "tech",
    "XLE": "energy",
    "XLI": "industrial",
    "XLU": "utilities",
    "XLV": "health",
    "XLB": "material",
    "XLC": "comm",
}

# Source series id -> column of the macro tables.
MONTHLY_SERIES = {
    "FEDFUNDS": "fedfundrate",
    "CPIAUCSL": "cpiurban",
    "UNRATE": "unemployrate",
    "TOTALSL": "ownedconsumercredit",
    "USREC": "recessionindicator",
    "GDPC1": "realgdp",
}
DAILY_SERIES = {
    "DGS2": "marketyield2yr",
    "DGS10": "marketyield10yr",
    "T5YIE": "inflationrate",
    "MORTGAGE30US": "mortgagerate30yr",
}
CREDIT_SERIES = {"DRCCLACBS": "delinq"}

# Topics with a relevance column, in column order.
TOPICS = ["fed_policy", "cpi", "labor", "markets", "energy", "real_estate", "layoff"]


def _doubles(names) -> str:
    return ", ".join(f"{name} DOUBLE" for name in names)


SECTOR_COLUMNS = [f"{stem}_{part}" for stem in SECTORS.values() for part in ("price", "vol")]

_NEWS = "topic STRING, title STRING, url STRING, source_domain STRING, published_at TIMESTAMP, score DOUBLE, snippet STRING"

_DDL = {
    "raw.series": "series STRING, date DATE, value DOUBLE, ingest_timestamp TIMESTAMP",
    "raw.observations": "series STRING, observations ARRAY<STRUCT<date: STRING, value: STRING>>",
    "raw.prices": "date DATE, ticker STRING, close_price DOUBLE, volume DOUBLE, ingest_timestamp TIMESTAMP",
    "raw.price_features": (
        "date DATE, ticker STRING, "
        + _doubles(
            "open_price high_price low_price close_price volume return_1d return_1w return_1m "
            "volatility_1w volatility_1m momentum_4w drawdown_max_4w".split()
        )
        + ", ingest_timestamp TIMESTAMP"
    ),
    "raw.news": f"ingest_datetime TIMESTAMP, ingest_date DATE, {_NEWS}, raw_payload STRING",
    "landing.macro_monthly": "date DATE, " + _doubles(MONTHLY_SERIES.values()),
    "landing.macro_daily": "date DATE, " + _doubles(DAILY_SERIES.values()),
    "landing.credit": "date DATE, delinq DOUBLE",
    "landing.sector": "date DATE, " + _doubles(SECTOR_COLUMNS) + ", load_timestamp TIMESTAMP",
    "landing.news": f"article_id STRING, {_NEWS}, ingest_datetime TIMESTAMP, ingest_date DATE",
    "landing.relevance": (
        "date DATE, "
        + _doubles(f"relevance_{topic}" for topic in TOPICS)
        + ", num_articles_total BIGINT, ingest_timestamp TIMESTAMP, notes STRING"
    ),
    "landing.relevance_state": "date DATE, topic STRING, score_sum DOUBLE, score_count BIGINT, articles BIGINT",
    "gold.weekly": (
        "week INT, year INT, delinq DOUBLE, "
        + _doubles([*DAILY_SERIES.values(), *MONTHLY_SERIES.values(), *SECTOR_COLUMNS])
    ),
    "gold.scenario_predictions": (
        "date DATE, unemployrate DOUBLE, realgdp DOUBLE, recessionindicator BIGINT, "
        "predicted_delinquency_rate DOUBLE, created_at TIMESTAMP"
    ),
    "registry.model": (
        "model_id STRING, model_name STRING, owner STRING, business_problem STRING, "
        "ticket_number STRING, tags_json STRING, created_at TIMESTAMP"
    ),
    "registry.dataset": (
        "dataset_id STRING, model_id STRING, data_version STRING, path STRING, "
        "row_count BIGINT, feature_count BIGINT, created_at TIMESTAMP"
    ),
    "registry.training_run": (
        "run_id STRING, model_id STRING, dataset_id STRING, params STRING, metrics STRING, "
        "artifact STRING, status STRING, created_at TIMESTAMP"
    ),
    "registry.model_version": (
        "model_version_id STRING, model_id STRING, training_run_id STRING, artifact_path STRING, "
        "metrics_json STRING, status STRING, created_at TIMESTAMP"
    ),
    "registry.deployment": (
        "deployment_id STRING, model_version_id STRING, endpoint_url STRING, traffic_split DOUBLE, "
        "deployed_at TIMESTAMP, params STRING, metrics STRING, artifact STRING"
    ),
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def tables() -> list[str]:
    return list(_DDL)
