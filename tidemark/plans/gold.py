"""Landing tables -> weekly feature table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.fills import fill, fill_rule
from tidemark.operators.ordered import STEP, WHOLE, names, neighbours
from tidemark.operators.reshape import weekly_combine, weekly_mean
from tidemark.operators.select import valid_weeks
from tidemark.session import stage

# How each sparse weekly column is filled.
WEEKLY_FILLS = {
    "fedfundrate": "ffill",
    "unemployrate": "ffill",
    "recessionindicator": "ffill",
    "cpiurban": "steps",
    "ownedconsumercredit": "steps",
    "realgdp": "steps",
    "delinq": "steps",
}


def weekly_features(
    daily: DataFrame, monthly: DataFrame, sector: DataFrame, credit: DataFrame, e=(), rules=WEEKLY_FILLS, first_year: int = 1999
) -> DataFrame:
    """Weekly means of four landing tables on the weeks of the daily one, sparse columns filled, partial
    weeks left out. The week filter comes after the fills, which need the weeks it drops. The calendar bounds
    the weeks of a key, so its window stays whole."""
    keys = names(e)
    means = [
        weekly_mean(df, "date", [c for c in df.columns if c not in {"date", "load_timestamp", *keys}], keys)
        for df in (daily, monthly, sector, credit)
    ]
    combined = weekly_combine(means[0], means[1:], [*keys, "year", "week"])
    return valid_weeks(fill(combined, ["year", "week"], rules, keys, WHOLE), first_year)


# --- Load by load ---------------------------------------------------------------------------------


def week_start(day: dt.date) -> dt.date:
    """The first day of a day's week inside its year: its Sunday, or January 1st."""
    return max(day - dt.timedelta((day.weekday() + 1) % 7), dt.date(day.year, 1, 1))


def _write_years(df: DataFrame, path: str) -> None:
    df.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def _before(df: DataFrame, year: int, week: int) -> DataFrame:
    return df.filter((F.col("year") < year) | ((F.col("year") == year) & (F.col("week") < week)))


def read_weeks(spark: SparkSession, root: str, columns, rules=WEEKLY_FILLS, name: str = "weeks") -> DataFrame:
    """A table of ``load_weeks``: ``weeks`` holds the means as they are and the state of each fill, ``filled`` the filled columns."""
    state = [f"last_{c} DOUBLE, since_{c} BIGINT" for c in rules] if name == "weeks" else []
    return spark.read.schema(", ".join(["week INT", *[f"{c} DOUBLE" for c in columns], *state, "year INT"])).parquet(f"{root}/{name}")


def load_weeks(
    daily: DataFrame, monthly: DataFrame, sector: DataFrame, credit: DataFrame, root: str, first_day: dt.date | None = None, rules=WEEKLY_FILLS,
) -> tuple[int, int]:
    """Brings the weekly tables under ``root`` up to date with landing tables of which the rows from ``first_day`` on have changed
    (None: all, a new table). Returns the first week that was written anew.

    Beside its means every week keeps the state of each fill: the last known value and how many rows ago it stood. So a load
    computes means from the first touched week on, reads back at most to the last known value of a column whose gap it now closes, and
    carries all else over by the state of the week before. Years before that are neither read nor written; the landing tables are
    read from the touched week on. The tables equal a rebuild. They are kept in folders by year, replaced year by year: a
    load that died is run again.
    """
    spark = daily.sparkSession
    columns = [c for df in (daily, monthly, sector, credit) for c in df.columns if c not in ("date", "load_timestamp")]
    steps = [c for c, rule in rules.items() if rule == "steps"]
    if first_day is not None:
        start = week_start(first_day)
        daily, monthly, sector, credit = (df.filter(F.col("date") >= F.lit(start)) for df in (daily, monthly, sector, credit))
    means = [weekly_mean(df, "date", [c for c in df.columns if c not in ("date", "load_timestamp")]) for df in (daily, monthly, sector, credit)]
    new = stage(weekly_combine(means[0], means[1:], ["year", "week"]).select("year", "week", *columns), "weeks")
    region, carry, kept = new, None, None
    if first_day is not None:
        at = start.year, int(start.strftime("%U"))
        held = _before(read_weeks(spark, root, columns, rules), *at)
        back = _rows_back(held, new, steps, at[0])
        near = held.filter(F.col("year") >= at[0] - 2 - back // 52)
        prior = stage(near.orderBy(F.desc("year"), F.desc("week")).limit(back + 1), "prior-weeks")
        rows = prior.orderBy("year", "week").limit(1).collect() if prior.count() > back else []
        if rows:
            carry = rows[0]
            prior = prior.filter((F.col("year") != carry["year"]) | (F.col("week") != carry["week"]))
        region = prior.select(*new.columns).unionByName(new)
    found = neighbours(region, ["year", "week"], list(rules), (), WHOLE, steps=True)
    if carry is not None:
        found = found.withColumns({f"__prev_{c}": _carried(found, c, carry) for c in rules})
    prev = lambda c: F.col(f"__prev_{c}")
    filled = [fill_rule(c, rules[c], "year").alias(c) if c in rules else F.col(c) for c in new.columns]
    state = [x for c in rules for x in (prev(c)["v"].alias(f"last_{c}"), (F.col(STEP) - prev(c)[STEP]).cast("bigint").alias(f"since_{c}"))]
    both = stage(found.select(F.struct(*new.columns, *state).alias("weeks"), F.struct(*filled).alias("filled")), "filled-weeks")
    first = both.select(F.min(F.struct("weeks.year", "weeks.week"))).first()[0]
    if first is None:
        return (0, 0)
    for name in ("weeks", "filled"):
        rows = both.select(f"{name}.*")
        if first_day is not None:
            kept = _before(read_weeks(spark, root, columns, rules, name).filter(F.col("year") == first[0]), *first)
            rows = stage(rows.unionByName(kept.select(*rows.columns)), "year-weeks")
        _write_years(rows, f"{root}/{name}")
    return tuple(first)


def _rows_back(held: DataFrame, new: DataFrame, steps: list[str], year: int) -> int:
    """How many rows before the new ones lie in a gap that a new value closes."""
    since = None
    for rows in (held.filter(F.col("year") >= year - 1), held):
        since = rows.orderBy(F.desc("year"), F.desc("week")).select(*[f"since_{c}" for c in steps]).first()
        if since is not None or not steps:
            break
    if since is None:
        return 0
    known = new.agg(*[F.count(c).alias(c) for c in steps]).first()
    return max((since[f"since_{c}"] or 0 for c in steps if known[c]), default=0)


def _carried(found: DataFrame, c: str, carry) -> Column:
    """The last known place of a column, or the one the week before the region carried."""
    own = F.col(f"__prev_{c}")
    if carry[f"last_{c}"] is None:
        return own
    told = {STEP: F.lit(-carry[f"since_{c}"]), "v": F.lit(carry[f"last_{c}"])}
    fields = found.schema[f"__prev_{c}"].dataType.fields
    return F.coalesce(own, F.struct(*[told.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]))


def read_gold(spark: SparkSession, root: str, columns, rules=WEEKLY_FILLS, first_year: int = 1999) -> DataFrame:
    return valid_weeks(read_weeks(spark, root, columns, rules, "filled"), first_year)
