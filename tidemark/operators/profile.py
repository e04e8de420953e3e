"""Profiles, descriptive statistics, data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import decade
from tidemark.operators.ordered import attach, names, over_rows
from tidemark.operators.reshape import to_long
from tidemark.session import stage


def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One output row per struct of a single aggregate row."""
    return df.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame, skip=("timestamp", "date", "created_at", "updated_at")) -> DataFrame:
    """Total, non-NULL, NULL rows and NULL percentage per column, from one pass over the table."""
    cols = [c for c in df.columns if c.lower() not in {s.lower() for s in skip}]
    counts = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)])
    total = F.col("__total")
    return _rows(
        counts,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                total.alias("total_rows"),
                F.col(f"n_{i}").alias("non_null_rows"),
                (total - F.col(f"n_{i}")).alias("null_rows"),
                F.coalesce(F.try_divide(total - F.col(f"n_{i}"), total) * 100, F.lit(0.0)).alias("null_percentage"),
            )
            for i, c in enumerate(cols)
        ],
    )


def without_nan(df: DataFrame, cols) -> DataFrame:
    """The columns as doubles, NaN as NULL."""
    value = lambda c: F.col(c).cast("double")
    return df.select(*[F.when(~F.isnan(value(c)), value(c)).alias(c) for c in cols])


def exact_quantiles(df: DataFrame, cols, probs, limit: int = 1_000_000, error: float = 0.001) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns, linear between ranks.

    Every wanted rank is bracketed by approximate quantiles and only the values strictly between the two
    stay in play, well under one percent of them, until at most ``limit`` are left in all; these meet in one
    task, never more. A rank that its bracket misses goes on in the part beside it. All columns and ranks share
    the passes: two per round, and a last one. NaN counts as NULL.
    """
    cols = names(cols)
    base = without_nan(df, cols).toDF(*[f"v{i}" for i in range(len(cols))])
    sizes = base.agg(*[F.count(c) for c in base.columns]).first()

    # rank wanted -> (low, high, rank among the values between them, number of these values)
    open_ranks: dict[tuple[int, int], tuple] = {}
    found: dict[tuple[int, int], float] = {}
    for i, size in enumerate(sizes):
        for p in probs:
            rank = int(p * (size - 1)) if size else 0
            for r in {rank, min(rank + 1, size - 1)}:
                if size:
                    open_ranks[i, r] = (None, None, r, size)

    def between(i, low, high):
        v = F.col(f"v{i}")
        inside = v.isNotNull()
        inside = inside if low is None else inside & (v > low)
        return inside if high is None else inside & (v < high)

    def too_many():
        bands = {(k[0], t[0], t[1]): t[3] for k, t in open_ranks.items()}
        return open_ranks if sum(bands.values()) > limit else {}

    def between_all(i, low, high, bound_low, bound_high):
        v = F.col(f"v{i}")
        return between(i, bound_low, bound_high) & (v > low) & (v < high)

    while wide := {k: t for k, t in too_many().items() if t[3] > 1}:
        bands = list(dict.fromkeys((k[0], t[0], t[1]) for k, t in wide.items()))
        columns = [F.when(between(*band), F.col(f"v{band[0]}")).alias(f"b{j}") for j, band in enumerate(bands)]
        marks = {}
        for k, (_, _, rank, size) in wide.items():
            marks[k] = (max(rank / size - 2 * error, 0.0), min((rank + 1) / size + 2 * error, 1.0))
        grid = sorted({p for pair in marks.values() for p in pair})
        cuts = base.select(*columns).approxQuantile([f"b{j}" for j in range(len(bands))], grid, error)
        ends = {}
        for k, t in wide.items():
            at = cuts[bands.index((k[0], t[0], t[1]))]
            ends[k] = (at[grid.index(marks[k][0])], at[grid.index(marks[k][1])])
        counts = base.agg(
            *[
                F.struct(
                    F.count_if(between(k[0], *wide[k][:2]) & (F.col(f"v{k[0]}") < low)).alias("less"),
                    F.count_if(F.col(f"v{k[0]}") == low).alias("low"),
                    F.count_if(between_all(k[0], low, high, *wide[k][:2])).alias("inside"),
                    F.count_if(F.col(f"v{k[0]}") == high).alias("high"),
                )
                for k, (low, high) in ends.items()
            ]
        ).first()
        for (k, (low, high)), n in zip(ends.items(), counts):
            start, end, rank, size = wide[k]
            if rank < n.less:
                open_ranks[k] = (start, low, rank, n.less)
                continue
            rank -= n.less + n.low
            middle, above = (0, 0) if low == high else (n.inside, n.high)
            if rank < 0:
                found[k] = low
            elif rank < middle:
                open_ranks[k] = (low, high, rank, middle)
                continue
            elif rank < middle + above:
                found[k] = high
            else:
                open_ranks[k] = (high, end, rank - middle - above, size - n.less - n.low - middle - above)
                continue
            del open_ranks[k]

    if open_ranks:
        bands = list(dict.fromkeys((k[0], t[0], t[1]) for k, t in open_ranks.items()))
        held = base.agg(
            *[F.array_sort(F.collect_list(F.when(between(*band), F.col(f"v{band[0]}")))).alias(f"b{j}") for j, band in enumerate(bands)]
        )
        picks = held.select(
            *[F.get(f"b{bands.index((k[0], t[0], t[1]))}", F.lit(t[2])) for k, t in open_ranks.items()]
        ).first()
        found.update(zip(open_ranks, picks))

    def quantile(i, size, p):
        place = p * (size - 1)
        a = found[i, int(place)]
        b = found[i, min(int(place) + 1, size - 1)]
        return a + (b - a) * (place - int(place))

    return {c: [quantile(i, sizes[i], p) if sizes[i] else None for p in probs] for i, c in enumerate(cols)}


def describe_long(df: DataFrame, cols, limit: int = 1_000_000) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles, max; one row per column. NaN counts as NULL."""
    cols = names(cols)
    df = without_nan(df, cols)
    stats = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            ).alias(f"s_{i}")
            for i, c in enumerate(cols)
        ],
        F.count(F.lit(1)).alias("__rows"),
    )
    quarts = exact_quantiles(df, cols, (0.25, 0.5, 0.75), limit)
    stats = stats.withColumns(
        {f"q_{i}": F.array(*[F.lit(q).cast("double") for q in quarts[c]]) for i, c in enumerate(cols)}
    )
    return _rows(
        stats,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                *[F.col(f"s_{i}")[k].alias(k) for k in ("n", "mean", "std", "min")],
                *[F.col(f"q_{i}")[j].alias(q) for j, q in enumerate(("p25", "p50", "p75"))],
                F.col(f"s_{i}")["max"].alias("max"),
            )
            for i, c in enumerate(cols)
        ],
    )


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def frequency_overview(frames: dict[str, tuple[DataFrame, list[str]]], date: str = "date") -> DataFrame:
    """Per source: rows, first and last date and the means of its columns, under positional names."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min(date).alias("earliest_date"),
            F.max(date).alias("latest_date"),
            *[F.avg(c).alias(f"avg_{i}") for i, c in enumerate(cols, 1)],
        ).withColumn("frequency", F.lit(name))
        for name, (df, cols) in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def decade_stats(df: DataFrame, cols, date: str = "date", e=(), digits: int | None = 2) -> DataFrame:
    """Mean, min, max and std (n-1) per decade, rounded half to even."""
    shown = lambda c: c if digits is None else F.bround(c, digits)
    aggs = {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}
    return df.groupBy(*names(e), decade(date).alias("decade")).agg(
        *[shown(f(c).cast("double")).alias(f"{c}_{k}") for c in names(cols) for k, f in aggs.items()]
    )


def month_profile(df: DataFrame, col: str, date: str = "date", e=()) -> DataFrame:
    return df.groupBy(*names(e), F.month(date).alias("month")).agg(F.avg(col).alias(col))


def mean_per_key(df: DataFrame, key, cols) -> DataFrame:
    return df.groupBy(*names(key)).agg(*[F.avg(c).alias(c) for c in names(cols)])


def common_window(df: DataFrame, e: str = "series", date: str = "date", value: str = "value") -> DataFrame:
    """Rows from the first date on which every series has started."""
    firsts = df.filter(F.col(value).isNotNull()).groupBy(e).agg(F.min(date).alias("first"))
    return df.filter(F.col(date) >= firsts.agg(F.max("first").alias("start")).scalar())


def zscore(df: DataFrame, cols, e=(), suffix: str = "") -> DataFrame:
    """(x - mean) / population std over the table or key; a std of 0 divides by 1."""
    cols, keys = names(cols), names(e)
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols]
    )
    z = {
        f"{c}{suffix}": (F.col(c) - F.col(f"__m_{c}"))
        / F.when(F.col(f"__s_{c}") == 0, 1.0).otherwise(F.col(f"__s_{c}"))
        for c in cols
    }
    return attach(df, stats, keys).withColumns(z).drop(*[f"__{k}_{c}" for c in cols for k in "ms"])


def quality_report(df: DataFrame, date: str, value: str, e=(), as_of=None, sigma: float = 3.0, segment=None) -> DataFrame:
    """Per key: rows, completeness, age in days, repeated dates, values beyond sigma standard
    deviations, and steps between dates that differ from the key's shortest step."""
    keys = names(e)
    end = F.lit(as_of).cast("date") if as_of is not None else df.agg(F.max(F.col(date).cast("date")).alias("d")).scalar()

    spread = df.groupBy(*keys).agg(F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"))
    far = F.abs(F.col(value) - F.col("__m")) > sigma * F.col("__s")
    rows = attach(df, spread, keys)

    # One row per key and date first: the spacing check then runs on dates, not on rows.
    days = rows.groupBy(*keys, date).agg(
        F.count(F.lit(1)).alias("__n"), F.count(value).alias("__held"), F.count_if(far).alias("__far")
    )
    stepped = over_rows(
        stage(days, "days"), date, lambda w: {"__step": F.datediff(F.col(date), F.lag(date).over(w))}, keys, before=1, segment=segment
    )
    shortest = stepped.groupBy(*keys).agg(F.min("__step").alias("__shortest"))
    return (
        attach(stepped, shortest, keys)
        .groupBy(*keys)
        .agg(
            F.sum("__n").alias("row_count"),
            (F.sum("__held") / F.sum("__n")).alias("completeness"),
            F.datediff(end, F.max(date)).alias("age_days"),
            F.sum(F.col("__n") - 1).alias("duplicate_rows"),
            F.sum("__far").alias("outliers"),
            F.count_if(F.col("__step") != F.col("__shortest")).alias("uneven_steps"),
        )
    )


# Theme -> macro columns.
THEMES = {
    "Interest Rates": ["fedfundrate", "marketyield2yr", "marketyield10yr", "inflationrate", "mortgagerate30yr"],
    "Inflation": ["cpiurban"],
    "Credit & Lending": ["delinq", "ownedconsumercredit"],
    "Economic Growth": ["realgdp"],
    "Labor Market": ["unemployrate"],
}


def by_theme(df: DataFrame, ids, groups: dict[str, list[str]] = THEMES) -> DataFrame:
    """Long form of the grouped columns the table has, each row tagged with its theme."""
    theme_of = {c: theme for theme, cols in groups.items() for c in cols if c in df.columns}
    long = to_long(df, ids, list(theme_of), "indicator", "value")
    label = F.create_map(*[F.lit(x) for kv in theme_of.items() for x in kv])
    return long.withColumn("theme", label[F.col("indicator")])
