"""K-means regimes: all starts in one scan per step."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import names
from tidemark.operators.profile import zscore
from tidemark.session import stage

#: Rows that first centres are drawn from; the steps themselves take all rows.
SEED_ROWS = 2000
STEPS = 30
TOLERANCE = 1e-4

Centres = list[list[float]]


def _nearest(k: int, width: int, start: str = "0") -> str:
    """Struct of squared distance of x and number of the nearest of the k centres of a start, which stand one after the other in the
    flat array ``__at``; of equally near ones the first."""
    place = lambda j, i: f"__at[{start} * {k * width} + {j * width + i}]"
    square = lambda j, i: f"(x[{i}] - {place(j, i)}) * (x[{i}] - {place(j, i)})"
    cost = lambda j: " + ".join(square(j, i) for i in range(width))
    told = [f"named_struct('cost', {cost(j)}, 'cluster', {j})" for j in range(k)]
    return f"least({', '.join(told)})" if k > 1 else told[0]


def _with_centres(points: DataFrame, starts: list[Centres]) -> DataFrame:
    """The centres as one array beside every row: values in a plan, not in its text, so that every step runs the same compiled code."""
    flat = [float(v) for centres in starts for c in centres for v in c]
    held = points.sparkSession.createDataFrame([(flat,)], "at ARRAY<DOUBLE>")
    return points.withColumn("__at", held.scalar())


def nearest(points: DataFrame, centres: Centres, name: str = "cluster") -> DataFrame:
    """Adds the number of the centre nearest to ``x``."""
    found = F.expr(_nearest(len(centres), len(centres[0])))
    return _with_centres(points, [centres]).withColumn(name, found["cluster"]).drop("__at")


def lloyd_step(points: DataFrame, starts: dict[int, Centres]) -> dict[int, tuple[Centres, float]]:
    """One step of every start over ``points`` (x, an array; n, how many rows it stands for, or else one): the means of the rows
    nearest to each centre, and the cost of the centres given. A row is read once for all starts, and its share of the sums is added up before the shuffle: one row per
    start and centre comes out of each task. A centre that no row is nearest to stays."""
    names_, given = list(starts), list(starts.values())
    k, width = len(given[0]), len(given[0][0])
    many = F.col("n") if "n" in points.columns else F.lit(1)
    each = points.select("x", many.alias("many"), F.explode(F.sequence(F.lit(0), F.lit(len(given) - 1))).alias("start"))
    each = _with_centres(each, given).select("x", "many", "start", F.expr(_nearest(k, width, "start")).alias("near")).select("x", "many", "start", "near.*")
    total = lambda c: F.sum(c * F.col("many"))
    sums = each.groupBy("start", "cluster").agg(F.sum("many").alias("n"), total(F.col("cost")).alias("cost"), *[total(F.col("x")[i]).alias(f"s_{i}") for i in range(width)])
    moved, cost = [[list(c) for c in centres] for centres in given], [0.0] * len(given)
    for r in sums.collect():  # starts x centres rows
        moved[r["start"]][r["cluster"]] = [r[f"s_{i}"] / r["n"] for i in range(width)]
        cost[r["start"]] += r["cost"]
    return {s: (moved[n], cost[n]) for n, s in enumerate(names_)}


def lloyd(points: DataFrame, starts: dict[int, Centres], steps: int = STEPS, tolerance: float = TOLERANCE) -> dict[int, tuple[Centres, float]]:
    """Steps until no centre of a start moves by more than ``tolerance``; starts that have settled are left out of later scans. The
    cost is that of the centres one step before."""
    done, alive = {}, dict(starts)
    for _ in range(steps):
        moved = lloyd_step(points, alive)
        for s, (centres, cost) in moved.items():
            done[s] = centres, cost
        alive = {s: c for s, (c, _) in moved.items() if np.abs(np.array(c) - np.array(alive[s])).max() > tolerance}
        if not alive:
            break
    return done


def first_centres(points: DataFrame, k: int, starts: int, seed: int) -> dict[int, Centres]:
    """Centres far apart from each other (k-means++), drawn from the rows with the smallest hash, the same in every run."""
    rows = points.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(SEED_ROWS).toArrow()
    sample = np.array(rows.column("x").to_pylist(), float)
    out = {}
    for s in range(starts if len(sample) else 0):
        rng = np.random.default_rng(seed + s)
        picked = [sample[rng.integers(len(sample))]]
        while len(picked) < k:
            far = np.min([((sample - c) ** 2).sum(1) for c in picked], axis=0)
            odds = far / far.sum() if far.sum() > 0 else None
            picked.append(sample[rng.choice(len(sample), p=odds)])
        out[s] = [list(map(float, c)) for c in picked]
    return out


def standardised(df: DataFrame, cols) -> tuple[DataFrame, list[str]]:
    """Rows that have all columns, with the standardised ones under names of their own."""
    cols = names(cols)
    return zscore(df.dropna(subset=cols), cols, suffix="__z"), [f"{c}__z" for c in cols]


def regimes(df: DataFrame, cols, k: int = 3, starts: int = 10, seed: int = 42, begin: Sequence[Centres] | None = None, steps: int = STEPS) -> DataFrame:
    """K-means cluster of each row on its standardised columns; of several starts the tightest is kept. Clusters are numbered by
    their first centre coordinate. All starts go over one staged frame of the distinct standardised points together, each weighing as
    many rows as lie on it, and settle within some scans; ``begin`` gives their first centres."""
    scaled, zs = standardised(df, cols)
    scaled = stage(scaled, "regimes")
    points = scaled.select(F.array(*zs).alias("x"))
    first = dict(enumerate(begin)) if begin is not None else first_centres(points, k, starts, seed)
    if not first:
        return scaled.withColumn("cluster", F.lit(0)).drop(*zs)
    counted = scaled.groupBy(*zs).agg(F.count(F.lit(1)).alias("n")).select(F.array(*zs).alias("x"), "n")
    found = lloyd(stage(counted, "regimes-points"), first, steps)
    best, _ = min(found.values(), key=lambda f: f[1])
    whole = scaled.select(F.struct(*[c for c in scaled.columns if c not in zs]).alias("__row"), F.array(*zs).alias("x"))
    return nearest(whole, sorted(best)).select("__row.*", "cluster")
