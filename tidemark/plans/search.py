"""Parameter search by successive halving: all draws on a share of rows and rounds, the best go on with more."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import names
from tidemark.plans.models import FITS, SEARCH_SPACE, SEED, draws, score
from tidemark.session import stage

#: Algorithms whose ``n_estimators`` is their number of rounds; those that can stop by themselves.
ROUNDS = ("random_forest", "gradient_boosting", "xgboost", "lightgbm")
STOPPING = ("gradient_boosting", "xgboost", "lightgbm")
LEAST_ROUNDS = 5


@dataclass
class Found:
    model: PipelineModel
    params: dict
    mae: float
    #: (rung, share, params, mae) of every fit; mae None where it failed.
    tried: list[tuple[int, float, dict, float | None]] = field(default_factory=list)


def rungs(n: int, eta: int) -> list[float]:
    """The shares of rows that n sets go through, the last one whole: as many as it takes to come down to one set."""
    count, left = 1, n
    while (left := -(-left // eta)) > 1:
        count += 1
    return [eta ** -(count - 1 - i) for i in range(count)]


def reduced(algorithm: str, params: dict, share: float) -> dict:
    """The parameters with that share of the rounds."""
    if share >= 1 or algorithm not in ROUNDS or "n_estimators" not in params:
        return params
    rounds = params["n_estimators"]
    return {**params, "n_estimators": min(rounds, max(LEAST_ROUNDS, round(rounds * share)))}


def halving_search(
    train: DataFrame, valid: DataFrame, features, y: str, algorithm: str, space: dict | None = None, n: int = 20, seed: int = SEED,
    eta: int = 3, parallelism: int = 4, fits: dict[str, Callable] = FITS, stop_gain: float | None = None,
) -> Found:
    """The set of parameters with the lowest mean absolute error on ``valid``, of equal ones the first drawn.

    All n draws are fitted on a small share of the rows with as small a share of their rounds; of each rung the best of ``eta`` go
    on with ``eta`` times as much, and the last rung is whole. With 20 draws that is about four whole fits in place of
    20. Shares are nested and depend on the rows alone (equal rows go together), so reruns agree. Errors are always taken on all of ``valid``. With ``stop_gain``
    boosters of the last rung also stop by themselves. A set drawn twice is fitted once; one whose parameters the
    estimator refuses is left out. Both frames are staged, so the input is read once.
    """
    drawn = draws(SEARCH_SPACE[algorithm] if space is None else space, n, seed)
    alive = [p for i, p in enumerate(drawn) if p not in drawn[:i]]
    shares = rungs(len(alive), eta)
    parts = eta ** (len(shares) - 1)
    cols = [*names(features), y]
    marked = train.select(*cols, F.pmod(F.xxhash64(*cols), F.lit(parts)).alias("__part"))
    rows, valid = stage(marked, "search-train"), stage(valid.select(*cols), "search-valid")
    tried, best = [], []
    for rung, share in enumerate(shares):
        part = rows.filter(F.col("__part") < round(share * parts)).drop("__part")
        last = rung == len(shares) - 1

        def attempt(params):
            try:
                more = {"valid": valid, "stop_gain": stop_gain} if last and stop_gain is not None and algorithm in STOPPING else {}
                model = fits[algorithm](part, features, y, **reduced(algorithm, params, share), **more)
                error = F.abs(F.coalesce(F.col(y), F.lit(0.0)) - F.col("prediction"))
                return model, params, score(model, valid, features).agg(F.avg(error)).first()[0]
            except (IllegalArgumentException, TypeError) as error:  # bad parameters end a draw; a lost cluster ends the search
                print(f"draw {params} failed: {error}")
                return None, params, None

        with ThreadPool(min(parallelism, len(alive))) as pool:
            fitted = pool.map(inheritable_thread_target(train.sparkSession)(attempt), alive)
        tried += [(rung, share, params, mae) for _, params, mae in fitted]
        best = sorted((f for f in fitted if f[2] is not None), key=lambda f: f[2])
        if not best:
            raise RuntimeError(f"no parameter set of {algorithm} could be fitted")
        alive = [p for _, p, _ in best[:-(-len(alive) // eta)]]
    return Found(*best[0], tried)


def search_all(
    train: DataFrame, valid: DataFrame, features, y: str, algorithms=tuple(SEARCH_SPACE), **options,
) -> dict[str, Found]:
    """``halving_search`` over each algorithm's own space."""
    return {name: halving_search(train, valid, features, y, name, **options) for name in algorithms}
