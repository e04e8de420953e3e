"""Forecast models on MLlib, metrics, scoring, regimes."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import week_label
from tidemark.functions.numbers import safe_corr
from tidemark.operators.ordered import attach, names, over_rows, place
from tidemark.operators.profile import zscore
from tidemark.operators.rolling import last_n, time_split, with_lags
from tidemark.operators.select import fill_features
from tidemark.plans.clusters import regimes as regimes
from tidemark.session import stage

# Hyper-parameters a search draws from.
SEARCH_SPACE = {
    "linear_regression": {},
    "elastic_net": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1.0], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]},
    "random_forest": {
        "n_estimators": [100, 200, 300], "max_depth": [None, 5, 8, 12], "min_samples_split": [2, 5, 10],
    },
    "gradient_boosting": {"n_estimators": [100, 200], "learning_rate": [0.01, 0.05, 0.1], "max_depth": [2, 3, 4]},
    "xgboost": {
        "n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.05, 0.1], "max_depth": [3, 4, 5, 6],
        "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0],
    },
    "lightgbm": {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.05, 0.1], "num_leaves": [31, 63, 127]},
}
LAG_SPACE = [1, 2, 3]
SEED = 42
#: Weight of a row that stands for several.
ROWS = "__rows"
#: Forests over at least so many rows draw their rows into sums by different features, if these have so many rows each.
BAG_ROWS = 1_000_000
BAG_REPEATS = 50
#: Rows that one task of a tree's fit may have.
TREE_ROWS = 100_000


def baseline(df: DataFrame, order, y: str, e=(), n: int = 3) -> DataFrame:
    """Constant forecast per key: mean of the target's last n rows, NULL counted as 0."""
    tail = last_n(df.select(*names(e), *names(order), F.coalesce(F.col(y), F.lit(0.0)).alias(y)), order, n, e)
    return tail.groupBy(*names(e)).agg(F.avg(y).alias("baseline"))


def _pipeline(features, estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=names(features), outputCol="features"), estimator])


def _fit(train: DataFrame, features, y: str, estimator, cells: bool = False) -> PipelineModel:
    clean = fill_features(train.select(*names(features), y), [*names(features), y])
    if cells:
        n, different = _different(clean, features)
        # Otherwise the rows are left as they are and in their order, so that the choice among equally good splits does not change for no gain.
        cells = 2 * different <= n
    return _pipeline(features, estimator.setWeightCol(ROWS) if cells else estimator).fit(_cells(clean, features, y) if cells else clean)


def _different(clean: DataFrame, features) -> tuple[int, int]:
    """The number of rows and, about, of different features."""
    return tuple(clean.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*names(features)))).first())


def _poisson(uniform: Column) -> Column:
    """A draw of the Poisson distribution with mean 1 from a uniform number."""
    bounds, chance, total = [], math.exp(-1), 0.0
    for k in range(1, 14):
        total += chance
        bounds.append(total)
        chance /= k
    out = F.lit(len(bounds))
    for k, bound in reversed(list(enumerate(bounds))):
        out = F.when(uniform < bound, k).otherwise(out)
    return out


def _bags(clean: DataFrame, features, y: str, trees: int) -> DataFrame:
    """The bootstrap rows of each tree as one row per different features: how often its rows were drawn, and their mean target. Every row is drawn
    by itself and by each tree anew, as MLlib does, but is read once; its draws are added up before the shuffle."""
    drawn = clean.select(*names(features), y, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("__tree")).withColumn("__u", F.rand(SEED))
    drawn = drawn.withColumn(ROWS, _poisson(F.col("__u"))).filter(F.col(ROWS) > 0)
    weighted = F.sum(F.col(ROWS) * F.col(y)) / F.sum(ROWS)
    return drawn.groupBy("__tree", *names(features)).agg(weighted.alias(y), F.sum(ROWS).cast("double").alias(ROWS)).repartition("__tree").sortWithinPartitions("__tree")


def _fit_bagged(clean: DataFrame, features, y: str, estimator: RandomForestRegressor, different: int, parallelism: int = 8) -> PipelineModel:
    """The forest's trees, each fitted by itself to its bag, in one model."""
    trees, subset = estimator.getNumTrees(), estimator.getFeatureSubsetStrategy()
    bags = stage(VectorAssembler(inputCols=names(features), outputCol="features").transform(_bags(clean, features, y, trees)), "bags")
    # For a single tree "auto" would mean all features.
    single = estimator.copy().setNumTrees(1).setBootstrap(False).setWeightCol(ROWS).setFeatureSubsetStrategy("onethird" if subset == "auto" else subset)

    def fit(tree: int):
        bag = bags.filter(F.col("__tree") == tree).coalesce(max(1, different // TREE_ROWS))
        return single.copy().setSeed(SEED + tree).fit(bag)

    with ThreadPool(min(parallelism, trees)) as pool:
        fitted = pool.map(inheritable_thread_target(clean.sparkSession)(fit), range(trees))
    context = clean.sparkSession.sparkContext
    regression = context._jvm.org.apache.spark.ml.regression
    held = context._gateway.new_array(regression.DecisionTreeRegressionModel, trees)
    for i, model in enumerate(fitted):
        held[i] = model._java_obj.trees()[0]
    forest = RandomForestRegressionModel(regression.RandomForestRegressionModel(estimator.uid, held, len(names(features))))
    # The mean over the trees is their sum by the parameter ``numTrees``.
    return PipelineModel([VectorAssembler(inputCols=names(features), outputCol="features"), estimator._copyValues(forest)])


def _cells(clean: DataFrame, features, y: str) -> DataFrame:
    """Rows of equal features as one, with their mean target and their number as its weight. No split tells such rows
    apart, and their spread adds the same to the squared error of every tree, so the best splits and the means of the leaves are those
    of the single rows; a pass over the rows per level and round becomes one sum."""
    return clean.groupBy(*names(features)).agg(F.avg(y).alias(y), F.count(F.lit(1)).cast("double").alias(ROWS))


def fit_linear(train, features, y) -> PipelineModel:
    return _fit(train, features, y, LinearRegression(labelCol=y, solver="normal"))


def fit_elastic(train, features, y, alpha: float = 1.0, l1_ratio: float = 0.5) -> PipelineModel:
    """Minimises squared error / 2n + alpha * (l1_ratio * |b| + (1 - l1_ratio) / 2 * b^2).

    MLlib divides both penalties by the target's std, which is right for the absolute one only, so the
    two are restated before the fit.
    """
    spread = train.agg(F.stddev_pop(F.coalesce(F.col(y), F.lit(0.0)))).first()[0] or 1.0
    absolute, square = alpha * l1_ratio, alpha * (1 - l1_ratio) * spread
    total = absolute + square
    estimator = LinearRegression(
        labelCol=y, regParam=total, elasticNetParam=absolute / total if total else 0.0, standardization=False,
        maxIter=500, tol=1e-9,
    )
    return _fit(train, features, y, estimator)


def fit_forest(
    train, features, y, n_estimators=100, max_depth=None, min_samples_split=2, bootstrap=True, feature_subset="auto", max_bins=32,
) -> PipelineModel:
    """A forest. MLlib bounds the rows of a child, not of a node that is split: ``min_samples_split`` asks for half as many in
    each child, so no smaller node is split, and of the larger ones those that would leave a tiny child are not either.
    Without draws of rows and without such a bound, rows of equal features are learnt from as one. With draws, over many rows of few different
    features, each tree learns from the sums of its draws by features."""
    estimator = RandomForestRegressor(
        labelCol=y, numTrees=n_estimators, maxDepth=30 if max_depth is None else max_depth, seed=SEED, bootstrap=bootstrap,
        featureSubsetStrategy=feature_subset, minInstancesPerNode=max(1, min_samples_split // 2), maxBins=max_bins,
    )
    if bootstrap and n_estimators > 1 and min_samples_split < 4:
        cols = [*names(features), y]
        clean = fill_features(train.select(*cols), cols)
        n, different = _different(clean, features)
        if n >= BAG_ROWS and different * BAG_REPEATS <= n:
            return _fit_bagged(clean, features, y, estimator, different)
    return _fit(train, features, y, estimator, cells=not bootstrap and min_samples_split < 4)


def fit_gbt(
    train, features, y, n_estimators=100, learning_rate=0.1, max_depth=3, subsample=1.0, colsample_bytree=1.0, num_leaves=None,
    max_bins=32, valid: DataFrame | None = None, stop_gain: float = 0.01,
) -> PipelineModel:
    """Boosted trees, for all three boosting names of the search space. A tree of ``num_leaves`` leaves is grown to the depth that holds as many.
    With ``valid`` rows, boosting stops where a round no longer lowers their error by the share ``stop_gain``. Where all rows are taken in every
    round, those of equal features are learnt from as one."""
    estimator = GBTRegressor(
        labelCol=y, maxIter=n_estimators, stepSize=learning_rate, subsamplingRate=subsample, seed=SEED, maxBins=max_bins,
        maxDepth=max_depth if num_leaves is None else (num_leaves - 1).bit_length(),
        featureSubsetStrategy="all" if colsample_bytree >= 1.0 else str(colsample_bytree),
    )
    if valid is None:
        return _fit(train, features, y, estimator, cells=subsample >= 1.0)
    estimator.setValidationIndicatorCol("__valid").setParams(validationTol=stop_gain)
    cols = [*names(features), y]
    both = [fill_features(df.select(*cols), cols).withColumn("__valid", F.lit(held)) for df, held in ((train, False), (valid, True))]
    return _pipeline(features, estimator).fit(both[0].unionByName(both[1]))


FITS: dict[str, Callable] = {
    "linear_regression": fit_linear,
    "elastic_net": fit_elastic,
    "random_forest": fit_forest,
    "gradient_boosting": fit_gbt,
    "xgboost": fit_gbt,
    "lightgbm": fit_gbt,
}


def draws(space: dict[str, list], n: int = 20, seed: int = SEED) -> list[dict]:
    """n random parameter sets, drawn with replacement."""
    if not space:
        return [{}]
    rng = random.Random(seed)
    return [{k: rng.choice(v) for k, v in space.items()} for _ in range(n)]


def random_search(
    train, test, features, y, algorithm: str, space=None, n=20, seed=SEED, parallelism: int = 4
) -> tuple[PipelineModel, dict, float]:
    """Fit n draws, ``parallelism`` at a time, and keep the one with the lowest mean absolute error on ``test``; of equal
    ones the first drawn. A set drawn twice is fitted once, and one whose parameters the estimator refuses is skipped.
    Pass a validation split as ``test`` to keep the hold-out out of the choice."""

    def attempt(params):
        try:
            model = FITS[algorithm](train, features, y, **params)
            mae = score(model, test, features).agg(F.avg(F.abs(F.coalesce(F.col(y), F.lit(0.0)) - F.col("prediction")))).first()[0]
        except (IllegalArgumentException, TypeError) as error:  # bad parameters end a draw; a lost cluster ends the search
            print(f"draw {params} failed: {error}")
            return None
        return None if mae is None else (model, params, mae)

    drawn = draws(SEARCH_SPACE[algorithm] if space is None else space, n, seed)
    different = [p for i, p in enumerate(drawn) if p not in drawn[:i]]
    with ThreadPool(min(parallelism, len(different))) as pool:
        tried = pool.map(inheritable_thread_target(train.sparkSession)(attempt), different)
    fitted = [t for t in tried if t is not None]
    if not fitted:
        raise RuntimeError(f"no parameter set of {algorithm} could be fitted")
    return min(fitted, key=lambda t: t[2])


def score(model: PipelineModel, df: DataFrame, features) -> DataFrame:
    """Adds prediction; NULL features count 0."""
    return model.transform(fill_features(df, features)).drop("features")


def with_errors(df: DataFrame, y: str, yhat: str = "prediction") -> DataFrame:
    """Adds error, its size, and its percentage of the actual value (2 decimals, NULL for 0)."""
    error = F.col(yhat) - F.col(y)
    return df.withColumns(
        {"error": error, "abs_error": F.abs(error), "pct_error": F.bround(F.try_divide(error, F.col(y)) * 100, 2)}
    )


def train_and_serve(
    features: DataFrame, y: str, xs, order=("year", "week"), holdout: int = 100, fit: Callable = fit_linear, e=()
) -> DataFrame:
    """Split a feature table by rank, fit on the early rows, and score the last ``holdout`` with errors and week labels.
    NULL features and targets count 0 in training, NULL features 0 in serving; errors of unknown targets are NULL."""
    split = stage(time_split(features.select(*names(e), *names(order), *names(xs), y), list(order), holdout, e), "split")
    model = fit(split.filter("split = 'train'"), xs, y)
    served = score(model, split.filter("split = 'test'"), xs)
    return label_history(with_errors(served, y)).drop("split")


def label_history(df: DataFrame) -> DataFrame:
    return df.withColumn("label", week_label("year", "week"))


def arx_frame(df: DataFrame, order, y: str, xs=(), p: int = 1, e=(), segment=None) -> DataFrame:
    """Lag columns of target and drivers, rows with a full history only."""
    lagged = with_lags(df, order, [y, *names(xs)], list(range(1, p + 1)), e, segment)
    return lagged.dropna(subset=[f"{c}__lag_{k}" for c in [y, *names(xs)] for k in range(1, p + 1)])


def fit_arx(df, order, y: str, xs=(), p: int = 1, e=(), segment=None) -> PipelineModel:
    """Autoregression on p lags of the target and of the drivers, fitted over all keys."""
    features = [f"{c}__lag_{k}" for c in [y, *names(xs)] for k in range(1, p + 1)]
    return _fit(arx_frame(df, order, y, xs, p, e, segment), features, y, LinearRegression(labelCol=y, solver="normal"))


def search_arx(df, order, y: str, xs=(), ps=LAG_SPACE, holdout: int = 100, e=(), segment=None) -> tuple[PipelineModel, int, float]:
    """The number of lags with the lowest mean absolute error on the last ``holdout`` rows per key."""
    best = None
    for p in ps:
        features = [f"{c}__lag_{k}" for c in [y, *names(xs)] for k in range(1, p + 1)]
        lagged = stage(arx_frame(df, order, y, xs, p, e, segment), "lags")
        frame = stage(time_split(lagged, order, holdout, e, segment), "arx")
        train, test = frame.filter("split = 'train'"), frame.filter("split = 'test'")
        model = _fit(train, features, y, LinearRegression(labelCol=y, solver="normal"))
        mae = score(model, test, features).agg(F.avg(F.abs(F.col(y) - F.col("prediction")))).first()[0]
        if mae is not None and (best is None or mae < best[2]):
            best = (model, p, mae)
    if best is None:
        raise RuntimeError("no number of lags could be fitted")
    return best


def fit_ar1(df: DataFrame, order, y: str, e=(), segment=None) -> DataFrame:
    """Closed-form AR(1) per key: intercept, slope, last value. Rows that tie stand in one total order for lag and last value."""
    slim = df.select(*names(e), *names(order), y)
    moved = over_rows(slim, order, lambda w: {"__lag": F.lag(y).over(w), "__place": place(slim, order)}, e, before=1, segment=segment)
    return moved.groupBy(*names(e)).agg(
        F.regr_intercept(y, "__lag").alias("intercept"),
        F.regr_slope(y, "__lag").alias("slope"),
        F.max_by(y, F.when(F.col(y).isNotNull(), F.col("__place"))).alias("last_value"),
    )


def forecast_ar1(params: DataFrame, horizon: int) -> DataFrame:
    """The next ``horizon`` values of each key by recursion."""
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.array(F.col("last_value")),
        lambda acc, _: F.concat(acc, F.array(F.col("intercept") + F.col("slope") * F.element_at(acc, -1))),
    )
    rest = [c for c in params.columns if c not in ("intercept", "slope", "last_value")]
    return params.select(*rest, F.posexplode(path).alias("step", "forecast")).filter(F.col("step") > 0)


def forecast_metrics(df: DataFrame, order, y: str, yhat: str, e=(), segment=None) -> DataFrame:
    """sMAPE, MAE, RMSE of the last 6 rows, MASE against the lag-1 forecast, R2 and Pearson r per key."""
    keys = names(e)
    moved = over_rows(df, order, lambda w: {"__step": F.abs(F.col(y) - F.lag(y).over(w))}, e, before=1, segment=segment)
    error = F.col(y) - F.col(yhat)
    size = F.greatest((F.abs(y) + F.abs(yhat)) / 2, F.lit(1e-8))
    errors = moved.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("test_count"),
        (F.avg(F.abs(error) / size) * 100).alias("smape"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg("__step").alias("__naive"),
        F.sum(error * error).alias("__sse"),
        F.var_pop(y).alias("__var_y"),
        safe_corr(y, yhat).alias("__r"),
    )
    recent = last_n(df, order, 6, e).groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse_recent6"))
    whole = attach(errors, recent, keys)
    return whole.select(
        *keys,
        "test_count", "smape", "mae", "rmse_recent6",
        (F.col("mae") / (F.col("__naive") + 1e-8)).alias("mase"),
        (1 - F.try_divide(F.col("__sse"), F.col("__var_y") * F.col("test_count"))).alias("r2"),
        F.col("__r").alias("pearson_r"),
    )


def pca(df: DataFrame, cols, k: int = 3) -> tuple[DataFrame, list[float]]:
    """Components of the standardised columns (pc1..pck) and the variance share of each."""
    cols = names(cols)
    scaled = zscore(df.dropna(subset=cols), cols, suffix="__z")
    assembled = VectorAssembler(inputCols=[f"{c}__z" for c in cols], outputCol="__x").transform(scaled)
    model = PCA(k=k, inputCol="__x", outputCol="__pc").fit(assembled)
    parts = vector_to_array(F.col("__pc"))
    out = model.transform(assembled).withColumns({f"pc{i + 1}": parts[i] for i in range(k)})
    return out.drop("__x", "__pc", *[f"{c}__z" for c in cols]), [float(v) for v in model.explainedVariance]


def cluster_profile(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in names(cols)], F.count(F.lit(1)).alias("n_rows"))


def impute(df: DataFrame, cols, how: str = "mean") -> DataFrame:
    """Fill NULLs of each column with its mean or median."""
    cols = names(cols)
    return Imputer(inputCols=cols, outputCols=cols, strategy=how).fit(df).transform(df)
