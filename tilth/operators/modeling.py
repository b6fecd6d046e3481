"""Model fitting, tuning and scoring.

Estimators are Spark ML (distributed fits); the hyperparameter mapping from the
reference's scikit-learn settings is documented per function.  Folds come from
the same key hash as the splits, so cross-validation is reproducible under any
partitioning.  Simple (one-feature) least squares and its k-fold loss are
plain aggregates: sufficient statistics per fold, one pass, no model objects.
"""

from __future__ import annotations

import itertools
import math
import random
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.operators.encode import hash_unit, ml_encoder


def fold_column(key: str, k: int, seed: int = 7, name: str = "fold"):
    return F.floor(hash_unit(F.col(key), seed) * k).cast("int").alias(name)


# ---- closed-form simple regression -----------------------------------------------

def simple_ols(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Slope, intercept and R2 of y on x per group, from aggregates."""
    by = by or []
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n"))


def kfold_simple_ols(df: DataFrame, x: str, y: str, key: str, k: int = 5, seed: int = 7,
                     by: list[str] | None = None) -> DataFrame:
    """Held-out MSE per fold (and ``by`` group) of one-feature least squares fitted on the
    other folds, from one pass over the rows.

    Per-fold count, means and centred moments are one aggregate.  The moments of the
    other folds are the total's less the fold's, and the error on the fold is a function
    of its own moments, so neither needs the rows again."""
    by = list(by or [])
    ok = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, fold_column(key, k, seed), x, y)
    s = ok.groupBy(*by, "fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"),
        F.var_pop(y).alias("vy"), F.covar_pop(x, y).alias("cxy")).withColumn("_all", F.lit(0))
    w = Window.partitionBy(*by, "_all")                     # k rows
    n = F.col("n")
    s = s.select("*", F.sum("n").over(w).alias("_n_all"), (F.sum(n * F.col("mx")).over(w) / F.sum("n").over(w)).alias("_x_all"),
                 (F.sum(n * F.col("my")).over(w) / F.sum("n").over(w)).alias("_y_all"))
    dx, dy = F.col("mx") - F.col("_x_all"), F.col("my") - F.col("_y_all")
    s = s.select("*", (F.col("_n_all") - n).alias("rest"), F.sum(n * (F.col("vx") + dx * dx)).over(w).alias("_sxx"),
                 F.sum(n * (F.col("cxy") + dx * dy)).over(w).alias("_sxy"))
    tx, ty = [(F.col("_n_all") * F.col(t) - n * F.col(m)) / F.col("rest") for t, m in (("_x_all", "mx"), ("_y_all", "my"))]
    gx, gy = F.col("mx") - tx, F.col("my") - ty
    share = n * F.col("rest") / F.col("_n_all")
    slope = F.try_divide(F.col("_sxy") - n * F.col("cxy") - share * gx * gy, F.col("_sxx") - n * F.col("vx") - share * gx * gx)
    coef = s.withColumn("b", slope).withColumn("off", gy - F.col("b") * gx)
    b = F.col("b")
    mse = F.col("vy") - 2 * b * F.col("cxy") + b * b * F.col("vx") + F.col("off") * F.col("off")
    return coef.select(*by, "fold", mse.alias("mse"), "n")


def cv_loss(fold_losses: DataFrame, by: list[str] | None = None) -> DataFrame:
    return fold_losses.groupBy(*(by or [])).agg(F.avg("mse").alias("cv_mse"), F.count(F.lit(1)).alias("folds"))


def trial_summary(trials: DataFrame, loss: str = "cv_mse") -> DataFrame:
    """Best (lowest) loss, mean and population std over the trials."""
    return trials.agg(F.count(F.lit(1)).alias("n_trials"), F.min(loss).alias("best_loss"),
                      F.min_by("trial", F.col(loss)).alias("best_trial"),
                      F.avg(loss).alias("mean_loss"), F.stddev_pop(loss).alias("std_loss"))


def regression_metrics(scored: DataFrame, target: str, prediction: str, by: list[str]) -> DataFrame:
    """RMSE, R2 = 1 - SSE/SST, MAE and mean error per group, over the rows that have both a
    target and a prediction."""
    # no filter on the prediction: Spark would compute it once to filter and again to sum
    e = F.col(prediction) - F.col(target)
    y = F.when(e.isNotNull(), F.col(target))
    agg = scored.groupBy(*by).agg(
        F.count(e).alias("n"), F.sum(e * e).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("mean_error"))
    if by:
        agg = agg.where("n > 0")
    return agg.select(*by, "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
                      (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"), "mae", "mean_error")


def leaderboard(predictions_long: DataFrame, target: str = "target", prediction: str = "prediction",
                model: str = "model") -> DataFrame:
    """Metrics per model on one evaluation set, best (lowest RMSE) first."""
    m = regression_metrics(predictions_long, target, prediction, [model])
    return m.orderBy("rmse", model)


# ---- linear models from one pass ----------------------------------------------------

MAX_FEATURES = 2000     # the moment matrix of this many features is 32 MB a fold
ORIGIN_ROWS = 500       # rows that place the origin of the sums
WRITTEN_OUT = 64        # weights up to which a prediction is one compiled expression


@dataclass(frozen=True)
class Moments:
    """n, means and centred cross products of (features, target) of some rows."""
    n: float
    mean: np.ndarray
    cross: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        n = self.n - other.n
        mean = (self.n * self.mean - other.n * other.mean) / n
        gap = other.mean - mean
        return Moments(n, mean, self.cross - other.cross - np.outer(gap, gap) * other.n * n / self.n)


def _fold_sums(schema: pa.Schema, shift: np.ndarray):
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column("row").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(shift)) - shift
            rows = np.hstack([np.ones((len(rows), 1)), rows])
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(folds):
                x = rows[folds == f]
                sums[int(f)] = sums.get(int(f), 0) + x.T @ x
        for f, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([m.ravel()], pa.list_(pa.float64()))],
                                             schema=schema)
    return run


def fold_moments(encoded: DataFrame, features: str = "features", label: str = "target",
                 fold: str = "fold") -> dict[int, Moments]:
    """Moments of every fold from one pass over all rows, shifted by the means of the first
    ``ORIGIN_ROWS`` (an origin near the rows, so large values do not cancel; any origin gives
    the same moments).  What reaches the driver is a p x p matrix a fold."""
    row = F.concat(vector_to_array(F.col(features)), F.array(F.col(label).cast("double")))
    rows = encoded.where(F.col(label).isNotNull()).select(F.col(fold).cast("int").alias("fold"), row.alias("row"))
    near = [r["row"] for r in rows.select("row").limit(ORIGIN_ROWS).collect()]
    if not near:
        raise ValueError("no rows with a label")
    if len(near[0]) > MAX_FEATURES:
        raise ValueError(f"{len(near[0]) - 1} features; the one-pass solution takes at most {MAX_FEATURES - 1}")
    shift = np.array(near).mean(axis=0)
    schema = pa.schema([("fold", pa.int32()), ("m", pa.list_(pa.float64()))])
    entries = rows.mapInArrow(_fold_sums(schema, shift), "fold int, m array<double>").select(
        "fold", F.posexplode("m").alias("at", "x")).groupBy("fold", "at").agg(F.sum("x").alias("x"))
    # one array a fold reaches the driver, as Arrow
    summed = entries.groupBy("fold").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("m")).toArrow()
    p = len(shift) + 1
    out: dict[int, Moments] = {}
    for f, m in zip(summed.column("fold").to_pylist(), summed.column("m"), strict=True):
        m = m.values.to_numpy(zero_copy_only=False).reshape(p, p)
        n, mean = m[0, 0], m[0, 1:] / m[0, 0]
        out[f] = Moments(n, mean + shift, m[1:, 1:] - n * np.outer(mean, mean))
    return out


def merge(parts: list[Moments]) -> Moments:
    n = sum(m.n for m in parts)
    mean = sum(m.n * m.mean for m in parts) / n
    return Moments(n, mean, sum(m.cross + m.n * np.outer(m.mean - mean, m.mean - mean) for m in parts))


def solve_linear(m: Moments, alpha: float, kind: str = "ridge", sweeps: int = 50_000) -> tuple[np.ndarray, float]:
    """Weights and intercept on the raw features of ridge (|y - Xw|^2 + alpha |w|^2) or lasso
    (|y - Xw|^2 / 2n + alpha |w|_1) fitted on standardised features; a feature without
    spread gets no weight.  A lasso that has not settled after ``sweeps`` rounds raises."""
    sd = np.sqrt(np.diag(m.cross)[:-1] / m.n)
    live = sd > 1e-12
    scale = np.where(live, sd, 1.0)
    g = m.cross[:-1, :-1] / np.outer(scale, scale)
    c = np.where(live, m.cross[:-1, -1] / scale, 0.0)
    w = np.zeros(len(c))
    if kind == "ridge":
        at = np.flatnonzero(live)
        # minimum-norm solution where alpha is 0 and features depend on each other
        w[at] = np.linalg.lstsq(g[np.ix_(at, at)] + alpha * np.eye(len(at)), c[at], rcond=1e-12)[0]
    else:
        top = max(np.abs(c).max(initial=0.0) / m.n, 1e-300)
        for i in range(sweeps):
            before = w.copy()
            for j in np.flatnonzero(live):
                r = (c[j] - g[j] @ w + g[j, j] * w[j]) / m.n
                w[j] = np.sign(r) * max(0.0, abs(r) - alpha) / (g[j, j] / m.n)
            if np.abs(w - before).max() <= 1e-10 * max(1.0, np.abs(w).max()):
                break
            # features that depend on each other let weights wander at the optimum: there the
            # gradient conditions of the objective hold
            if i % 50 == 49:
                slope = (c - g @ w) / m.n
                off = np.where(w != 0, np.abs(slope - alpha * np.sign(w)), np.maximum(0.0, np.abs(slope) - alpha))
                if (off * live).max(initial=0.0) <= 1e-7 * top:
                    break
        else:
            raise RuntimeError(f"lasso with alpha {alpha} has not settled in {sweeps} rounds")
    w = w / scale
    return w, float(m.mean[-1] - w @ m.mean[:-1])


def stationarity(m: Moments, alpha: float, w: np.ndarray, kind: str = "ridge") -> float:
    """How far weights are from the optimum of their objective, as the greatest violation of
    its gradient conditions on standardised features, relative to the features' correlation
    with the target: 0 at the solution."""
    sd = np.sqrt(np.diag(m.cross)[:-1] / m.n)
    live = sd > 1e-12
    scale = np.where(live, sd, 1.0)
    v = w * scale
    slope = m.cross[:-1, -1] / scale - (m.cross[:-1, :-1] / np.outer(scale, scale)) @ v
    if kind == "ridge":
        off = np.abs(slope - alpha * v)
    else:
        off = np.where(v != 0, np.abs(slope / m.n - alpha * np.sign(v)), np.maximum(0.0, np.abs(slope / m.n) - alpha)) * m.n
    return float((off * live).max() / np.abs(m.cross[:-1, -1] / scale).max())


def linear_prediction(features: str, w: np.ndarray, intercept: float) -> Column:
    """Intercept plus features times weights, as a column expression."""
    if len(w) <= WRITTEN_OUT:
        row = vector_to_array(F.col(features))
        return reduce(lambda acc, i: acc + row[i] * F.lit(float(w[i])), range(len(w)), F.lit(float(intercept)))
    weights = F.array(*[F.lit(float(x)) for x in w])
    return F.aggregate(F.zip_with(vector_to_array(F.col(features)), weights, lambda x, y: x * y), F.lit(float(intercept)), lambda acc, x: acc + x)


def mse_of(m: Moments, w: np.ndarray, intercept: float) -> float:
    """Mean squared error of a linear model on the rows behind the moments."""
    d = np.append(-w, 1.0)
    return float(d @ m.cross @ d / m.n + (m.mean[-1] - w @ m.mean[:-1] - intercept) ** 2)


def search_linear(train: DataFrame, categorical: list[str], numeric: list[str], alphas: list[float], key: str,
                  kind: str = "ridge", k: int = 5, seed: int = 7) -> tuple[DataFrame, dict[int, Moments]]:
    """(trial, alpha, cv_mse) of every alpha by k hash folds, all from one pass over the rows."""
    enc = ml_encoder(categorical, numeric).fit(train)
    folds = fold_moments(enc.transform(train.withColumn("fold", fold_column(key, k, seed))))
    whole = merge(list(folds.values()))
    rows = [(i, float(a), float(np.mean([mse_of(f, *solve_linear(whole - f, a, kind)) for f in folds.values()])))
            for i, a in enumerate(alphas)]
    return train.sparkSession.createDataFrame(rows, "trial int, alpha double, cv_mse double"), folds


def draw_alphas(n_trials: int, low: float = 1e-4, high: float = 1e3, seed: int = 42) -> list[float]:
    """Seeded log-uniform draws (random search in place of a model-based one)."""
    rng = random.Random(seed)
    return [math.exp(rng.uniform(math.log(low), math.log(high))) for _ in range(n_trials)]


# The search spaces of the tree models (None: no limit on depth, in Spark 30).
FOREST_GRID = {"n_estimators": [20, 50, 100, 200, 300], "max_depth": [None, 10, 20, 30], "min_samples_leaf": [1, 2, 4],
               "max_features": [1.0, "sqrt", "log2"]}
BOOSTED_GRID = {"learning_rate": [0.001, 0.01, 0.1, 0.2, 0.5], "n_estimators": [20, 50, 100, 200, 300],
                "max_depth": [3, 5, 7, 10, 20]}
BOOSTED_SPACE = {"n_estimators": ("quniform", 50, 500, 10), "max_depth": ("quniform", 2, 10, 1),
                 "learning_rate": ("loguniform", 0.01, 0.3), "subsample": ("uniform", 0.5, 1.0),
                 "min_samples_leaf": ("quniform", 1, 5, 1)}


def draw(space: dict[str, tuple], n_trials: int, seed: int = 42) -> list[dict[str, float]]:
    """Seeded draws from a search space of uniform, log-uniform and quantised entries."""
    rng = random.Random(seed)

    def one(kind, low, high, step=None):
        if kind == "loguniform":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        x = rng.uniform(low, high)
        return int(round(x / step) * step) if kind == "quniform" else x

    return [{name: one(*entry) for name, entry in space.items()} for _ in range(n_trials)]


def tree_maps(estimator, settings: list[dict]) -> list[dict]:
    """Parameter maps of a forest or boosted-tree estimator for grid or drawn settings."""
    forest = isinstance(estimator, RandomForestRegressor)
    of = {"n_estimators": estimator.numTrees if forest else estimator.maxIter, "max_depth": estimator.maxDepth,
          "min_samples_leaf": estimator.minInstancesPerNode, "subsample": estimator.subsamplingRate,
          "max_features": estimator.featureSubsetStrategy}
    if not forest:
        of["learning_rate"] = estimator.stepSize
    whole = {None: 30, 1.0: "all"}
    return [{of[k]: whole.get(v, v) if k in ("max_depth", "max_features") else v for k, v in s.items()} for s in settings]


def grid(space: dict[str, list]) -> list[dict]:
    return [dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())]


# ---- Spark ML estimators -----------------------------------------------------------

MANY_VALUES = 2000      # values of a numeric feature that are counted one by one
PIECES = 1 << 17        # rows, beyond them pieces of cells, that a forest draws from (unless there are more cells)

def ols(features: str = "features", label: str = "target") -> LinearRegression:
    """Ordinary least squares (no penalty, exact normal equations)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal")


def ridge(alpha: float, n_rows: int, label_std: float, features: str = "features",
          label: str = "target") -> LinearRegression:
    """Ridge on standardised features as scikit-learn's Ridge(alpha) after a
    StandardScaler: Spark's objective scales the penalty by 1/n and the label std."""
    return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=0.0, standardization=True,
                            solver="normal", regParam=alpha * label_std / n_rows)


def lasso(alpha: float, features: str = "features", label: str = "target", max_iter: int = 200) -> LinearRegression:
    """Lasso on standardised features (scikit-learn alpha maps to regParam)."""
    return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=1.0, standardization=True,
                            regParam=alpha, maxIter=max_iter)


def random_forest(num_trees: int = 100, max_depth: int = 30, seed: int = 42, features: str = "features",
                  label: str = "target") -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                 seed=seed)


def boosted_trees(max_iter: int = 100, max_depth: int = 3, step: float = 0.1, subsample: float = 1.0,
                  min_leaf: int = 1, seed: int = 0, features: str = "features", label: str = "target") -> GBTRegressor:
    """n_estimators -> maxIter, learning_rate -> stepSize, subsample -> subsamplingRate,
    min_samples_leaf -> minInstancesPerNode (min_samples_split has no counterpart)."""
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                        subsamplingRate=subsample, minInstancesPerNode=min_leaf, seed=seed)


def _spread(rows: DataFrame) -> DataFrame:
    """The rows on as many partitions as there are cores, if they have fewer."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def split_points(counts: list[tuple[float, float]], bins: int) -> list[float]:
    """Spark ML's candidate splits of a numeric feature from its (value, rows): between all
    neighbours, or where the running count passes the next of ``bins`` equal shares."""
    counts = sorted(counts)
    if len(counts) <= bins:
        return [(a + b) / 2 for (a, _), (b, _) in itertools.pairwise(counts)]
    stride = sum(n for _, n in counts) / bins
    out, target, now = [], stride, counts[0][1]
    for (a, _), (b, n) in itertools.pairwise(counts):
        before, now = now, now + n
        if abs(before - target) < abs(now - target):
            out.append((a + b) / 2)
            target += stride
    return out


def _bucketizers(rows: DataFrame, numeric: list[str], bins: int) -> list[Bucketizer]:
    """Numeric columns to the number of their bin; the bins come from all rows: from the count
    of every value, beyond ``MANY_VALUES`` values from as many quantiles."""
    seen = rows.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(numeric)]).first()
    few = [i for i in range(len(numeric)) if seen[f"d{i}"] <= MANY_VALUES]
    many = [i for i in range(len(numeric)) if i not in few]
    counts: list[list[tuple[float, float]]] = [[] for _ in numeric]
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(numeric[i]).cast("double").alias("x")) for i in few]))
        for r in rows.select(pairs.alias("p")).groupBy("p.i", "p.x").count().collect():
            if r["x"] is not None and not math.isnan(r["x"]):
                counts[r["i"]].append((r["x"], r["count"]))
    if many:
        shares = F.array(*[F.lit((j + 0.5) / MANY_VALUES) for j in range(MANY_VALUES)])
        value = [F.col(numeric[i]).cast("double") for i in many]
        cuts = rows.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), shares, 10_000).alias(f"q{i}") for i, x in zip(many, value, strict=True)]).first()
        for i in many:
            values, times = np.unique(np.array(cuts[f"q{i}"]), return_counts=True)
            counts[i] = list(zip(values.tolist(), times.tolist(), strict=True))
    return [Bucketizer(inputCol=c, outputCol=f"_{c}_bin", handleInvalid="keep",
                       splits=[-math.inf, *(split_points(counts[i], bins) or [0.0]), math.inf]) for i, c in enumerate(numeric)]


def _fit_on_cells(rows: DataFrame, categorical: list[str], numeric: list[str], estimator, label: str) -> PipelineModel:
    """Trees need of the rows with the same categories and bins only how many there are
    and their mean label: the squared error around it is the same under every tree.  So the
    rows are read to bin and count them, and every round works on the cells, whose number is
    bounded by bins and categories.  The bins are the ones Spark ML splits between, and the
    model bins what it scores.

    The bootstrap of a forest draws what it is given, so there the rows of a cell are dealt into
    pieces by a hash of the label, as many as keep all pieces near ``PIECES``."""
    binners = _bucketizers(rows, numeric, estimator.getMaxBins())
    binned = [b.getOutputCol() for b in binners]
    # a computed column has no metadata: numbered bins are numbers to the trees, not categories;
    # a missing number stays an error
    numbers = [F.when(F.col(b.getOutputCol()) < len(b.getSplits()) - 1, F.col(b.getOutputCol())).alias(b.getOutputCol()) for b in binners]
    coded = PipelineModel(binners).transform(rows).select(*categorical, *numbers, label)
    keys = [*categorical, *binned]
    if isinstance(estimator, RandomForestRegressor):
        each = max(1, PIECES // max(1, coded.select(*keys).distinct().count()))
        keys, coded = [*keys, "_piece"], coded.withColumn("_piece", F.pmod(F.xxhash64(label), F.lit(each)))
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(label))       # a missing label stays an error
    cells = _spread(coded.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_rows"), mean.alias(label))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weighted = estimator.copy().setWeightCol("_rows")
        fitted = Pipeline(stages=ml_encoder(categorical, binned).getStages() + [weighted]).fit(cells)
        return PipelineModel(binners + fitted.stages)
    finally:
        cells.unpersist()


def fit(train: DataFrame, categorical: list[str], numeric: list[str], estimator) -> PipelineModel:
    """Encoder (learned on the training rows only) + estimator as one pipeline model.

    The training rows (only the columns the pipeline reads) are persisted while the stages make
    their passes over them; boosted trees without subsampling, and such forests on more than
    ``PIECES`` rows, pass over the rows' cells instead.  ``estimator`` may also be a function of the persisted rows (for
    settings that depend on label statistics), so that pass reads the cache too."""
    enc = ml_encoder(categorical, numeric)
    label = estimator.getLabelCol() if hasattr(estimator, "getLabelCol") else "target"
    cols = list(dict.fromkeys(list(categorical) + list(numeric) + [label]))
    cached = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        est = estimator if hasattr(estimator, "fit") else estimator(cached)
        trees = isinstance(est, GBTRegressor | RandomForestRegressor) and est.getSubsamplingRate() == 1.0 \
            and est.getMinInstancesPerNode() == 1 and est.getFeaturesCol() == "features" and not est.isSet(est.weightCol)
        if numeric and trees and (isinstance(est, GBTRegressor) or cached.count() > PIECES):
            return _fit_on_cells(cached, categorical, numeric, est, label)
        return Pipeline(stages=enc.getStages() + [est]).fit(cached)
    finally:
        cached.unpersist()


def _inputs(model: PipelineModel) -> list[str]:
    """The columns a pipeline model reads that none of its stages makes."""
    read, made = [], set()
    for stage in model.stages:
        for one, many, found in (("inputCol", "inputCols", read), ("outputCol", "outputCols", made)):
            names = stage.getOrDefault(many) if stage.hasParam(many) and stage.isSet(many) else \
                [stage.getOrDefault(one)] if stage.hasParam(one) and stage.isSet(one) else []
            if found is read:
                read += [c for c in names if c not in made and c not in read]
            else:
                made.update(names)
    return read


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with the model's ``prediction``.  A forest walks all its trees for a prediction, so
    it makes one for every combination of features and the rows look theirs up."""
    if not isinstance(model.stages[-1], RandomForestRegressionModel):
        return model.transform(df)
    inputs = _inputs(model)
    made = model.transform(df.select(*inputs).distinct()).select(*[F.col(c).alias(f"_in_{c}") for c in inputs], "prediction")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in inputs])
    return df.join(made, same).drop(*[f"_in_{c}" for c in inputs])


def evaluate(model: PipelineModel, df: DataFrame, by: list[str], label: str = "target") -> DataFrame:
    return regression_metrics(predict(model, df), label, "prediction", by)


def cross_validate(train: DataFrame, categorical: list[str], numeric: list[str], estimator, grid: list,
                   key: str, k: int = 3, parallelism: int = 4, seed: int = 7):
    """Exhaustive search over ``grid`` with k hash folds; score = mean MSE (lower is better).

    The encoder is fitted once on the training rows (it learns only the category
    vocabulary, no labels) and the encoded rows are persisted; only the regressor is
    refitted per fold and parameter map."""
    enc = ml_encoder(categorical, numeric).fit(train)
    data = enc.transform(train.withColumn("fold", fold_column(key, k, seed))).select(
        estimator.getFeaturesCol(), estimator.getLabelCol(), "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid,
                            evaluator=RegressionEvaluator(labelCol=estimator.getLabelCol(), metricName="mse"),
                            foldCol="fold", parallelism=parallelism)
        return cv.fit(data)
    finally:
        data.unpersist()


def score_batch(model: PipelineModel, requests: DataFrame, model_name: str, model_version: int,
                keep: list[str]) -> DataFrame:
    """Score a table of requests with a saved pipeline; tag the model name and version."""
    return model.transform(requests).select(*keep, "prediction", F.lit(model_name).alias("model_name"),
                                            F.lit(model_version).alias("model_version"))
