"""Tuning keys on the train split of ``v_model``.

Losses of fitted trees have no SQL; the keys return every setting with what SQL can state of
it: the folds and rows it was scored on, and that it beats predicting the mean.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tilth.operators import modeling as ML
from tilth.operators import tuning as TU
from tilth.plans.bindings import MODEL_CATEGORICAL, MODEL_NUMERIC
from tilth.plans.catalog import query
from tilth.plans.q_model import _BASE, _split, _train
from tilth.session import scratch_path

_K = 3
_BINS = 4                # of the grids; the model-based search splits between all values
_TRIALS = 20


def _cells(spark, d, bins=_BINS):
    return TU.tree_cells(_train(spark, d), MODEL_CATEGORICAL, MODEL_NUMERIC, "row_key", k=_K, bins=bins)


def _values(name: str, values) -> str:
    return f"(VALUES {', '.join(f'({v})' for v in values)}) {name}({name})"


def _checked(cells, trials, columns):
    """The settings with what is known of their scoring."""
    n_rows, baseline = int(cells["n"].sum()), TU.mean_baseline(cells)
    has_best = trials.where("best").count() >= 1
    return trials.select(*columns, F.col("folds").cast("long").alias("folds"), F.lit(n_rows).cast("long").alias("n_rows"),
                         (F.col("cv_mse") < baseline).alias("beats_mean"), F.lit(has_best).alias("has_best"))


@query("grid_search_forest", _BASE + f"""
SELECT n_estimators, max_depth, min_samples_leaf, max_features, {_K}::BIGINT AS folds, (SELECT count(*) FROM tr) AS n_rows,
       true AS beats_mean, true AS has_best
FROM {_values('n_estimators', ML.FOREST_GRID['n_estimators'])},
     {_values('max_depth', ['NULL' if v is None else v for v in ML.FOREST_GRID['max_depth']])},
     {_values('min_samples_leaf', ML.FOREST_GRID['min_samples_leaf'])},
     {_values('max_features', [f"'{v}'" for v in ML.FOREST_GRID['max_features']])}""")
def grid_search_forest(spark, d):
    cells = _cells(spark, d)
    return _checked(cells, TU.search_forest(spark, cells, ML.FOREST_GRID),
                    ["n_estimators", "max_depth", "min_samples_leaf", "max_features"])


@query("grid_search_boosted", _BASE + f"""
SELECT n_estimators, max_depth, learning_rate, {_K}::BIGINT AS folds, (SELECT count(*) FROM tr) AS n_rows,
       true AS beats_mean, true AS has_best
FROM {_values('n_estimators', ML.BOOSTED_GRID['n_estimators'])}, {_values('max_depth', ML.BOOSTED_GRID['max_depth'])},
     {_values('learning_rate', [f'{v}::DOUBLE' for v in ML.BOOSTED_GRID['learning_rate']])}""")
def grid_search_boosted(spark, d):
    cells = _cells(spark, d)
    return _checked(cells, TU.search_boosted(spark, cells, ML.BOOSTED_GRID), ["n_estimators", "max_depth", "learning_rate"])


def _linear_folds(train, split):
    """Moments of the train folds and of the validation and test rows (folds ``_K`` and
    ``_K`` + 1), all from one pass; the encoder is learned on the train rows."""
    enc = ML.ml_encoder(MODEL_CATEGORICAL, MODEL_NUMERIC).fit(train)
    part = F.when(F.col("split") == "train", ML.fold_column("row_key", _K)).when(F.col("split") == "val", _K).otherwise(_K + 1)
    return ML.fold_moments(enc.transform(split.withColumn("fold", part)))


def _linear_search(folds, kind):
    """Model-based search of alpha; every loss comes from the moments of the folds."""
    whole = ML.merge(list(folds.values()))

    def loss(setting):
        return float(np.mean([ML.mse_of(f, *ML.solve_linear(whole - f, setting["alpha"], kind)) for f in folds.values()]))
    zero = np.zeros(len(whole.mean) - 1)
    baseline = float(np.mean([ML.mse_of(f, zero, (whole - f).mean[-1]) for f in folds.values()]))
    return TU.model_search(TU.LINEAR_SPACE, loss, _TRIALS), TU.LINEAR_SPACE, baseline


@query("model_search_checks", _BASE + f"""
SELECT model, {_TRIALS}::BIGINT AS n_trials, {_TRIALS}::BIGINT AS n_inside, (SELECT count(*) FROM tr) AS n_rows,
       (SELECT count(*) FROM v_split WHERE split <> 'test') AS n_refit, (SELECT count(*) FROM v_split WHERE split = 'test') AS n_test,
       true AS beats_mean, true AS refit_beats_mean
FROM (VALUES ('ridge'), ('lasso'), ('boosted')) t(model)""")
def model_search_checks(spark, d):
    """Twenty trials of each model (boosted trees: ten, stored, read again and ten more), and the
    winner fitted again on train and validation rows and scored on the test rows."""
    split = _split(spark, d)
    train = split.where(F.col("split") == "train")
    is_test = (F.col("split") == "test").cast("int")
    out = []
    moments = _linear_folds(train, split)
    folds = {f: m for f, m in moments.items() if f < _K}
    seen, test = ML.merge([m for f, m in sorted(moments.items()) if f <= _K]), moments[_K + 1]
    for kind in ("ridge", "lasso"):
        trials, space, baseline = _linear_search(folds, kind)
        best = min(trials, key=lambda t: t[1])
        refit = ML.mse_of(test, *ML.solve_linear(seen, best[0]["alpha"], kind))
        mean = ML.mse_of(test, np.zeros(len(seen.mean) - 1), seen.mean[-1])
        out.append((kind, len(trials), sum(TU.inside(space, t[0]) for t in trials), int(seen.n), int(test.n),
                    best[1] < baseline, refit < mean))
    cells = _cells(spark, d, bins=None)
    loss = TU.boosted_loss(spark, cells)
    path = scratch_path(spark, "trials")
    TU.save_trials(spark, TU.model_search(ML.BOOSTED_SPACE, loss, _TRIALS // 2), path)
    trials = TU.model_search(ML.BOOSTED_SPACE, loss, _TRIALS - _TRIALS // 2, history=TU.load_trials(spark, path))
    best = min(trials, key=lambda t: t[1])
    both = TU.tree_cells(split, MODEL_CATEGORICAL, MODEL_NUMERIC, "row_key", bins=None, fold=is_test)
    refit, mean = TU.refit_loss(spark, both, best[0]), TU.held_out_baseline(both, 1)
    held = both["fold"] == 1
    out.append(("boosted", len(trials), sum(TU.inside(ML.BOOSTED_SPACE, t[0]) for t in trials), int(both["n"][~held].sum()),
                int(both["n"][held].sum()), best[1] < TU.mean_baseline(cells), refit < mean))
    n_rows = int(cells["n"].sum())
    return spark.createDataFrame([(m, t, i, n_rows, a, b, bool(x), bool(y)) for m, t, i, a, b, x, y in out],
                                 "model string, n_trials long, n_inside long, n_rows long, n_refit long, n_test long, "
                                 "beats_mean boolean, refit_beats_mean boolean")
