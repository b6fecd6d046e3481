"""Modelling keys on the ``v_model`` table split 60/20/20 by key hash.

Closed-form keys (one-feature least squares, its k-fold loss, metrics, the
leaderboard of baselines, the run summary) are aggregates with SQL oracles;
Spark ML fits and searches are row-checked and unit-tested for properties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import encode as E
from tilth.operators import modeling as ML
from tilth.operators.common import with_scalars
from tilth.plans.bindings import MODEL_CATEGORICAL, MODEL_NUMERIC, V_MODEL, v_model, with_ctes
from tilth.plans.catalog import query, rounded
from tilth.plans.q_encode import V_SPLIT, _vocab_sql
from tilth.session import scratch_path

_FOLD_SQL = "CAST(floor(CAST(('0x' || substr(md5('7:' || row_key), 1, 8)) AS BIGINT) / 4294967296.0 * {k}) AS INTEGER)"
_MET = {"rmse": 4, "r2": 6, "mae": 4, "mean_error": 4}


def _split(spark, d):
    return E.split(v_model(spark, d), "row_key")


def _train(spark, d):
    return _split(spark, d).where(F.col("split") == "train")


def _label_stats(df):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("target").alias("sd")).first()
    return r["n"], r["sd"]


def _fit_report(spark, d, make_estimator, name):
    s = _split(spark, d)
    train = s.where(F.col("split") == "train")
    model = ML.fit(train, MODEL_CATEGORICAL, MODEL_NUMERIC, make_estimator)
    return rounded(ML.evaluate(model, s, ["split"]).withColumn("model", F.lit(name)), _MET)


_BASE = with_ctes(V_MODEL, V_SPLIT) + """,
tr AS (SELECT * FROM v_split WHERE split = 'train'),
ols AS (SELECT regr_slope(target, l_quantity) AS b, regr_intercept(target, l_quantity) AS a,
               regr_r2(target, l_quantity) AS r2, count(*) AS n FROM tr),
scored AS (SELECT s.split, s.target, ols.a + ols.b * s.l_quantity AS prediction FROM v_split s, ols)"""


@query("ols_fit", _BASE + """
SELECT round(b, 6) AS slope, round(a, 6) AS intercept, round(r2, 6) AS r2, n FROM ols""")
def ols_fit(spark, d):
    return rounded(ML.simple_ols(_train(spark, d), "l_quantity", "target"), {"slope": 6, "intercept": 6, "r2": 6})


@query("ols_multi_fit")
def ols_multi_fit(spark, d):
    return _fit_report(spark, d, lambda t: ML.ols(), "ols")


def _linear_fit(spark, d, kind, alpha):
    """One-pass solution on the train rows: (encoded rows of all splits, moments, weights, intercept)."""
    split = _split(spark, d)
    train = split.where(F.col("split") == "train")
    enc = ML.ml_encoder(MODEL_CATEGORICAL, MODEL_NUMERIC).fit(train)
    rows = enc.transform(split)
    m = ML.fold_moments(rows.where(F.col("split") == "train").withColumn("fold", F.lit(0)))[0]
    return rows, m, *ML.solve_linear(m, alpha, kind)


def _linear_report(spark, d, kind, alpha, name):
    rows, _, w, b = _linear_fit(spark, d, kind, alpha)
    scored = rows.withColumn("prediction", ML.linear_prediction("features", w, b))
    return rounded(ML.regression_metrics(scored, "target", "prediction", ["split"]).withColumn("model", F.lit(name)), _MET)


@query("ridge_fit")
def ridge_fit(spark, d):
    return _linear_report(spark, d, "ridge", 1.0, "ridge")


@query("lasso_fit")
def lasso_fit(spark, d):
    return _linear_report(spark, d, "lasso", 1.0, "lasso")


@query("linear_fit_checks", _BASE + """
SELECT model, (SELECT count(*) FROM tr) AS n_rows, 0.0 AS violation, true AS beats_mean, true AS agrees
FROM (VALUES ('ridge'), ('lasso')) t(model)""")
def linear_fit_checks(spark, d):
    """Both linear models meet the gradient conditions of their objectives, beat the mean on the
    test rows, and Spark ML's fit of the same objective predicts the same there."""
    out = []
    for kind in ("ridge", "lasso"):
        rows, m, w, b = _linear_fit(spark, d, kind, 1.0)
        train = _train(spark, d)
        model = ML.fit(train, MODEL_CATEGORICAL, MODEL_NUMERIC,
                       (lambda t: ML.ridge(1.0, *_label_stats(t))) if kind == "ridge" else ML.lasso(1.0))
        test = rows.where(F.col("split") == "test").withColumn("ours", ML.linear_prediction("features", w, b))
        theirs = model.stages[-1].transform(test)
        r = theirs.agg(F.max(F.abs(F.col("ours") - F.col("prediction"))).alias("gap"), F.stddev_pop("target").alias("sd"),
                       F.avg(F.pow(F.col("ours") - F.col("target"), 2)).alias("mse"),
                       F.avg(F.pow(F.lit(float(m.mean[-1])) - F.col("target"), 2)).alias("mean_mse")).first()
        out.append((kind, int(m.n), round(ML.stationarity(m, 1.0, w, kind), 6) + 0.0, r["mse"] < r["mean_mse"], r["gap"] < 0.01 * r["sd"]))
    return spark.createDataFrame(out, "model string, n_rows long, violation double, beats_mean boolean, agrees boolean")


@query("batch_score_checks", _BASE + """
SELECT (SELECT count(*) FROM v_split WHERE split = 'test') AS n_rows, 0.0 AS largest_gap, 'ridge' AS model_name, 1 AS model_version""")
def batch_score_checks(spark, d):
    """A saved and reloaded pipeline scores the test rows as intercept plus features times weights."""
    s = _split(spark, d)
    model = ML.fit(s.where(F.col("split") == "train"), MODEL_CATEGORICAL, MODEL_NUMERIC, lambda t: ML.ridge(1.0, *_label_stats(t)))
    path = scratch_path(spark, "ridge-check")
    from tilth.sources.files import load_pipeline_model, save_model
    save_model(model, path)
    loaded = load_pipeline_model(path)
    by_hand = ML.linear_prediction("features", loaded.stages[-1].coefficients.toArray(), loaded.stages[-1].intercept)
    scored = ML.score_batch(loaded, s.where(F.col("split") == "test"), "ridge", 1, ["features"]).withColumn("gap", F.abs(by_hand - F.col("prediction")))
    return rounded(scored.groupBy("model_name", "model_version").agg(F.count(F.lit(1)).alias("n_rows"), F.max("gap").alias("largest_gap")),
                   {"largest_gap": 6})


@query("tree_fit_checks", _BASE + """
SELECT model, (SELECT count(*) FROM v_split WHERE split = 'test') AS n_test, true AS beats_mean, 1.0 AS importance_sum, trees AS n_trees
FROM (VALUES ('forest', 20), ('boosted', 20)) t(model, trees)""")
def tree_fit_checks(spark, d):
    """Spark ML's tree models beat the mean on the test rows and their importances sum to one."""
    s = _split(spark, d)
    train, out = s.where(F.col("split") == "train"), []
    for name, estimator in (("forest", ML.random_forest(num_trees=20, max_depth=8)), ("boosted", ML.boosted_trees(max_iter=20))):
        model = ML.fit(train, MODEL_CATEGORICAL, MODEL_NUMERIC, estimator)
        scored = ML.predict(model, s.where(F.col("split") == "test"))
        mean = train.agg(F.avg("target")).first()[0]
        r = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.pow(F.col("prediction") - F.col("target"), 2)).alias("mse"),
                       F.avg(F.pow(F.lit(mean) - F.col("target"), 2)).alias("mean_mse")).first()
        fitted = model.stages[-1]
        out.append((name, r["n"], r["mse"] < r["mean_mse"], round(float(fitted.featureImportances.toArray().sum()), 6), fitted.getNumTrees))
    return spark.createDataFrame(out, "model string, n_test long, beats_mean boolean, importance_sum double, n_trees int")


@query("rf_fit")
def rf_fit(spark, d):
    return _fit_report(spark, d, lambda t: ML.random_forest(num_trees=100, max_depth=12, seed=42), "random_forest")


@query("gbt_fit")
def gbt_fit(spark, d):
    return _fit_report(spark, d, lambda t: ML.boosted_trees(max_iter=100, max_depth=3, seed=0), "boosted_trees")


_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]


def _search(spark, d, kind, alphas):
    return ML.search_linear(_train(spark, d), MODEL_CATEGORICAL, MODEL_NUMERIC, alphas, "row_key", kind)


def _with_best(trials):
    best = trials.agg(F.min("cv_mse").alias("_best"))
    return with_scalars(trials, best).withColumn("best", F.col("cv_mse") == F.col("_best")).drop("_best")


@query("grid_search_ridge")
def grid_search_ridge(spark, d):
    return _with_best(_search(spark, d, "ridge", _ALPHAS)[0])


@query("grid_search_lasso")
def grid_search_lasso(spark, d):
    return _with_best(_search(spark, d, "lasso", _ALPHAS)[0])


@query("random_search")
def random_search(spark, d):
    return _search(spark, d, "ridge", ML.draw_alphas(20))[0]


@query("random_search_lasso")
def random_search_lasso(spark, d):
    return _search(spark, d, "lasso", ML.draw_alphas(20))[0]


@query("search_checks", _BASE + """,
f AS (SELECT """ + _FOLD_SQL.format(k=5) + """ AS fold FROM tr)
SELECT kind, trials AS n_trials, (SELECT count(*) FROM f) AS n_rows, (SELECT count(DISTINCT fold) FROM f) AS folds,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM f GROUP BY fold)) AS largest_fold, true AS beats_mean
FROM (VALUES ('ridge', 5), ('lasso', 5)) t(kind, trials)""")
def search_checks(spark, d):
    """What SQL can state about the searches: folds, their sizes, and that the best alpha
    beats predicting the mean."""
    import numpy as np
    rows = []
    for kind in ("ridge", "lasso"):
        trials, folds = _search(spark, d, kind, _ALPHAS)
        whole = ML.merge(list(folds.values()))
        mean_mse = float(np.mean([ML.mse_of(f, np.zeros(len(f.mean) - 1), (whole - f).mean[-1]) for f in folds.values()]))
        best = trials.agg(F.min("cv_mse")).first()[0]
        rows.append((kind, trials.count(), int(whole.n), len(folds), int(max(f.n for f in folds.values())), best < mean_mse))
    return spark.createDataFrame(rows, "kind string, n_trials int, n_rows long, folds long, largest_fold long, beats_mean boolean")


@query("ols_normal_equations", _BASE + """
SELECT 'intercept' AS feature, 0.0 AS residual UNION ALL SELECT unnest(['l_quantity', 'l_discount', 'l_tax']), 0.0""")
def ols_normal_equations(spark, d):
    """Least squares by Spark ML leaves residuals without correlation to any feature."""
    train = _train(spark, d)
    model = ML.fit(train, MODEL_CATEGORICAL, MODEL_NUMERIC, ML.ols())
    e = model.transform(train).withColumn("e", F.col("target") - F.col("prediction"))
    sums = e.agg((F.avg("e") / F.stddev_pop("target")).alias("intercept"),
                 *[F.corr("e", c).alias(c) for c in MODEL_NUMERIC])
    out = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("residual"))
                                          for c in ["intercept", *MODEL_NUMERIC]])).alias("r")).select("r.*")
    return rounded(out, {"residual": 6})


@query("refit_best")
def refit_best(spark, d):
    trials, _ = _search(spark, d, "ridge", _ALPHAS)
    best_alpha = trials.orderBy("cv_mse").first()["alpha"]
    s = _split(spark, d)
    train_val = s.where(F.col("split").isin("train", "val"))
    model = ML.fit(train_val, MODEL_CATEGORICAL, MODEL_NUMERIC,
                   lambda t: ML.ridge(best_alpha, *_label_stats(t)))
    out = ML.evaluate(model, s.where(F.col("split") == "test"), ["split"])
    return rounded(out.withColumn("alpha", F.lit(best_alpha)), _MET)


def _cv_sql(feature: str, k: int = 5) -> str:
    return f"""(WITH d AS (SELECT {_FOLD_SQL.format(k=k)} AS fold, {feature} AS x, target AS y FROM tr),
s AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy
      FROM d GROUP BY fold),
t AS (SELECT fold, sum(n) OVER () - n AS n, sum(sx) OVER () - sx AS sx, sum(sy) OVER () - sy AS sy,
             sum(sxx) OVER () - sxx AS sxx, sum(sxy) OVER () - sxy AS sxy FROM s),
c AS (SELECT fold, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b, sx, sy, n FROM t),
c2 AS (SELECT fold, b, (sy - b * sx) / n AS a FROM c),
e AS (SELECT d.fold, avg((y - a - b * x) ^ 2) AS mse FROM d JOIN c2 USING (fold) GROUP BY 1)
SELECT '{feature}' AS trial, avg(mse) AS cv_mse, count(*) AS folds FROM e)"""


def _cv_spark(spark, d, features, k=5):
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("trial"), F.col(f).alias("x")) for f in features])).alias("p")
    long = _train(spark, d).select("row_key", "target", pairs).select("row_key", "target", "p.trial", "p.x")
    return ML.cv_loss(ML.kfold_simple_ols(long, "x", "target", "row_key", k=k, seed=7, by=["trial"]), ["trial"])


@query("cv_loss", _BASE + "\nSELECT round(cv_mse, 2) AS cv_mse, folds FROM " + _cv_sql("l_quantity"))
def cv_loss(spark, d):
    return rounded(_cv_spark(spark, d, ["l_quantity"]).select("cv_mse", "folds"), {"cv_mse": 2})


@query("trial_summary", _BASE + ",\ntrials AS (" + " UNION ALL ".join(
    f"SELECT * FROM {_cv_sql(f)}" for f in MODEL_NUMERIC) + """)
SELECT count(*) AS n_trials, round(min(cv_mse), 2) AS best_loss, arg_min(trial, cv_mse) AS best_trial,
       round(avg(cv_mse), 2) AS mean_loss, round(stddev_pop(cv_mse), 2) AS std_loss FROM trials""")
def trial_summary(spark, d):
    return rounded(ML.trial_summary(_cv_spark(spark, d, MODEL_NUMERIC)), {"best_loss": 2, "mean_loss": 2, "std_loss": 2})


def _ols_scored(spark, d):
    s = _split(spark, d)
    coef = ML.simple_ols(s.where(F.col("split") == "train"), "l_quantity", "target")
    return with_scalars(s, coef.select("slope", "intercept")).withColumn(
        "prediction", F.col("intercept") + F.col("slope") * F.col("l_quantity"))


@query("regression_metrics", _BASE + """
SELECT split, count(*) AS n, round(sqrt(sum((prediction - target) ^ 2) / count(*)), 4) AS rmse,
       round(1 - sum((prediction - target) ^ 2) / (var_pop(target) * count(*)), 6) AS r2,
       round(avg(abs(prediction - target)), 4) AS mae, round(avg(prediction - target), 4) + 0.0 AS mean_error
FROM scored GROUP BY split""")
def regression_metrics(spark, d):
    return rounded(ML.regression_metrics(_ols_scored(spark, d), "target", "prediction", ["split"]), _MET)


@query("leaderboard", _BASE + """,
te AS (SELECT target, l_quantity, l_discount, l_returnflag FROM v_split WHERE split = 'test'),
o2 AS (SELECT regr_slope(target, l_discount) AS b, regr_intercept(target, l_discount) AS a FROM tr),
gm AS (SELECT l_returnflag, avg(target) AS p FROM tr GROUP BY 1),
mu AS (SELECT avg(target) AS p FROM tr),
preds AS (SELECT 'mean' AS model, te.target, mu.p AS prediction FROM te, mu
          UNION ALL SELECT 'ols_l_quantity', te.target, ols.a + ols.b * te.l_quantity FROM te, ols
          UNION ALL SELECT 'ols_l_discount', te.target, o2.a + o2.b * te.l_discount FROM te, o2
          UNION ALL SELECT 'group_mean_l_returnflag', te.target, coalesce(gm.p, mu.p)
                    FROM te LEFT JOIN gm USING (l_returnflag), mu)
SELECT model, count(*) AS n, round(sqrt(sum((prediction - target) ^ 2) / count(*)), 4) AS rmse,
       round(1 - sum((prediction - target) ^ 2) / (var_pop(target) * count(*)), 6) AS r2,
       round(avg(abs(prediction - target)), 4) AS mae, round(avg(prediction - target), 4) + 0.0 AS mean_error
FROM preds GROUP BY model""")
def leaderboard(spark, d):
    s = _split(spark, d)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test").select("target", "l_quantity", "l_discount", "l_returnflag")
    features = ["l_quantity", "l_discount"]
    fitted = train.agg(F.avg("target").alias("p"), *[f(F.col("target"), F.col(c)).alias(f"{n}_{c}") for c in features
                                                     for n, f in (("b", F.regr_slope), ("a", F.regr_intercept))])
    by_flag = train.groupBy("l_returnflag").agg(F.avg("target").alias("_gp"))
    rows = with_scalars(test.join(by_flag, "l_returnflag", "left"), fitted)
    made = {"mean": F.col("p"), "group_mean_l_returnflag": F.coalesce(F.col("_gp"), F.col("p"))} | {
        f"ols_{c}": F.col(f"a_{c}") + F.col(f"b_{c}") * F.col(c) for c in features}
    # every model's prediction of a row side by side, then one row for each
    long = rows.select("target", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), p.alias("prediction")) for m, p in made.items()])).alias("m")).select("target", "m.*")
    return rounded(ML.leaderboard(long), _MET)


@query("batch_score")
def batch_score(spark, d):
    s = _split(spark, d)
    train = s.where(F.col("split") == "train")
    model = ML.fit(train, MODEL_CATEGORICAL, MODEL_NUMERIC, lambda t: ML.ridge(1.0, *_label_stats(t)))
    path = scratch_path(spark, "ridge-model")
    from tilth.sources.files import load_pipeline_model, save_model
    save_model(model, path)
    loaded = load_pipeline_model(path)
    return ML.score_batch(loaded, s.where(F.col("split") == "test"), "ridge", 1, ["row_key"])


@query("run_summary", _BASE + f""",
va AS (SELECT * FROM scored WHERE split = 'val')
SELECT 'ols_l_quantity' AS model_name,
       (SELECT count(*) FROM {_vocab_sql('v_model', MODEL_CATEGORICAL, MODEL_NUMERIC)}) AS n_features,
       (SELECT count(*) FROM v_split WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM v_split WHERE split = 'val') AS n_val,
       round(sqrt(sum((prediction - target) ^ 2) / count(*)), 4) AS val_rmse,
       round(1 - sum((prediction - target) ^ 2) / (var_pop(target) * count(*)), 6) AS val_r2,
       (SELECT round(b, 6) FROM ols) AS param_slope, (SELECT round(a, 6) FROM ols) AS param_intercept
FROM va""")
def run_summary(spark, d):
    s = _split(spark, d)
    n_features = E.vocabulary(v_model(spark, d), MODEL_CATEGORICAL, MODEL_NUMERIC).count()
    scored = _ols_scored(spark, d)
    val = ML.regression_metrics(scored.where(F.col("split") == "val"), "target", "prediction", [])
    counts = s.agg(F.count_if(F.col("split") == "train").alias("n_train"),
                   F.count_if(F.col("split") == "val").alias("n_val"))
    train = s.where(F.col("split") == "train")
    coef = ML.simple_ols(train, "l_quantity", "target").select(F.col("slope").alias("param_slope"),
                                                               F.col("intercept").alias("param_intercept"))
    row = with_scalars(with_scalars(counts, val.select(F.col("rmse").alias("val_rmse"), F.col("r2").alias("val_r2"))),
                       coef)
    out = row.select(F.lit("ols_l_quantity").alias("model_name"), F.lit(n_features).cast("long").alias("n_features"),
                     "n_train", "n_val", "val_rmse", "val_r2", "param_slope", "param_intercept")
    return rounded(out, {"val_rmse": 4, "val_r2": 6, "param_slope": 6, "param_intercept": 6})
