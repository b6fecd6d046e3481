"""Model mappings, persistence, drift intent and hypothesis tests on small fixtures."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.operators import htest as H
from tilth.operators import modeling as ML
from tilth.operators import monitor as M


def test_ridge_mapping_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.3]
    y = X @ [2.0, -1.0, 4.0] + rng.normal(size=300)
    alpha = 10.0
    Z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Z.T @ Z + alpha * np.eye(3), Z.T @ (y - y.mean()))
    closed = Z @ w + y.mean()
    rows = [tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, target double")
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = ML.ridge(alpha, 300, float(np.std(y))).fit(data)
    pred = np.array([r["prediction"] for r in model.transform(data).collect()])
    assert np.allclose(pred, closed, atol=1e-6)


def test_model_save_load_same_predictions(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 2.0, 21.0), ("a", 3.0, 29.0), ("b", 4.0, 41.0)],
                               "c string, x double, target double")
    model = ML.fit(df, ["c"], ["x"], ML.ols())
    path = os.path.join(tmp_dir, "m")
    from tilth.sources.files import load_pipeline_model, save_model
    save_model(model, path)
    a = [r["prediction"] for r in model.transform(df).orderBy("x").collect()]
    b = [r["prediction"] for r in load_pipeline_model(path).transform(df).orderBy("x").collect()]
    assert a == b


def test_drift_intent_same_vs_shifted(spark):
    rng = np.random.default_rng(3)
    ref = [(float(v),) for v in rng.normal(0, 1, 400)]
    same = [(float(v),) for v in rng.normal(0, 1, 400)]
    moved = [(float(v),) for v in rng.normal(100, 1, 400)]
    r = spark.createDataFrame(ref, "x double")
    rules = M.DriftRules(numeric_method="ks")
    no = M.column_drift(M.tag(r, spark.createDataFrame(same, "x double")), ["x"], [], rules=rules).first()
    yes = M.column_drift(M.tag(r, spark.createDataFrame(moved, "x double")), ["x"], [], rules=rules).first()
    assert no["test"] == "ks" and not no["drifted"]
    assert yes["drifted"] and yes["p_value"] < 1e-6


@pytest.mark.parametrize("method", ["ks", "wasserstein", "chi2", "jensen_shannon", "proportion"])
def test_identical_and_missing_sides(spark, method):
    """Published intent of the drift checks: data against themselves never drift."""
    r = spark.createDataFrame([(float(v % 2),) for v in range(50)], "x double")
    same = M.column_drift(M.tag(r, r), ["x"], [], methods={"x": method}).first()
    assert same["statistic"] == pytest.approx(0.0) and not same["drifted"]
    assert same["p_value"] in (None, 1.0)
    for only in (M.tag(r, None), M.tag(r.limit(0), r)):
        row = M.column_drift(only, ["x"], [], methods={"x": method}).first()
        assert row["statistic"] is None and row["drifted"] is False


def test_no_columns_no_drift(spark):
    r = spark.createDataFrame([(1.0,)], "x double")
    out = M.dataset_drift(M.column_drift(M.tag(r, r), [], [])).first()
    assert (out["n_columns"], out["share"], out["dataset_drift"]) == (0, None, False)


def test_counts_beyond_the_square_root_of_a_long(spark, monkeypatch):
    """Billions of rows a side: products of counts must not overflow."""
    big = 4_000_000_000
    counts = spark.createDataFrame([("x", "a", big, big), ("x", "b", big, big)],
                                   "column string, value string, n_ref long, n_cur long")
    monkeypatch.setattr(M, "_side_counts", lambda long: counts)
    df = spark.createDataFrame([("a", "reference")], "x string, dataset string")
    for test in (M.chi2_test, M.jensen_shannon, M.proportion_test):
        assert test(df, ["x"]).first()["statistic"] == pytest.approx(0.0)
    numeric = counts.withColumn("value", F.when(F.col("value") == "a", 1.0).otherwise(2.0))
    monkeypatch.setattr(M, "_side_counts", lambda long: numeric)
    row = M.ks_test(df.withColumn("x", F.lit(1.0)), ["x"]).first()
    assert row["statistic"] == 0.0 and row["p_value"] == 1.0


def test_performance_on_a_shifted_target(spark):
    """R2 does not change when target and prediction move by the same large amount."""
    rows = [(float(i % 7), float(i % 7) + (i % 3) * 0.1) for i in range(200)]
    df = spark.createDataFrame(rows, "y double, p double").withColumn("dataset", F.lit("reference"))
    near = M.performance(df, "y", "p").first()["r2"]
    far = M.performance(df.select((F.col("y") + 1e9).alias("y"), (F.col("p") + 1e9).alias("p"), "dataset"), "y", "p").first()["r2"]
    assert far == pytest.approx(near, abs=1e-5)


def test_reference_only_report(spark):
    r = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0)], "y double, p double")
    out = M.performance(M.tag(r, None), "y", "p").collect()
    assert [row["dataset"] for row in out] == ["reference"]
    meta = M.report_metadata(M.tag(r, None), 1, generated_at="t").first()
    assert meta["analysis_type"] == "reference_only"


def test_small_group_tests_against_known_values(spark):
    # textbook example: three groups, computed by hand
    rows = [("a", v) for v in [1.0, 2.0, 3.0]] + [("b", v) for v in [4.0, 5.0, 6.0]] + \
           [("c", v) for v in [7.0, 8.0, 9.0]]
    df = spark.createDataFrame(rows, "g string, v double")
    a = H.anova(df, [], "g", "v").first()
    assert a["f"] == pytest.approx(27.0)          # SSB = 54 / 2, SSW = 6 / 6
    k = H.kruskal(df, [], "g", "v").first()
    assert k["h"] == pytest.approx(7.2)           # 12/(9*10) * (36+225+576)/3 - 30
    assert k["p_value"] == pytest.approx(np.exp(-3.6))
    t = H.ttest_pooled(df, [], "g", "v", "a", "b").first()
    assert t["t"] == pytest.approx(-3 / np.sqrt(2 / 3)) and t["df"] == 4
    jb = H.jarque_bera(df.where(F.col("g") == "a"), [], "v").first()
    assert jb["skew"] == pytest.approx(0.0)


def test_mann_whitney_small(spark):
    rows = [("x", v) for v in [1.0, 2.0, 3.0, 4.0]] + [("y", v) for v in [3.0, 5.0, 6.0, 7.0]]
    mw = H.mann_whitney(spark.createDataFrame(rows, "g string, v double"), [], "g", "v", "x", "y").first()
    # ranks of x: 1, 2, 3.5, 5 -> R1 = 11.5, U1 = 11.5 - 10 = 1.5
    assert mw["u"] == pytest.approx(1.5)
    assert 0 < mw["p_value"] < 0.1


def test_metric_trend_matches_lag_per_series(spark):
    import pandas as pd

    from tilth.operators import monitor as MON
    rng = np.random.default_rng(3)
    # series 'hot' has most runs; times unique per series, shuffled on input
    rows = [("hot", t) for t in range(400)] + [(p, t) for p in ("a", "b") for t in range(0, 60, 3)]
    pdf = pd.DataFrame(rows, columns=["project", "t"]).sample(frac=1, random_state=1)
    pdf["rmse"] = rng.random(len(pdf))
    got = MON.metric_trend(spark.createDataFrame(pdf), "t", ["rmse"], by=["project"]).toPandas()
    exp = pdf.sort_values(["project", "t"])
    exp = exp.assign(rmse_change=exp["rmse"] - exp.groupby("project")["rmse"].shift(1))
    m = got.merge(exp, on=["project", "t"], suffixes=("", "_e"))
    assert len(m) == len(pdf) == len(got)
    assert np.allclose(m["rmse_change"].fillna(-9.0), m["rmse_change_e"].fillna(-9.0))


def test_one_pass_linear_search_matches_refits(spark):
    """Every fold and alpha solved from moments equals fitting on the rows."""
    rng = np.random.default_rng(7)
    X = rng.normal(size=(240, 3)) * [1.0, 20.0, 0.2] + [1e6, 0.0, 5.0]
    y = X @ [3.0, -0.5, 8.0] + rng.normal(size=240) + 1e7
    rows = [(f"k{i}", "ab"[i % 2], *map(float, X[i]), float(y[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "key string, c string, x0 double, x1 double, x2 double, target double")
    cols = ["x0", "x1", "x2"]
    for kind in ("ridge", "lasso"):
        trials, _ = ML.search_linear(df, ["c"], cols, [0.1, 10.0], "key", kind)
        fold = {r["key"]: r["fold"] for r in df.select("key", ML.fold_column("key", 5)).collect()}
        f = np.array([fold[r[0]] for r in rows])
        Z = np.hstack([np.array([[r[1] == "a", r[1] == "b"] for r in rows], float), X])
        for row in trials.collect():
            errs = []
            for i in sorted(set(f)):
                tr, te = f != i, f == i
                mu, sd = Z[tr].mean(0), Z[tr].std(0)
                A, b = (Z[tr] - mu) / sd, y[tr] - y[tr].mean()
                if kind == "ridge":
                    w = np.linalg.solve(A.T @ A + row["alpha"] * np.eye(5), A.T @ b)
                else:
                    w = np.zeros(5)
                    for _ in range(4000):
                        for j in range(5):
                            r = A[:, j] @ (b - A @ w + A[:, j] * w[j]) / len(b)
                            w[j] = np.sign(r) * max(0, abs(r) - row["alpha"])
                errs.append(((y[te] - y[tr].mean() - (Z[te] - mu) / sd @ w) ** 2).mean())
            assert row["cv_mse"] == pytest.approx(np.mean(errs), rel=1e-4), kind


def test_tree_search_space_and_maps(spark):
    draws = ML.draw(ML.BOOSTED_SPACE, 20)
    assert len(draws) == 20 and all(50 <= d["n_estimators"] <= 500 and d["n_estimators"] % 10 == 0 for d in draws)
    assert all(0.01 <= d["learning_rate"] <= 0.3 and 0.5 <= d["subsample"] <= 1 for d in draws)
    assert len(ML.grid(ML.FOREST_GRID)) == 5 * 4 * 3 * 3 and len(ML.grid(ML.BOOSTED_GRID)) == 125
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", "ab"[i % 2], float(x), float(3 * x + rng.normal())) for i, x in enumerate(rng.normal(size=120))]
    df = spark.createDataFrame(rows, "key string, c string, x double, target double")
    for est, space in ((ML.random_forest(), {"n_estimators": [3], "max_depth": [2, None], "max_features": [1.0]}),
                       (ML.boosted_trees(), {"n_estimators": [2], "learning_rate": [0.1, 0.5], "max_depth": [2]})):
        cv = ML.cross_validate(df, ["c"], ["x"], est, ML.tree_maps(est, ML.grid(space)), "key", k=3)
        assert len(cv.avgMetrics) == 2 and all(m > 0 for m in cv.avgMetrics)


def test_perfect_correlation_and_u_at_its_mean(spark):
    df = spark.createDataFrame([(float(i), -2.0 * i) for i in range(9)], "x double, y double")
    row = H.pearson(df, [], "x", "y").first()
    assert row["r"] == pytest.approx(-1.0) and row["p_value"] == pytest.approx(0.0, abs=1e-12)
    mw = H.mann_whitney(spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), ("b", 3.0)], "g string, v double"),
                        [], "g", "v", "a", "b").first()
    assert mw["u"] == 2.0 and mw["p_value"] == 1.0


def test_screen_ranks_once_and_handles_nulls(spark):
    rng = np.random.default_rng(8)
    rows = [("ab"[i % 2], None if i % 5 == 0 else "xyz"[i % 3], float(rng.normal() + i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "f string, g string, t double")
    got = {r["feature"]: r for r in H.feature_screen(df, ["f", "g"], "t").collect()}
    for name in ("f", "g"):
        one = H.kruskal(df, [], name, "t").first()
        assert got[name]["h"] == pytest.approx(one["h"]) and got[name]["n"] == one["n"]
    both = {r["feature"]: r["test"] for r in H.screen(df.withColumn("x", F.col("t") * 2), ["f"], ["x"], "t").collect()}
    assert both == {"f": "kruskal", "x": "pearson"}
