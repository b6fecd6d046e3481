"""Fits that read their rows a fixed number of times."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tilth.operators import modeling as ML
from tilth.operators.encode import ml_encoder

CAT, NUM = ["c", "d"], ["x", "z"]


def table(spark, n=1500):
    rnd = random.Random(5)
    rows = []
    for _ in range(n):
        c, d, x, z = rnd.choice("abc"), rnd.choice("uv"), float(rnd.randint(1, 60)), rnd.randint(0, 8) / 100
        rows.append((c, d, x, z, 3 * x - 700 * z + (40 if c == "b" else 0) + (x > 30) * (d == "u") * 25 + rnd.gauss(0, 9)))
    return spark.createDataFrame(rows, "c string, d string, x double, z double, target double").coalesce(1)


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).select(*CAT, *NUM, "target", "prediction").orderBy(
        *CAT, *NUM, "target").collect()])


def test_boosted_trees_work_on_cells(spark, monkeypatch):
    """The model predicts as one fitted on the rows; what the rounds pass over does not grow."""
    df = table(spark)
    est = ML.boosted_trees(max_iter=12)
    by_rows = Pipeline(stages=ml_encoder(CAT, NUM).getStages() + [est]).fit(df)
    passed = []
    real = ML._spread
    monkeypatch.setattr(ML, "_spread", lambda rows: passed.append(rows.count()) or real(rows))
    model = ML.fit(df, CAT, NUM, est)
    assert np.allclose(predictions(model, df), predictions(by_rows, df), rtol=1e-6)
    ML.fit(df.union(df).union(df), CAT, NUM, est)
    assert passed[0] == passed[1] <= 3 * 2 * 32 * 9


def test_forest_works_on_cells(spark, monkeypatch):
    """What the trees pass over does not grow with the rows, and they predict as well as trees
    fitted on the rows."""
    monkeypatch.setattr(ML, "PIECES", 1200)
    df, passed, real = table(spark), [], ML._spread
    monkeypatch.setattr(ML, "_spread", lambda rows: passed.append(rows.count()) or real(rows))
    est = ML.random_forest(num_trees=30, max_depth=6)
    model = ML.fit(df, CAT, NUM, est)
    for shift in (0.5, 1.0):
        df = df.union(df.withColumn("target", F.col("target") + shift))
    ML.fit(df, CAT, NUM, est)
    assert len(passed) == 2 and passed[1] <= 1.2 * passed[0] <= 1.2 * max(1200, 3 * 2 * 32 * 9)
    by_rows = Pipeline(stages=ml_encoder(CAT, NUM).getStages() + [est]).fit(table(spark))
    error = {n: ML.evaluate(m, table(spark), []).first()["rmse"] for n, m in (("cells", model), ("rows", by_rows))}
    assert abs(error["cells"] - error["rows"]) < 0.1 * error["rows"]


def test_forest_on_few_rows_is_the_one_on_rows(spark):
    df, est = table(spark), ML.random_forest(num_trees=5, max_depth=4)
    by_rows = Pipeline(stages=ml_encoder(CAT, NUM).getStages() + [est]).fit(df)
    assert predictions(ML.fit(df, CAT, NUM, est), df).tolist() == predictions(by_rows, df).tolist()


def test_forest_predicts_each_combination_once(spark):
    """Rows with equal features share a prediction, gaps included; every row gets one."""
    df = table(spark)
    model = ML.fit(df, CAT, NUM, ML.random_forest(num_trees=5, max_depth=4))
    odd = df.union(df).union(df.limit(60).withColumn("c", F.lit(None).cast("string")))
    want = sorted(map(str, model.transform(odd).select(*CAT, *NUM, "target", "prediction").collect()))
    assert sorted(map(str, ML.predict(model, odd).select(*CAT, *NUM, "target", "prediction").collect())) == want
    assert "Aggregate" in ML.evaluate(model, df, ["c"])._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1]


def test_many_values(spark, monkeypatch):
    monkeypatch.setattr(ML, "MANY_VALUES", 40)
    df = table(spark)
    model = ML.fit(df, CAT, NUM, ML.boosted_trees(max_iter=10))
    r = model.transform(df).agg(F.avg(F.pow(F.col("prediction") - F.col("target"), 2)), F.var_pop("target")).first()
    assert r[0] < 0.5 * r[1]


@pytest.mark.parametrize("column", ["x", "target"])
def test_missing_numbers_stay_an_error(spark, column):
    gaps = table(spark, 60).withColumn(column, F.when(F.col("c") != "a", F.col(column)))
    with pytest.raises(Exception):
        ML.fit(gaps, CAT, NUM, ML.boosted_trees(max_iter=2))


def test_a_prediction_is_computed_once(spark):
    """No filter computes the prediction a second time."""
    df = table(spark)
    model = ML.fit(df, CAT, NUM, ML.ols())
    plan = ML.evaluate(model, df, ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter isnotnull(UDF" not in plan and "Filter (isnotnull" not in plan


def test_moments_read_the_rows_once(spark):
    """The origin comes from the first rows, however far off it is."""
    rows = ml_encoder(CAT, NUM).fit(table(spark)).transform(table(spark)).withColumn("fold", F.lit(0))
    near = ML.fold_moments(rows)[0]
    x = np.array([[*r["features"].toArray(), r["target"]] for r in rows.collect()])
    assert np.allclose(near.mean, x.mean(axis=0)) and np.allclose(near.cross, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))
