"""Distributed running sums against brute force, with one hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilth.operators import ordered
from tilth.operators.ordered import exact_quantiles, midranks, running_sums


@pytest.fixture()
def skewed(spark):
    rng = np.random.default_rng(1)
    # group 'hot' holds most rows; values repeat so ties occur
    g = np.where(rng.random(6000) < 0.8, "hot", rng.choice(["a", "b", "c"], 6000))
    v = np.round(rng.normal(0, 10, 6000), 1)
    return pd.DataFrame({"g": g, "v": v})


def test_running_sums_match_bruteforce(spark, skewed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # many batches per partition
    try:
        df = spark.createDataFrame(skewed).groupBy("g", "v").agg(F.count(F.lit(1)).alias("cnt"))
        got = running_sums(df, ["g"], "v", ["cnt"]).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = skewed.groupby(["g", "v"]).size().rename("cnt").reset_index().sort_values(["g", "v"])
    exp["cnt_before"] = exp.groupby("g")["cnt"].cumsum() - exp["cnt"]
    exp["cnt_total"] = exp.groupby("g")["cnt"].transform("sum")
    exp["prev_v"] = exp.groupby("g")["v"].shift(1)
    exp = exp.reset_index(drop=True)
    assert (got["cnt_before"].values == exp["cnt_before"].values).all()
    assert (got["cnt_total"].values == exp["cnt_total"].values).all()
    assert np.allclose(got["prev_v"].fillna(-1e9).values, exp["prev_v"].fillna(-1e9).values)


def test_same_result_with_other_partition_counts(spark, skewed):
    df = spark.createDataFrame(skewed)
    a = exact_quantiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}).orderBy("g").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = exact_quantiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}).orderBy("g").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_quantiles_match_numpy_linear(spark, skewed):
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(skewed), ["g"], "v",
                                               {"q1": 0.25, "med": 0.5, "q3": 0.75}).collect()}
    for g, sub in skewed.groupby("g"):
        q = np.percentile(sub["v"], [25, 50, 75])
        assert got[g]["q1"] == pytest.approx(q[0])
        assert got[g]["med"] == pytest.approx(q[1])
        assert got[g]["q3"] == pytest.approx(q[2])
        assert got[g]["n"] == len(sub)


def test_midranks_match_pandas(spark, skewed):
    got = midranks(spark.createDataFrame(skewed), ["g"], "v").toPandas()
    exp = skewed.assign(r=skewed.groupby("g")["v"].rank(method="average")).drop_duplicates(["g", "v"])
    m = got.merge(exp, on=["g", "v"])
    assert len(m) == len(exp)
    assert np.allclose(m["midrank"], m["r"])


@pytest.fixture()
def many_ranges(monkeypatch):
    from tilth.operators import ordered
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 40)


def test_hot_group_is_spread_over_ranges(spark, skewed, many_ranges):
    """The premise of the primitive: the group holding most rows is split over many ranges,
    and every range holds about the same number of distinct (group, value) rows."""
    from tilth.operators.ordered import with_ranges
    df = spark.createDataFrame(skewed).groupBy("g", "v").agg(F.count(F.lit(1)).alias("cnt"))
    cut, n = with_ranges(df, "v")
    sizes = [r["c"] for r in cut.groupBy("_rs_range").agg(F.count(F.lit(1)).alias("c")).collect()]
    hot = cut.where("g = 'hot'").select("_rs_range").distinct().count()
    assert n >= 8 and hot >= n // 2
    assert max(sizes) <= 3 * sum(sizes) / len(sizes), sizes


def test_many_ranges_give_the_same_sums(spark, skewed, many_ranges):
    test_running_sums_match_bruteforce(spark, skewed)
    test_quantiles_match_numpy_linear(spark, skewed)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "bigint"])
def test_ranges_of_other_types(spark, kind, many_ranges):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise("g").alias("g"),
        {"string": F.md5(F.col("id").cast("string")), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
         "timestamp_ntz": F.timestamp_micros(F.col("id") * 10**9).cast("timestamp_ntz"), "bigint": F.col("id") * 10**15}[kind].alias("v"),
        (F.col("id") + 1).alias("x"))
    got = running_sums(df, ["g"], "v", ["x"]).toPandas().sort_values(["v"]).reset_index(drop=True)
    for _, sub in got.groupby("g", dropna=False):
        assert (sub["x_before"] == sub["x"].cumsum() - sub["x"]).all() and (sub["x_total"] == sub["x"].sum()).all()
        assert sub["prev_v"].isna().sum() == 1 and (sub["prev_v"].iloc[1:].values == sub["v"].iloc[:-1].values).all()


def test_text_with_a_common_beginning_is_spread(spark, monkeypatch):
    """Cuts look at the whole value, and ranges are not limited in number."""
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(ordered, "MAX_RANGES", 4)
    rows = spark.range(2000).select(F.format_string("https://example.org/page/%05d", "id").alias("v"), F.lit(1).alias("n"))
    spread, n = ordered.with_ranges(rows, "v")
    assert n == 40 and spread.select(ordered._RANGE).distinct().count() > 30
    got = ordered.running_sums(rows, [], "v", ["n"])
    assert got.where(F.col("n_before") != F.right("v", F.lit(5)).cast("int")).count() == 0
    assert got.where("n_total != 2000").count() == 0 and got.where("prev_v is null").count() == 1
    numbers = ordered.running_sums(spark.range(2000).select("id", F.lit(1).alias("n")), [], "id", ["n"])
    assert numbers.where("n_before != id").count() == 0
