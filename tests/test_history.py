"""Sketches, months by name, episodes and density curves against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators import monitor as M
from tilth.operators import sketches as S
from tilth.operators.density import density
from tilth.operators.episodes import drift_episodes
from tilth.sources import files


def test_merged_sketches_equal_one_sketch(spark):
    rnd = random.Random(5)
    rows = [(f"m{rnd.randint(1, 4)}", rnd.choice([None, float("nan"), rnd.gauss(0, 1)]), rnd.randint(0, 50)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "month string, x double, k int")
    monthly = S.period_sketches(df, "month", ["x", "k"])
    assert monthly.count() == 8
    got = {r["column"]: r for r in S.summary(monthly).collect()}
    xs = sorted(r[1] for r in rows if r[1] is not None and not math.isnan(r[1]))
    assert got["x"]["n"] == len(xs) and got["x"]["missing"] == 4000 - len(xs)
    assert math.isclose(got["x"]["mean"], sum(xs) / len(xs), abs_tol=1e-12) and got["x"]["low"] == xs[0] and got["x"]["high"] == xs[-1]
    assert abs(sum(x <= got["x"]["q50"] for x in xs) / len(xs) - 0.5) < 0.01 and abs(got["k"]["n_distinct"] - 51) <= 2


def test_drift_from_sketches(spark):
    rnd = random.Random(6)
    rows = [("a", rnd.gauss(0, 1), 1.0) for _ in range(3000)] + [("b", rnd.gauss(0.5, 1.2), 1.0) for _ in range(2000)]
    df = spark.createDataFrame(rows, "month string, x double, same double")
    got = {r["column"]: r for r in S.drift(S.period_sketches(df, "month", ["x", "same"]), F.col("period") == "a", F.col("period") == "b").collect()}
    both = df.withColumn("dataset", F.when(F.col("month") == "a", M.REF).otherwise(M.CUR))
    assert abs(got["x"]["ks"] - M.ks_test(both, ["x"]).first()["statistic"]) < 0.01
    assert abs(got["x"]["wasserstein_norm"] - M.wasserstein(both, ["x"]).first()["statistic"]) < 0.03
    assert got["same"]["ks"] == 0 and got["x"]["n_ref"] == 3000
    none = S.drift(S.period_sketches(df, "month", ["x"]), F.col("period") == "a", F.col("period") == "z").first()
    assert none["ks"] is None and none["n_cur"] == 0


def test_constant_columns(spark):
    df = spark.createDataFrame([(i, 7, float("nan") if i % 2 else 2.0, "a" if i else "b") for i in range(50)], "i int, c int, n double, s string")
    want = {"i": False, "c": True, "n": True, "s": False}
    assert {r["column"]: r["is_constant"] for r in S.constant_columns(df).collect()} == want


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_months_by_name(spark, tmp_dir):
    for m in ("2024_01", "2024_02", "2024_03"):
        with open(f"{tmp_dir}/corn_{m}.csv", "w") as f:
            f.write(f"a,b\n{int(m[-2:])},x\n")
    with open(f"{tmp_dir}/notes.csv", "w") as f:
        f.write("other\n1\n")
    got = files.read_months(spark, tmp_dir, ["2024_03", "2024_01"], SCHEMA)
    assert sorted(map(tuple, got.collect())) == [(1, "x", "2024_01"), (3, "x", "2024_03")]
    assert sorted(f.rsplit("/", 1)[1] for f in got.inputFiles()) == ["corn_2024_01.csv", "corn_2024_03.csv"]
    with pytest.raises(FileNotFoundError):
        files.read_months(spark, tmp_dir, ["2024_04"], SCHEMA)


def test_episodes(spark):
    flags = {"p": "0110111", "q": "111", "r": "000", "s": "1001"}
    rows = [(p, i, bool(int(c))) for p, cs in flags.items() for i, c in enumerate(cs)] + [("s", 1, None), ("s", None, True)]
    got = drift_episodes(spark.createDataFrame(rows, "p string, t int, d boolean"), "t", "d", ["p"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("p", 1, 1, 2, 2, 3), ("p", 2, 4, 6, 3, None), ("q", 1, 0, 2, 3, None), ("s", 1, 0, 0, 1, 1), ("s", 2, 3, 3, 1, None)], key=str)


def test_density_against_the_direct_sum(spark):
    rnd = random.Random(7)
    xs = [rnd.gauss(500, 200) for _ in range(300)]
    df = spark.createDataFrame([("a", x) for x in xs] + [("flat", 1.0), ("flat", 1.0), ("one", 2.0), ("a", None), (None, 3.0)], "g string, x double")
    got = density(df, "x", "g", points=400).collect()
    assert {r["hue"] for r in got} == {"a"} and len(got) == 400
    mean = sum(xs) / 300
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / 299) * 300 ** -0.2
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - x) / h) ** 2) for x in xs) / (300 * h * math.sqrt(2 * math.pi))
        assert abs(r["density"] - want) < 1e-6
