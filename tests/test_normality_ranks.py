"""W test against published values, exact U against enumeration, renumbering, the missing rule."""

import itertools
import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tilth.operators import cleaning as C
from tilth.operators import htest as H
from tilth.operators import normality as N
from tilth.operators import profile as P

# Published samples with their W and p.
WEIGHTS = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
MILES = [21.0, 21.0, 22.8, 21.4, 18.7, 18.1, 14.3, 24.4, 22.8, 19.2, 17.8, 16.4, 17.3, 15.2, 10.4, 10.4, 14.7, 32.4, 30.4, 33.9,
         21.5, 15.5, 15.2, 13.3, 19.2, 27.3, 26.0, 30.4, 15.8, 19.7, 15.0, 21.4]


def test_quantile(spark):
    ps = [1e-12, 1e-5, 0.01, 0.074, 0.076, 0.3, 0.5, 0.77, 0.99, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(N.norm_quantile(F.col("p")).alias("z")).collect()
    for p, r in zip(ps, got, strict=True):
        assert math.isclose(r["z"], NormalDist().inv_cdf(p), rel_tol=1e-9, abs_tol=1e-12)
    assert spark.range(1).select(N.norm_quantile(F.lit(0.0)).alias("z")).first()["z"] is None


def test_w_published(spark):
    rows = ([("weights", float(x)) for x in WEIGHTS] + [("miles", x) for x in MILES] + [("two", 1.0), ("two", 2.0)]
            + [("flat", 3.0)] * 9 + [("three", x) for x in (1.0, 2.0, 4.0)] + [("odd", float("nan")), ("odd", None), ("odd", 1.0)])
    got = {r["g"]: r for r in N.shapiro(spark.createDataFrame(rows, "g string, x double"), ["g"], "x").collect()}
    assert abs(got["weights"]["w"] - 0.78881) < 1e-4 and abs(got["weights"]["p_value"] - 0.006704) < 1e-5
    assert abs(got["miles"]["w"] - 0.94756) < 1e-4 and abs(got["miles"]["p_value"] - 0.1229) < 1e-4
    for g in ("two", "flat", "odd"):
        assert got[g]["w"] is None and got[g]["p_value"] is None
    # three values: W and p in closed form
    w = (math.sqrt(0.5) * 3) ** 2 / (14 / 3)
    assert math.isclose(got["three"]["w"], w)
    assert math.isclose(got["three"]["p_value"], 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))


def test_w_large_samples(spark):
    """Above 5,000 values: the squared correlation with the normal scores, also with long ties."""
    rnd = random.Random(2)
    normal = [rnd.gauss(5, 2) for _ in range(6000)]
    skewed = [round(rnd.expovariate(1), 0) for _ in range(6000)]     # stretches of thousands of equal values
    df = spark.createDataFrame([("n", x) for x in normal] + [("s", x) for x in skewed], "g string, x double")
    got = {r["g"]: r for r in N.shapiro(df, ["g"], "x").collect()}
    for g, xs in (("n", normal), ("s", skewed)):
        m = [NormalDist().inv_cdf((i + 1 - 0.375) / 6000.25) for i in range(6000)]
        mean = sum(xs) / 6000
        want = sum(a * b for a, b in zip(sorted(xs), m, strict=True)) ** 2 / sum(a * a for a in m) / sum((x - mean) ** 2 for x in xs)
        assert abs(got[g]["w"] - want) < 1e-4
    assert got["n"]["p_value"] > 0.01 and got["s"]["p_value"] < 1e-6


@pytest.mark.parametrize("n1, n2", [(1, 1), (3, 2), (2, 8), (8, 5), (8, 8)])
def test_u_counts_by_enumeration(spark, n1, n2):
    want = [0] * (n1 * n2 + 1)
    for s in itertools.combinations(range(1, n1 + n2 + 1), n1):
        want[sum(s) - n1 * (n1 + 1) // 2] += 1
    assert spark.range(1).select(H.u_counts(F.lit(n1), F.lit(n2)).alias("c")).first()["c"] == want


def test_exact_u_only_small_and_without_ties(spark):
    rows = [("few", "a", 1.0), ("few", "a", 2.0), ("few", "b", 3.0), ("few", "b", 4.0), ("few", "b", 5.0)]
    rows += [("ties", g, x) for _, g, x in rows[:4]] + [("ties", "b", 4.0)]
    df = spark.createDataFrame(rows, "t string, g string, x double")
    exact = {r["t"]: r for r in H.mann_whitney(df, ["t"], "g", "x", "a", "b", exact=6).collect()}
    plain = {r["t"]: r for r in H.mann_whitney(df, ["t"], "g", "x", "a", "b").collect()}
    assert exact["few"]["p_value"] == pytest.approx(0.2) and plain["few"]["p_value"] != pytest.approx(0.2)
    assert exact["ties"]["p_value"] == plain["ties"]["p_value"]
    assert H.mann_whitney(df.where("t = 'few'"), ["t"], "g", "x", "a", "b", exact=5).first()["p_value"] == plain["few"]["p_value"]


def test_renumber_keeps_every_row(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1.0, 2.0, float("nan")]), rnd.choice(["x", "y", None]), rnd.randint(0, 3)) for _ in range(300)]
    out = C.renumber(spark.createDataFrame(rows, "a double, b string, c int").repartition(5), ["a", "b"]).collect()
    assert sorted(r["row_idx"] for r in out) == list(range(300))

    def place(a, b):
        return (2, 0.0) if a is None else (1, 0.0) if math.isnan(a) else (0, a), (b is None, b or "")
    ordered = sorted(out, key=lambda r: r["row_idx"])
    keys = [place(r["a"], r["b"]) for r in ordered]
    assert keys == sorted(keys)
    assert sorted(map(str, rows)) == sorted(str((r["a"], r["b"], r["c"])) for r in out)


def test_renumber_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "p"), (None, "p"), (3, "q"), (1, "q")], "k int, v string")
    assert sorted((r["row_idx"], r["k"]) for r in C.renumber(df, "k").collect()) == [(0, 1), (1, 3), (2, None), (3, None)]
    assert C.renumber(df.limit(0), "k").columns == ["k", "v", "row_idx"] and C.renumber(df.limit(0), "k").count() == 0


def test_renumber_over_ranges(spark, monkeypatch):
    from tilth.operators import ordered
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 20)
    rows = [(i % 7, 100 - i) for i in range(300)]
    out = C.renumber(spark.createDataFrame(rows, "a int, b int"), ["a", "b"]).orderBy("row_idx").collect()
    assert [(r["a"], r["b"]) for r in out] == sorted(rows) and [r["row_idx"] for r in out] == list(range(300))


def test_missing_rule(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert {r["column"]: r["missing"] for r in P.missing_pct(df).collect()} == {"x": 2, "s": 1}
    assert {r["column"]: r["null_count"] for r in P.null_counts(df).collect()} == {"x": 2, "s": 1}
    assert {r["column"]: r["non_null"] for r in P.info(df).collect()} == {"x": 1, "s": 2}
