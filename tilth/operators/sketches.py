"""Mergeable sketches, one row per period and column.

A period's rows are read once.  Kept of each column are a quantile sketch, a distinct-count
sketch, the numbers of present and missing values, their sum, sum of squares and bounds; a
table of some kilobytes per period and column.  Drift between any sets of periods, their
summaries and the distinct pre-screen come from merged sketches; no period is read again.

The quantile sketch with parameter K answers ranks within about 1.33 / K**0.9 of the truth
(normalised, 99 %: 1.1 % at 200, 0.35 % at 800), so a KS statistic from two of them is
within twice that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.operators.profile import is_missing

K = 800
POINTS = 400


def period_sketches(df: DataFrame, period: str, cols: list[str], k: int = K) -> DataFrame:
    """(period, column, n, missing, s, q, low, high, quantiles, distinct) from one pass; numeric
    columns only.  ``s`` and ``q`` are the sum and sum of squares of the present values."""
    aggs = []
    for i, c in enumerate(cols):
        gone = is_missing(df, c)
        x = F.when(~gone, F.col(f"`{c}`").cast("double"))
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(gone).alias(f"m{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}"),
                 F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"k{i}"),
                 F.hll_sketch_agg(x.cast("string")).alias(f"d{i}")]
    wide = df.groupBy(F.col(f"`{period}`").alias("period")).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), *[F.col(f"{a}{i}").alias(n) for a, n in (
            ("n", "n"), ("m", "missing"), ("s", "s"), ("q", "q"), ("l", "low"), ("h", "high"), ("k", "quantiles"), ("d", "distinct"))])
        for i, c in enumerate(cols)])).alias("r")
    return wide.select("period", rows).select("period", "r.*")


def merged(sketches: DataFrame, periods: Column | None = None) -> DataFrame:
    """The sketches of all periods that ``periods`` (a condition on ``period``) holds for, merged:
    one row per column."""
    chosen = sketches if periods is None else sketches.where(periods)
    return chosen.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))


def _all_quantiles(sketch: Column, points: int) -> Column:
    """Quantiles of a sketch at the middles of ``points`` equal shares."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit((i + 0.5) / points) for i in range(points)]))


def summary(sketches: DataFrame, periods: Column | None = None) -> DataFrame:
    """(column, n, missing, mean, std, low, q25, q50, q75, high, n_distinct) of merged periods."""
    m = merged(sketches, periods)
    mean = F.try_divide(F.col("s"), F.col("n"))
    var = F.greatest(F.lit(0.0), F.try_divide(F.col("q"), F.col("n")) - mean * mean)
    some = F.col("n") > 0
    return m.select("column", "n", "missing", mean.alias("mean"), F.sqrt(F.try_divide(var * F.col("n"), F.col("n") - 1)).alias("std"), "low",
                    *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(f"q{int(100 * p)}") for p in (0.25, 0.5, 0.75)],
                    "high", F.hll_sketch_estimate("distinct").alias("n_distinct"))


def drift(sketches: DataFrame, reference: Column, current: Column, points: int = POINTS) -> DataFrame:
    """(column, n_ref, n_cur, ks, wasserstein_norm, distinct_ref, distinct_cur) between two sets of
    periods, from sketches alone.

    ``ks`` is the greatest gap of the two shares at or below any of ``points`` quantiles of
    either side (so within 1 / ``points`` beside the sketches' error), ``wasserstein_norm``
    the mean gap of equal quantiles over the standard deviation of the reference.  A side
    without values gives nulls."""
    a = merged(sketches, reference).select("column", F.struct("*").alias("a"))
    b = merged(sketches, current).select("column", F.struct("*").alias("b"))
    both = a.join(b, "column", "outer")
    there = (F.coalesce(F.col("a.n"), F.lit(0)) > 0) & (F.coalesce(F.col("b.n"), F.lit(0)) > 0)
    both = both.withColumn("qa", F.when(there, _all_quantiles(F.col("a.quantiles"), points)))
    both = both.withColumn("qb", F.when(there, _all_quantiles(F.col("b.quantiles"), points)))

    def up_to(quantiles: str, x: Column) -> Column:
        return F.size(F.filter(quantiles, lambda y: y <= x)) / points

    gaps = F.transform(F.array_distinct(F.concat("qa", "qb")), lambda x: F.abs(up_to("qa", x) - up_to("qb", x)))
    apart = F.aggregate(F.zip_with("qa", "qb", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda acc, x: acc + x) / points
    mean = F.try_divide(F.col("a.s"), F.col("a.n"))
    sd = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("a.q"), F.col("a.n")) - mean * mean))
    return both.select(
        "column", F.coalesce("a.n", F.lit(0)).alias("n_ref"), F.coalesce("b.n", F.lit(0)).alias("n_cur"),
        F.when(there, F.array_max(gaps)).alias("ks"), F.when(there, F.try_divide(apart, sd)).alias("wasserstein_norm"),
        F.hll_sketch_estimate("a.distinct").alias("distinct_ref"), F.hll_sketch_estimate("b.distinct").alias("distinct_cur"))


def constant_columns(df: DataFrame, cols: list[str] | None = None, sketches: DataFrame | None = None) -> DataFrame:
    """(column, is_constant): a distinct sketch of every column in one pass screens
    out what clearly varies; the rest, at most a few columns, is decided exactly by whether
    its least and greatest value differ.  NaN and null are no values."""
    cols = cols or df.columns
    if sketches is None:
        sketched = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(
            F.when(~is_missing(df, c), F.col(f"`{c}`")).cast("string"))).alias(f"d{i}") for i, c in enumerate(cols)]).first()
        estimate = {c: sketched[f"d{i}"] for i, c in enumerate(cols)}
    else:
        estimate = {r["column"]: r["n"] for r in merged(sketches).select("column", F.hll_sketch_estimate("distinct").alias("n")).collect()}
    unsure = [c for c in cols if (estimate.get(c) or 0) <= 8]
    spark = df.sparkSession
    clear = [(c, False) for c in cols if c not in unsure]
    out = spark.createDataFrame(clear, "column string, is_constant boolean")
    if not unsure:
        return out
    value = {c: F.when(~is_missing(df, c), F.col(f"`{c}`")) for c in unsure}
    exact = df.agg(*[(F.min(v).isNull() | (F.min(v) == F.max(v))).alias(f"c{i}") for i, v in enumerate(value.values())])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("is_constant")) for i, c in enumerate(unsure)])).alias("r")
    return reduce(DataFrame.unionByName, [out, exact.select(rows).select("r.*")])
