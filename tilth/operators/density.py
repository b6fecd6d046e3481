"""Density curves of histograms by hue: binned Gaussian kernel estimates.

Each value is dealt to the two grid points beside it in proportion to its nearness, so all rows
of a group become at most ``points`` weights in one aggregate with map-side combine; the
curve is the sum of a normal bump around each weighted grid point.  That second part works
on pairs of grid points, whatever the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.operators.htest import _finite

POINTS = 200
CUT = 3.0        # bandwidths that the grid reaches past the smallest and the greatest value


def density(df: DataFrame, value: str, hue: str, points: int = POINTS, cut: float = CUT) -> DataFrame:
    """(hue, point, x, density) of every group: ``points`` places from ``cut`` bandwidths below
    the smallest value to as many above the greatest.

    The bandwidth is the sample standard deviation times n ** (-1/5).  Groups of one value
    or without spread have no curve; null and NaN values and null hues are left out."""
    rows = df.where(_finite(value) & F.col(hue).isNotNull()).select(F.col(hue).alias("hue"), F.col(value).cast("double").alias("v"))
    stats = rows.groupBy("hue").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    stats = stats.where("n > 1 and sd > 0").withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("x0", F.col("lo") - cut * F.col("h")).withColumn(
        "step", (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (points - 1))
    place = (F.col("v") - F.col("x0")) / F.col("step")
    dealt = rows.join(stats.select("hue", "x0", "step"), "hue").select("hue", place.alias("p")).select(
        "hue", F.floor("p").cast("int").alias("i"), (F.col("p") - F.floor("p")).alias("w"))
    two = F.explode(F.array(F.struct(F.col("i").alias("i"), (1 - F.col("w")).alias("w")), F.struct((F.col("i") + 1).alias("i"), F.col("w").alias("w")))).alias("t")
    bins = dealt.select("hue", two).select("hue", "t.*").groupBy("hue", "i").agg(F.sum("w").alias("w"))
    every = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    pairs = bins.join(stats.select("hue", "n", "h", "x0", "step"), "hue").select("*", every)
    z = (F.col("point") - F.col("i")) * F.col("step") / F.col("h")
    bump = F.col("w") * F.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * F.col("h") * F.col("n"))
    return pairs.groupBy("hue", "point").agg(
        F.max(F.col("x0") + F.col("point") * F.col("step")).alias("x"), F.sum(bump).alias("density"))
