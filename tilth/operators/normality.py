"""Normal-scores W test: Shapiro-Wilk up to 5,000 values, Shapiro-Francia above.

W compares the sample's order statistics with the normal quantiles of their ranks.  Ranks
are running counts over distinct values, so a group of any size is ranked by many tasks; the
quantiles are a column expression; per group only sums, the two smallest and two greatest
values and n are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.stats import nan_to_null, norm_pvalue
from tilth.operators.htest import _drop_all, _finite, _join_summaries, _keyed
from tilth.operators.ordered import running_sums, value_counts_by

LARGEST_EXACT = 5000
TIES_ONE_BY_ONE = 1000      # ranks of one value summed singly; longer stretches by the integral

# Coefficients, lowest power first.
# rational approximations of the normal quantile (near the middle, in the tails, far out)
CENTRE = ([3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
           4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
          [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
           3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3])
TAIL = ([1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
        [1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1, 1.48103976427480074590e-1,
         1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
FAR = ([6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1,
        2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
       [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4,
        1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])
# corrections of the two outermost weights, in powers of 1 / sqrt(n)
LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
NEXT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
# mean and log standard deviation of the transformed W: n up to 11 in n, above in ln n
GAMMA = [-2.273, 0.459]
SMALL = ([0.5440, -0.39978, 0.025054, -0.0006714], [1.3822, -0.77857, 0.062767, -0.0020322])
LARGE = ([-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302])


def poly(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def _let(value: Column, body) -> Column:
    """Bind an expression that ``body`` uses several times, so that it is computed once."""
    return F.transform(F.array(value), body)[0]


def norm_quantile(p: Column) -> Column:
    """Standard normal quantile; null outside (0, 1)."""
    ratio = lambda c, x: _let(x, lambda v: poly(c[0], v) / poly(c[1], v))

    def at(p: Column) -> Column:
        q = p - 0.5
        tail = _let(F.sqrt(-F.log(F.least(p, 1 - p))), lambda t: F.when(t <= 5, ratio(TAIL, t - 1.6)).otherwise(ratio(FAR, t - 5)))
        return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * ratio(CENTRE, 0.180625 - q * q)).otherwise(F.signum(q) * tail))
    return _let(p, at)


def _score(i: Column, n: Column) -> Column:
    """Normal quantile of rank i of n."""
    return norm_quantile((i - 0.375) / (n + 0.25))


def _scores(before: Column, cnt: Column, n: Column, power: int) -> Column:
    """Sum of the scores (or their squares) of ranks before + 1 .. before + cnt."""
    singly = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(cnt, F.lit(TIES_ONE_BY_ONE))), F.lit(0.0),
                         lambda acc, i: acc + F.pow(_score((before + i).cast("double"), n), F.lit(power)))
    # a long stretch: integral over ranks before + 1/2 .. before + cnt + 1/2
    lo, hi = [norm_quantile((before + off + 0.125) / (n + 0.25)) for off in (F.lit(0), cnt)]
    bell = lambda z: F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    if power == 1:
        stretch = (n + 0.25) * (bell(lo) - bell(hi))
    else:
        stretch = cnt + (n + 0.25) * (lo * bell(lo) - hi * bell(hi))
    return F.when(cnt <= TIES_ONE_BY_ONE, singly).otherwise(stretch)


def shapiro(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``n``, ``w`` and ``p_value`` of every group.

    Groups with fewer than 3 values, or without spread, get null statistics.  Up to
    ``LARGEST_EXACT`` values W has the corrected weights and the published normal
    approximations of its transforms (exact for n = 3); beyond, weights are proportional to
    the scores and p comes from the approximation published for that form (carried on past
    the sizes it was fitted to).  NaN and null values are left out."""
    df, keys = _keyed(df, by)
    ranks = running_sums(value_counts_by(df.select(*keys, F.col(value).cast("double").alias("x")), keys, "x"), keys, "x", ["cnt"])
    n, before, cnt = F.col("cnt_total").cast("double"), F.col("cnt_before"), F.col("cnt")

    def at(rank: Column) -> Column:
        return F.max(F.when((before < rank) & (rank <= before + cnt), F.col("x")))
    sums = ranks.groupBy(*keys).agg(
        F.max("cnt_total").alias("n"), F.sum(F.col("x") * _scores(before, cnt, n, 1)).alias("_s"),
        F.sum(_scores(before, cnt, n, 2)).alias("_mm"), F.min("x").alias("_x1"), F.max("x").alias("_xn"),
        at(F.lit(2)).alias("_x2"), at(n - 1).alias("_xm"))
    spread = df.where(_finite(value)).groupBy(*keys).agg((F.var_pop(value) * F.count(value)).alias("_ss"))
    s = _join_summaries(sums, spread, keys)
    n, mm = F.col("n").cast("double"), F.col("_mm")
    u = 1 / F.sqrt(n)
    s = s.withColumns({"_m1": _score(n, n), "_m2": _score(n - 1, n)})
    m1, m2 = F.col("_m1"), F.col("_m2")
    s = s.withColumns({"_a1": F.when(n == 3, math.sqrt(0.5)).otherwise(F.try_divide(m1, F.sqrt(mm)) + poly(LAST, u)),
                       "_a2": F.try_divide(m2, F.sqrt(mm)) + poly(NEXT, u)})
    a1, a2 = F.col("_a1"), F.col("_a2")
    ends, inner = F.col("_xn") - F.col("_x1"), F.col("_xm") - F.col("_x2")
    phi_few = F.try_divide(mm - 2 * m1 * m1, 1 - 2 * a1 * a1)
    phi = F.try_divide(mm - 2 * m1 * m1 - 2 * m2 * m2, 1 - 2 * a1 * a1 - 2 * a2 * a2)
    top = (F.when(n <= 3, a1 * ends)
           .when(n <= 5, (F.col("_s") - m1 * ends) / F.sqrt(F.when(phi_few > 0, phi_few)) + a1 * ends)
           .otherwise((F.col("_s") - m1 * ends - m2 * inner) / F.sqrt(F.when(phi > 0, phi)) + a1 * ends + a2 * inner))
    plain = F.try_divide(F.col("_s") * F.col("_s"), mm * F.col("_ss"))
    w = F.when(n > LARGEST_EXACT, plain).otherwise(F.try_divide(top * top, F.col("_ss")))
    s = s.withColumn("w", F.when((n >= 3) & (F.col("_ss") > 0), F.least(w, F.lit(1.0))))
    w, ln = F.col("w"), F.log(n)
    left = F.log(F.greatest(1 - w, F.lit(1e-300)))
    v = F.log(F.greatest(ln, F.lit(1e-9)))
    z = (F.when(n <= 11, (-F.log(F.greatest(poly(GAMMA, n) - left, F.lit(1e-300))) - poly(SMALL[0], n)) / F.exp(poly(SMALL[1], n)))
         .when(n <= LARGEST_EXACT, (left - poly(LARGE[0], ln)) / F.exp(poly(LARGE[1], ln)))
         .otherwise((left - (-1.2725 + 1.0521 * (v - ln))) / (1.0308 - 0.26758 * (v + 2 / ln))))
    s = s.withColumn("_z", F.when(w.isNotNull(), z))
    tail = F.when(F.col("_z") >= 0, norm_pvalue("_z") / 2).otherwise(1 - norm_pvalue("_z") / 2)
    few = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt(w)) - F.asin(F.sqrt(F.lit(0.75)))))
    p = F.when(n == 3, few).otherwise(tail)
    return _drop_all(s.select(*keys, "n", "w", nan_to_null(F.when(w.isNotNull(), p)).alias("p_value")), by)
