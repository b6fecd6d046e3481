"""Hypothesis tests and feature screening.

Every test is computed for all keys of ``by`` at once (for example one row per
candidate feature of a stacked long table), from per-group aggregates:

* moments per (by, group) are partial aggregates (map-side combined);
* mid-ranks come from range-partitioned running counts over distinct values,
  so a group holding most rows is still ranked by many tasks;
* p-values are applied last, on one row per test.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.stats import chi2_pvalue, f_pvalue, nan_to_null, norm_pvalue, t_pvalue
from tilth.operators.common import with_scalars
from tilth.operators.ordered import exact_quantiles, midranks_of_counts
from tilth.session import materialize


def _keyed(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    if by:
        return df, list(by)
    return df.withColumn("_all", F.lit(0)), ["_all"]


def _drop_all(df: DataFrame, by: list[str]) -> DataFrame:
    return df if by else df.drop("_all")


def _join_summaries(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Join two per-test summary tables; with no test keys both are single rows, so the
    second becomes a scalar subquery instead of a join on a constant."""
    if keys == ["_all"]:
        return with_scalars(a, b.drop("_all"))
    return a.join(b, keys)


def _finite(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def group_moments(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    return df.where(_finite(value) & F.col(group).isNotNull()).groupBy(*by, group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))


def anova(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """One-way ANOVA: F = (SSB/(k-1)) / (SSW/(N-k)), p from the F(k-1, N-k) tail."""
    df, keys = _keyed(df, by)
    g = group_moments(df, keys, group, value)
    # grand mean per test: one row per test key (a scalar subquery when there is one
    # test), joined back, so the per-group rows of one test are never gathered together
    gm = g.groupBy(*keys).agg(F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_gm"))
    g = _join_summaries(g, gm, keys)
    a = g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_gm"), 2)).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"))
    a = a.withColumn("df1", F.col("k") - 1).withColumn("df2", F.col("n") - F.col("k"))
    a = a.withColumn("f", F.try_divide(F.try_divide(F.col("ssb"), F.col("df1")),
                                       F.try_divide(F.col("ssw"), F.col("df2"))))
    a = a.withColumn("p_value", nan_to_null(f_pvalue("f", "df1", "df2")))
    return _drop_all(a.select(*keys, "k", "n", "f", "df1", "df2", "p_value"), by)


def levene(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """Brown-Forsythe / median-centred Levene: ANOVA on |x - group median|."""
    df, keys = _keyed(df, by)
    clean = df.where(_finite(value) & F.col(group).isNotNull())
    med = exact_quantiles(clean, keys + [group], value, {"_med": 0.5}).drop("n")
    dev = clean.join(med, keys + [group]).select(
        *keys, group, F.abs(F.col(value) - F.col("_med")).alias("_dev"))
    out = anova(dev, keys, group, "_dev").withColumnRenamed("f", "w")
    return _drop_all(out, by)


def ttest_pooled(df: DataFrame, by: list[str], group: str, value: str, a, b) -> DataFrame:
    """Two-sample t test with pooled variance between group labels a and b."""
    df, keys = _keyed(df, by)
    g = group_moments(df.where(F.col(group).isin([a, b])), keys, group, value)
    s = g.groupBy(*keys).agg(
        F.max(F.when(F.col(group) == a, F.col("n"))).alias("n1"),
        F.max(F.when(F.col(group) == b, F.col("n"))).alias("n2"),
        F.max(F.when(F.col(group) == a, F.col("mean"))).alias("mean1"),
        F.max(F.when(F.col(group) == b, F.col("mean"))).alias("mean2"),
        F.max(F.when(F.col(group) == a, F.col("var"))).alias("_v1"),
        F.max(F.when(F.col(group) == b, F.col("var"))).alias("_v2"))
    dfree = F.col("n1") + F.col("n2") - 2
    sp2 = F.try_divide((F.col("n1") - 1) * F.col("_v1") + (F.col("n2") - 1) * F.col("_v2"), dfree)
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(sp2 * (1.0 / F.col("n1") + 1.0 / F.col("n2"))))
    s = s.withColumn("df", dfree).withColumn("t", t)
    s = s.withColumn("p_value", nan_to_null(t_pvalue("t", "df")))
    return _drop_all(s.select(*keys, "n1", "n2", "mean1", "mean2", "t", "df", "p_value"), by)


def rank_sums(df: DataFrame, by: list[str], group: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Per (by, group): n and sum of pooled mid-ranks; per by: N and tie term sum(t^3 - t)."""
    clean = df.where(_finite(value) & F.col(group).isNotNull())
    # one read of the rows: counts by group and value; the pooled counts come from them
    per_value = materialize(clean.groupBy(*by, group, value).agg(F.count(F.lit(1)).alias("_c")))
    pooled = per_value.groupBy(*by, value).agg(F.sum("_c").alias("cnt"))
    ranks = midranks_of_counts(pooled, by, value)
    sums = per_value.join(ranks.select(*by, value, "midrank"), by + [value]).groupBy(*by, group).agg(
        F.sum("_c").alias("n_g"), F.sum(F.col("_c") * F.col("midrank")).alias("rank_sum"))
    ties = ranks.groupBy(*by).agg(
        F.max("n").alias("n_total"),
        F.sum(F.pow(F.col("cnt").cast("double"), 3) - F.col("cnt")).alias("tie_term"))
    return sums, ties


def u_counts(n1: Column, n2: Column) -> Column:
    """How many of the samples of n1 out of n1 + n2 ranks have U = 0, 1, .. n1 n2, as an array.

    The counts are the coefficients of the product over i = 1 .. n1 of (1 - q^(n2 + i)) / (1 - q^i):
    a fold over i, each step a shifted difference and a shifted running sum."""
    n1, n2 = n1.cast("int"), n2.cast("int")
    start = F.transform(F.sequence(F.lit(0), n1 * n2), lambda k: F.when(k == 0, 1.0).otherwise(0.0))
    at = lambda a, k: F.when(k >= 0, F.get(a, k)).otherwise(0.0)

    def step(a: Column, i: Column) -> Column:
        less = F.transform(a, lambda x, k: x - at(a, k - n2 - i))
        return F.aggregate(less, F.array().cast("array<double>"),
                           lambda acc, x: F.concat(acc, F.array(x + at(acc, F.size(acc) - i))))
    return F.aggregate(F.sequence(F.lit(1), n1), start, step)


def _exact_u(n1: Column, n2: Column, u: Column) -> Column:
    """Two-sided p of U without ties: twice the share of samples at least as far out."""
    big = F.greatest(u, n1 * n2 - u).cast("int")
    counts = u_counts(n1, n2)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    return F.least(F.lit(1.0), 2 * total(F.slice(counts, big + 1, F.size(counts))) / total(counts))


def mann_whitney(df: DataFrame, by: list[str], group: str, value: str, a, b, exact: int = 0) -> DataFrame:
    """Two-sided Mann-Whitney U with tie and continuity correction (normal approximation).
    ``u`` is the statistic of sample a.  Tests without ties whose n1 * n2 is at most
    ``exact`` take the exact distribution of U instead (their z stays the approximation's)."""
    df, keys = _keyed(df, by)
    sums, ties = rank_sums(df.where(F.col(group).isin([a, b])), keys, group, value)
    s = sums.groupBy(*keys).agg(
        F.max(F.when(F.col(group) == a, F.col("n_g"))).alias("n1"),
        F.max(F.when(F.col(group) == b, F.col("n_g"))).alias("n2"),
        F.max(F.when(F.col(group) == a, F.col("rank_sum"))).alias("_r1"))
    s = _join_summaries(s, ties, keys)
    n1, n2, n = [F.col(c).cast("double") for c in ("n1", "n2", "n_total")]   # products of counts pass 2^63
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2.0
    s = s.withColumn("u", u1)
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    big = F.greatest(F.col("u"), n1 * n2 - F.col("u"))
    # at its mean U is no evidence: the continuity correction must not turn it negative
    s = s.withColumn("z", F.try_divide(F.greatest(big - mu - 0.5, F.lit(0.0)), sigma))
    p = F.least(F.lit(1.0), nan_to_null(norm_pvalue("z")))
    if exact > 0:
        small = (F.col("tie_term") == 0) & (n1 * n2 <= exact) & (n1 * n2 > 0)
        p = F.when(small, _exact_u(n1, n2, F.col("u"))).otherwise(p)
    s = s.withColumn("p_value", p)
    return _drop_all(s.select(*keys, "n1", "n2", "u", "z", "p_value"), by)


def kruskal(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction; p from chi-square with k-1 degrees of freedom."""
    df, keys = _keyed(df, by)
    sums, ties = rank_sums(df, keys, group, value)
    return _drop_all(_kruskal_h(_join_summaries(sums, ties, keys), keys), by)


def _kruskal_h(sums: DataFrame, keys: list[str]) -> DataFrame:
    """H from one row per (test, group): n_g, rank_sum, and the test's n_total and tie_term."""
    n = F.col("n_total").cast("double")
    gap = F.col("rank_sum") / F.col("n_g") - (n + 1) / 2.0      # no difference of two huge sums
    s = sums.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("n_g") * gap * gap).alias("_q"),
        F.max("n_total").alias("n_total"), F.max("tie_term").alias("tie_term"))
    h = F.try_divide(12.0 / (n * (n + 1)) * F.col("_q"), 1 - F.try_divide(F.col("tie_term"), n * n * n - n))
    s = s.withColumn("h", h).withColumn("df", F.col("k") - 1)
    s = s.withColumn("p_value", nan_to_null(chi2_pvalue("h", "df")))
    return s.select(*keys, "k", F.col("n_total").alias("n"), "h", "df", "p_value")


def pearson(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Pearson r, t = r sqrt((n-2)/(1-r^2)) and its two-sided p."""
    df, keys = _keyed(df, by)
    s = df.where(_finite(x) & _finite(y)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r"))
    r, left = F.col("r"), 1 - F.col("r") * F.col("r")
    exact = F.when(F.col("n") > 2, F.signum(r) * F.lit(float("inf")))       # |r| = 1: p = 0
    s = s.withColumn("t", F.when(left <= 0, exact).otherwise(r * F.sqrt(F.try_divide(F.col("n") - 2, left))))
    s = s.withColumn("p_value", nan_to_null(t_pvalue("t", F.col("n") - 2)))
    return _drop_all(s.select(*keys, "n", "r", "t", "p_value"), by)


def jarque_bera(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Normality per group (Jarque-Bera; stands in for Shapiro-Wilk, a different test):
    JB = n/6 (g^2 + k^2/4) with population skewness g and excess kurtosis k, p = exp(-JB/2).
    Groups with fewer than 3 values get null statistics, as a failing test would."""
    df, keys = _keyed(df, by)
    s = df.where(_finite(value)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurt"))
    ok = F.col("n") >= 3
    s = s.select(*keys, "n", F.when(ok, F.col("skew")).alias("skew"), F.when(ok, F.col("kurt")).alias("kurt"))
    s = s.withColumn("jb", F.col("n") / 6.0 * (F.pow(F.col("skew"), 2) + F.pow(F.col("kurt"), 2) / 4.0))
    s = s.withColumn("p_value", F.exp(-F.col("jb") / 2.0))
    return _drop_all(s, by)


def stack_features(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Long table (feature, level, target) so one job tests every candidate feature."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level"))
                                for f in features])).alias("kv")
    return df.select(pairs, F.col(target).alias("target")).select("kv.feature", "kv.level", "target")


def kruskal_screen(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Kruskal-Wallis of the target across the levels of every feature.

    The target is ranked once for all features without nulls: its mid-ranks are joined
    on the value and summed by (feature, level).  A feature with nulls has fewer rows and
    so ranks of its own; those go through the stacked table."""
    clean = df.where(_finite(target)).select(F.col(target).alias("target"), *[F.col(f).cast("string").alias(f) for f in features])
    nulls = clean.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in features]).first()
    whole = [f for f in features if not nulls[f]]
    rest = [f for f in features if nulls[f]]
    out = []
    if whole:
        ranks = midranks_of_counts(clean.groupBy("target").agg(F.count(F.lit(1)).alias("cnt")), [], "target")
        level = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("level")) for f in whole])).alias("kv")
        sums = clean.join(ranks.select("target", "midrank"), "target").select(level, "midrank").groupBy(
            "kv.feature", "kv.level").agg(F.count(F.lit(1)).alias("n_g"), F.sum("midrank").alias("rank_sum"))
        ties = ranks.agg(F.max("n").alias("n_total"),
                         F.sum(F.pow(F.col("cnt").cast("double"), 3) - F.col("cnt")).alias("tie_term"))
        out.append(_kruskal_h(with_scalars(sums, ties), ["feature"]))
    if rest:
        out.append(kruskal(stack_features(clean, rest, "target"), ["feature"], "level", "target"))
    return reduce(lambda a, b: a.unionByName(b), out)


def feature_screen(df: DataFrame, categorical: list[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Kruskal-Wallis of the target across the levels of every categorical feature; keep
    features with p < alpha."""
    return kruskal_screen(df, categorical, target).withColumn("keep", F.col("p_value") < alpha)


def screen(df: DataFrame, categorical: list[str], numeric: list[str], target: str, alpha: float = 0.05,
           parametric: bool = False) -> DataFrame:
    """(feature, test, statistic, p_value, keep) of all candidate features: Pearson for numeric
    ones (one aggregate for all), ANOVA (``parametric``) or Kruskal-Wallis for categorical ones."""
    out = []
    if categorical and parametric:
        a = anova(stack_features(df, categorical, target), ["feature"], "level", "target")
        out.append(a.select("feature", F.lit("anova").alias("test"), F.col("f").alias("statistic"), "p_value"))
    elif categorical:
        k = kruskal_screen(df, categorical, target)
        out.append(k.select("feature", F.lit("kruskal").alias("test"), F.col("h").alias("statistic"), "p_value"))
    if numeric:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                    for c in numeric])).alias("kv")
        long = df.select(F.col(target).cast("double").alias("y"), pairs).select("y", "kv.feature", "kv.x")
        out.append(pearson(long, ["feature"], "x", "y").select(
            "feature", F.lit("pearson").alias("test"), F.col("r").alias("statistic"), "p_value"))
    return reduce(lambda a, b: a.unionByName(b), out).withColumn("keep", F.col("p_value") < alpha)


def test_router(df: DataFrame, by: list[str], group: str, value: str, alpha: float = 0.05) -> DataFrame:
    """Choose the comparison: equal variances (Levene) and every group normal -> ANOVA
    (t test for two groups); otherwise Kruskal-Wallis (Mann-Whitney for two groups)."""
    df, keys = _keyed(df, by)
    lev = levene(df, keys, group, value).select(*keys, "k", F.col("p_value").alias("levene_p"))
    norm = jarque_bera(df, keys + [group], value).groupBy(*keys).agg(
        F.min("p_value").alias("min_normal_p"))
    j = lev.join(norm, keys)
    parametric = (F.col("levene_p") >= alpha) & (F.col("min_normal_p") >= alpha)
    test = (F.when(parametric & (F.col("k") == 2), "t-test").when(parametric, "anova")
            .when(F.col("k") == 2, "mann-whitney").otherwise("kruskal"))
    return _drop_all(j.withColumn("test", test), by)
