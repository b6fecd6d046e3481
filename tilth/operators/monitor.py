"""Monitoring: scored sets, performance reports, column and dataset drift.

Reference and current data live in one DataFrame tagged by a ``dataset``
column, so every report is one grouped aggregation instead of two passes.
Empirical CDFs for KS and Wasserstein come from range-partitioned running
counts over the distinct values of each column (no per-column collect).

Each column's method is an argument (``methods``), else the rule's method for its kind; the
kind is the list the caller puts the column in.  Neither depends on the number of rows,
so the same data get the same answer at every size.  Defaults are distances (normed
Wasserstein, Jensen-Shannon, drift at 0.1), which stay comparable on large data where
every test rejects; ``ks``, ``chi2`` and ``proportion`` (two-valued columns) are tests with
p < 0.05.  The dataset drifts when at least half of its columns do.  A side without rows
gives a null statistic and no drift.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.stats import chi2_pvalue, ks_pvalue, nan_to_null, norm_pvalue
from tilth.operators.common import with_scalars
from tilth.operators.ordered import running_sums

REF, CUR = "reference", "current"


@dataclass(frozen=True)
class DriftRules:
    numeric_method: str = "wasserstein"
    categorical_method: str = "jensen_shannon"
    p_threshold: float = 0.05
    distance_threshold: float = 0.1
    dataset_share: float = 0.5


def tag(reference: DataFrame, current: DataFrame | None, col: str = "dataset") -> DataFrame:
    """reference UNION ALL current with a dataset tag; current may be absent."""
    out = reference.withColumn(col, F.lit(REF))
    if current is not None:
        out = out.unionByName(current.withColumn(col, F.lit(CUR)))
    return out


def group_mean_model(train: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """A baseline model: per-key mean of the target, global mean as the fallback."""
    per_key = train.groupBy(key).agg(F.avg(target).alias("_pred"))
    overall = train.agg(F.avg(target).alias("_fallback"))
    return per_key, overall


def score_group_mean(df: DataFrame, model: tuple[DataFrame, DataFrame], key: str,
                     out: str = "prediction") -> DataFrame:
    per_key, overall = model
    j = with_scalars(df.join(per_key, key, "left"), overall)
    return j.withColumn(out, F.coalesce(F.col("_pred"), F.col("_fallback"))).drop("_pred", "_fallback")


def performance(scored: DataFrame, target: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """n, RMSE, R2 = 1 - SSE/SST, MAE, mean error and error std per group (one pass)."""
    by = by if by is not None else ["dataset"]
    e = F.col(prediction) - F.col(target)
    y = F.col(target)
    ok = scored.where(y.isNotNull() & F.col(prediction).isNotNull())
    agg = ok.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("mean_error"), F.stddev_samp(e).alias("error_std"))
    return agg.select(*by, "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
                      (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"),
                      "mae", "mean_error", "error_std")


def _long(df: DataFrame, cols: list[str], dataset: str, as_string: bool) -> DataFrame:
    cast = "string" if as_string else "double"
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value"))
                             for c in cols])).alias("kv")
    out = df.select(F.col(dataset).alias("dataset"), kv).select("dataset", "kv.column", "kv.value")
    cond = F.col("value").isNotNull()
    if not as_string:
        cond = cond & ~F.isnan("value")
    return out.where(cond)


def _side_counts(long: DataFrame) -> DataFrame:
    """One row per (column, value): counts on the reference and current side."""
    return long.groupBy("column", "value").agg(
        F.count_if(F.col("dataset") == REF).cast("long").alias("n_ref"),
        F.count_if(F.col("dataset") == CUR).cast("long").alias("n_cur"))


def ks_test(df: DataFrame, cols: list[str], dataset: str = "dataset") -> DataFrame:
    """Two-sample KS: D = max |F_ref - F_cur| over the pooled distinct values;
    p from the Kolmogorov series at sqrt(n m / (n + m)) * D."""
    rs = running_sums(_side_counts(_long(df, cols, dataset, False)), ["column"], "value", ["n_ref", "n_cur"])
    fr = F.try_divide(F.col("n_ref_before") + F.col("n_ref"), F.col("n_ref_total"))
    fc = F.try_divide(F.col("n_cur_before") + F.col("n_cur"), F.col("n_cur_total"))
    d = rs.groupBy("column").agg(F.max(F.abs(fr - fc)).alias("statistic"),
                                 F.max("n_ref_total").alias("n_ref"), F.max("n_cur_total").alias("n_cur"))
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    en = F.try_divide(n * m, n + m)
    return d.withColumn("p_value", ks_pvalue(F.sqrt(en) * F.col("statistic")))


def wasserstein(df: DataFrame, cols: list[str], dataset: str = "dataset") -> DataFrame:
    """First Wasserstein distance between the two empirical distributions, divided by
    max(reference population std, 0.001): integral of |F_ref - F_cur| over the values."""
    long = _long(df, cols, dataset, False)
    rs = running_sums(_side_counts(long), ["column"], "value", ["n_ref", "n_cur"])
    step = F.abs(F.try_divide(F.col("n_ref_before"), F.col("n_ref_total"))
                 - F.try_divide(F.col("n_cur_before"), F.col("n_cur_total")))
    two_sided = (F.col("n_ref_total") > 0) & (F.col("n_cur_total") > 0)
    w = rs.groupBy("column").agg(
        F.sum(F.when(two_sided, F.when(F.col("prev_value").isNotNull(), step * (F.col("value") - F.col("prev_value")))
                     .otherwise(0.0))).alias("_w"),
        F.max("n_ref_total").alias("n_ref"), F.max("n_cur_total").alias("n_cur"))
    sd = long.where(F.col("dataset") == REF).groupBy("column").agg(F.stddev_pop("value").alias("_sd"))
    return w.join(sd, "column", "left").select(
        "column", "n_ref", "n_cur",
        (F.col("_w") / F.greatest(F.coalesce(F.col("_sd"), F.lit(0.0)), F.lit(0.001))).alias("statistic"))


def _shares(df: DataFrame, cols: list[str], dataset: str) -> DataFrame:
    c = _side_counts(_long(df, cols, dataset, True))
    tot = c.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    return c.join(tot, "column")


def chi2_test(df: DataFrame, cols: list[str], dataset: str = "dataset") -> DataFrame:
    """Goodness of fit of the current counts to the reference shares over the union of
    categories: sum (obs - exp)^2 / exp, exp = ref_count * n_cur / n_ref; df = k - 1."""
    s = _shares(df, cols, dataset)
    exp = F.try_divide(F.col("n_ref").cast("double") * F.col("t_cur").cast("double"), F.col("t_ref").cast("double"))
    term = F.when(exp > 0, F.pow(F.col("n_cur") - exp, 2) / exp).otherwise(
        F.when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(0.0))
    term = F.when((F.col("t_ref") > 0) & (F.col("t_cur") > 0), term)
    out = s.groupBy("column").agg(F.sum(term).alias("statistic"), F.count(F.lit(1)).alias("k"),
                                  F.max("t_ref").alias("n_ref"), F.max("t_cur").alias("n_cur"))
    return out.withColumn("df", F.col("k") - 1).withColumn(
        "p_value", nan_to_null(chi2_pvalue("statistic", "df")))


def jensen_shannon(df: DataFrame, cols: list[str], dataset: str = "dataset") -> DataFrame:
    """Jensen-Shannon distance (natural log) between the category shares of both sides."""
    s = _shares(df, cols, dataset)
    p = F.try_divide(F.col("n_ref").cast("double"), F.col("t_ref").cast("double"))
    q = F.try_divide(F.col("n_cur").cast("double"), F.col("t_cur").cast("double"))
    m = (p + q) / 2
    two_sided = F.col("t_ref").cast("double") * F.col("t_cur").cast("double") > 0

    def kl(a: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / m)).otherwise(0.0)

    out = s.groupBy("column").agg(F.sum(F.when(two_sided, 0.5 * kl(p) + 0.5 * kl(q))).alias("_js"),
                                  F.max("t_ref").alias("n_ref"), F.max("t_cur").alias("n_cur"))
    # greatest() skips nulls, so a missing side must stay null by itself
    js = F.when(F.col("_js").isNotNull(), F.sqrt(F.greatest(F.col("_js"), F.lit(0.0))))
    return out.select("column", "n_ref", "n_cur", js.alias("statistic"))


def proportion_test(df: DataFrame, cols: list[str], dataset: str = "dataset") -> DataFrame:
    """Two-proportion z test of columns with two values: the share of the larger value on
    both sides, pooled variance, two-sided p.  One value on both sides: z = 0, p = 1.  More
    than two values: null (use chi2)."""
    s = _shares(df, cols, dataset)
    g = s.groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.max(F.struct("value", "n_ref", "n_cur")).alias("top"),
        F.max("t_ref").cast("double").alias("a"), F.max("t_cur").cast("double").alias("b"))
    x, y = F.col("top.n_ref").cast("double"), F.col("top.n_cur").cast("double")
    pooled = F.try_divide(x + y, F.col("a") + F.col("b"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("a")) + F.try_divide(F.lit(1.0), F.col("b"))))
    gap = F.try_divide(y, F.col("b")) - F.try_divide(x, F.col("a"))
    z = F.when(F.col("k") <= 2, F.when(spread == 0, F.lit(0.0)).otherwise(F.try_divide(gap, spread)))
    out = g.select("column", F.col("a").cast("long").alias("n_ref"), F.col("b").cast("long").alias("n_cur"), z.alias("statistic"))
    return out.withColumn("p_value", nan_to_null(norm_pvalue("statistic")))


_METHODS = {"ks": ks_test, "wasserstein": wasserstein, "chi2": chi2_test,
            "jensen_shannon": jensen_shannon, "proportion": proportion_test}
_TESTS = {"ks", "chi2", "proportion"}


def column_drift(df: DataFrame, numeric: list[str], categorical: list[str], dataset: str = "dataset",
                 rules: DriftRules = DriftRules(), methods: dict[str, str] | None = None) -> DataFrame:
    """Per column: the method used, statistic, p-value (tests) and drift flag."""
    chosen = {c: rules.numeric_method for c in numeric} | {c: rules.categorical_method for c in categorical}
    chosen |= methods or {}
    out = df.sparkSession.createDataFrame(
        [], "column string, test string, statistic double, p_value double, drifted boolean")
    for method in sorted(set(chosen.values())):
        found = _METHODS[method](df, [c for c, m in chosen.items() if m == method], dataset)
        if method in _TESTS:
            p, drifted = F.col("p_value"), F.col("p_value") < rules.p_threshold
        else:
            p, drifted = F.lit(None).cast("double"), F.col("statistic") >= rules.distance_threshold
        out = out.unionByName(found.select("column", F.lit(method).alias("test"), "statistic", p.alias("p_value"),
                                           F.coalesce(drifted, F.lit(False)).alias("drifted")))
    return out


def dataset_drift(columns: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """Share of drifted columns and the dataset flag (share >= threshold); no columns: null
    share, no drift."""
    share = F.try_divide(F.col("n_drifted"), F.col("n_columns"))
    return columns.agg(F.count(F.lit(1)).alias("n_columns"),
                       F.count_if("drifted").alias("n_drifted")).select(
        "n_columns", "n_drifted", share.alias("share"),
        F.coalesce(share >= rules.dataset_share, F.lit(False)).alias("dataset_drift"))


def data_summary(df: DataFrame, numeric: list[str], categorical: list[str],
                 dataset: str = "dataset") -> DataFrame:
    """Per (dataset, column): rows, missing, distinct, and numeric moments."""
    num = df.select(F.col(dataset).alias("dataset"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("x"),
                 F.col(c).cast("string").alias("s")) for c in numeric + categorical])).alias("kv"))
    num = num.select("dataset", "kv.column", "kv.x", "kv.s")
    is_num = F.col("column").isin(numeric)
    return num.groupBy("dataset", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("s").isNull()).alias("n_missing"),
        F.count_distinct("s").alias("n_distinct"),
        F.avg(F.when(is_num, F.col("x"))).alias("mean"), F.stddev_samp(F.when(is_num, F.col("x"))).alias("std"),
        F.min(F.when(is_num, F.col("x"))).alias("min"), F.max(F.when(is_num, F.col("x"))).alias("max"))


def report_metadata(df: DataFrame, n_features: int, dataset: str = "dataset",
                    generated_at: str | None = None) -> DataFrame:
    """One row describing a report: sample counts, feature count, analysis type."""
    ts = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    agg = df.agg(F.count_if(F.col(dataset) == REF).alias("reference_samples"),
                 F.count_if(F.col(dataset) == CUR).alias("current_samples"))
    return agg.select(
        "reference_samples", "current_samples", F.lit(n_features).alias("n_features"),
        F.when(F.col("current_samples") > 0, "reference_vs_current").otherwise("reference_only")
         .alias("analysis_type"), ts.alias("generated_at"))


def idempotent_runs(requested: DataFrame, existing: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """For each requested run: 'created' when no report exists for its keys (or force),
    else 'skipped' with the existing report count; existing reports are counted first,
    so a key with many reports never gathers rows."""
    counts = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("existing_reports"))
    j = requested.join(counts, keys, "left").fillna(0, subset=["existing_reports"])
    status = F.lit("created") if force else F.when(F.col("existing_reports") > 0, "skipped").otherwise("created")
    reason = (F.lit("forced") if force else
              F.when(F.col("existing_reports") > 0, F.lit("reports already exist")).otherwise(F.lit("new")))
    return j.select(*keys, status.alias("status"), reason.alias("reason"), "existing_reports")


def metric_trend(runs: DataFrame, order: str, metrics: list[str], by: list[str] | None = None) -> DataFrame:
    """Runs with each metric's change since the previous run of the same series (one run
    per series and time).  The previous time comes from range-partitioned running counts,
    then the previous run's metrics are joined on it: no task holds a whole series, as a
    ``lag`` window partitioned by series would."""
    from tilth.operators.ordered import running_sums
    by = list(by or [])
    times = (runs.where(F.col(order).isNotNull()).select(*by, order).distinct()
             .withColumn("_one", F.lit(1).cast("long")))
    prev = running_sums(times, by, order, ["_one"]).select(*by, order, F.col("prev_" + order).alias("_prev"))
    prior = runs.select(*by, F.col(order).alias("_prev"), *[F.col(m).alias("_p_" + m) for m in metrics])
    out = runs.join(prev, by + [order], "left").join(prior, by + ["_prev"], "left")
    return out.select(*[F.col(c) for c in runs.columns],
                      *[(F.col(m) - F.col("_p_" + m)).alias(f"{m}_change") for m in metrics])
