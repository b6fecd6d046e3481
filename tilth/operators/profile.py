"""Profiling and descriptive statistics.

Everything is a single aggregate pass or a pre-aggregated shuffle; exact
quantiles go through :mod:`tilth.operators.ordered` so a hot group never lands
in one task.  Column names are arguments; nothing here knows the survey.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.stats import adjusted_kurtosis, adjusted_skew
from tilth.operators.common import with_scalars
from tilth.operators.ordered import exact_quantiles, pick_quantiles, running_sums, value_counts_by

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _stack(pairs: list[tuple[str, Column]], name_col: str, value_col: str) -> Column:
    """Array-of-structs explode expression turning wide columns into long rows."""
    return F.explode(F.array(*[F.struct(F.lit(n).alias(name_col), c.alias(value_col))
                               for n, c in pairs]))


def to_long(df: DataFrame, cols: list[str], name_col: str = "column",
            value_col: str = "value", cast: str | None = "double",
            keep: list[str] | None = None) -> DataFrame:
    pairs = [(c, F.col(f"`{c}`").cast(cast) if cast else F.col(f"`{c}`")) for c in cols]
    e = _stack(pairs, name_col, value_col).alias("_kv")
    return df.select(*(keep or []), e).select(*(keep or []), f"_kv.{name_col}", f"_kv.{value_col}")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) of a table; one count pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN in a floating column (as pandas counts): one rule for all counts here."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def info(df: DataFrame) -> DataFrame:
    """One row per column: position, Spark type, count of values that are not missing (one
    pass, then stacked)."""
    counts = df.agg(*[F.count_if(~is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = [(c, F.struct(F.lit(i).alias("position"),
                          F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                          F.col(f"c{i}").alias("non_null")))
             for i, c in enumerate(df.columns)]
    return counts.select(_stack(pairs, "column", "s").alias("kv")).select(
        F.col("kv.column"), "kv.s.position", "kv.s.dtype", "kv.s.non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column in one aggregate pass (NaN counts as missing, as pandas)."""
    counts = df.agg(*[F.count_if(is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = [(c, F.col(f"c{i}")) for i, c in enumerate(df.columns)]
    return counts.select(_stack(pairs, "column", "null_count").alias("kv")).select(
        "kv.column", "kv.null_count")


def null_total(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("null_count").cast("long").alias("null_total"))


def missing_pct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Percent of all rows (raw denominator) missing each column (null or NaN)."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = [(c, F.struct(F.col(f"m{i}").alias("missing"),
                          F.try_divide(F.col(f"m{i}") * 100.0, F.col("_n")).alias("missing_pct")))
             for i, c in enumerate(cols)]
    return agg.select(_stack(pairs, "column", "s").alias("kv")).select(
        "kv.column", "kv.s.missing", "kv.s.missing_pct")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact q25/q50/q75 (linear), max per numeric column."""
    cols = cols or numeric_columns(df)
    # moments side by side in one aggregate; only the quantiles need a row for each value
    value = [F.when(~is_missing(df, c), F.col(f"`{c}`").cast("double")) for c in cols]
    wide = df.agg(*[F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
                             F.max(v).alias("max")).alias(f"s{i}") for i, v in enumerate(value)])
    moments = wide.select(_stack([(c, F.col(f"s{i}")) for i, c in enumerate(cols)], "column", "s").alias("kv")).select(
        "kv.column", "kv.s.*").where("count > 0")
    long = to_long(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    q = exact_quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(q.drop("n"), "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top, freq per column (ties on freq broken by the smallest value)."""
    long = to_long(df, cols, cast="string").where(F.col("value").isNotNull())
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    return vc.groupBy("column").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct("value", "freq"), F.struct(-F.col("freq"), F.col("value"))).alias("t")
    ).select("column", "count", "unique", F.col("t.value").alias("top"), F.col("t.freq").alias("freq"))


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of rows equal (on cols, default all) to an earlier row: rows - distinct."""
    cols = cols or df.columns
    g = df.groupBy(*_short_keys(df, cols)).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("long").alias("n_rows"),
                 F.count(F.lit(1)).alias("n_distinct"),
                 (F.sum("_c") - F.count(F.lit(1))).cast("long").alias("n_duplicates"))


def duplicated_on(df: DataFrame, subset: list[str], key: str) -> DataFrame:
    """Rows whose subset values appeared on a row with a smaller key (all but the first).

    The first key per subset comes from a partial aggregate, so a heavily repeated
    subset value is never gathered; the join back is skew-handled by AQE."""
    keyed = df.withColumn("_key", F.sha2(F.to_json(F.struct(*_short_keys(df, subset)), {"ignoreNullFields": "false"}), 256))
    first = keyed.groupBy("_key").agg(F.min(key).alias("_first"))
    return keyed.join(first, "_key").where(F.col(f"`{key}`") != F.col("_first")).select(*[F.col(f"`{c}`") for c in df.columns])


def _short_keys(df: DataFrame, cols: list[str]) -> list:
    """Grouping columns with texts replaced by a digest, so no whole text is a shuffle key."""
    return [F.sha2(F.col(f"`{c}`"), 256).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(f"`{c}`")
            for c in cols]


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.col(col)))


def constant_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: is it constant (exactly one distinct non-null value)?

    min == max over non-null values is exact and needs no distinct shuffle."""
    cols = cols or df.columns
    agg = df.agg(*[F.struct(F.min(F.col(f"`{c}`")).cast("string").alias("mn"),
                            F.max(F.col(f"`{c}`")).cast("string").alias("mx")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    pairs = [(c, F.col(f"c{i}")) for i, c in enumerate(cols)]
    s = agg.select(_stack(pairs, "column", "s").alias("kv"))
    return s.select("kv.column",
                    F.coalesce(F.col("kv.s.mn") == F.col("kv.s.mx"), F.lit(False)).alias("is_constant"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First n rows in an explicit order (top-k: sorts per partition, merges n per task)."""
    return df.orderBy(*order_by).limit(n)


def central_tendency(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    m = df.groupBy(*by).agg(F.avg(col).alias("mean"))
    q = exact_quantiles(df, by, col, {"median": 0.5}).drop("n")
    return m.join(q, by) if by else _one_row_join(m, q)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put two single-row global aggregates side by side."""
    return with_scalars(a, b)


def dispersion(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    m = df.groupBy(*by).agg(F.stddev_samp(col).alias("std"), F.var_samp(col).alias("var"))
    q = exact_quantiles(df, by, col, {"q1": 0.25, "q3": 0.75}).drop("n")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    return m.join(q, by) if by else _one_row_join(m, q)


def shape_stats(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Bias-adjusted skewness and excess kurtosis (pandas .skew()/.kurt())."""
    by = by or []
    n = F.count(F.col(col)).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.col(col)).alias("n"),
        adjusted_skew(n, F.skewness(col)).alias("skew"),
        adjusted_kurtosis(n, F.kurtosis(col)).alias("kurt"))


def histogram_by(df: DataFrame, x: str, hue: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram of x stacked by hue: (bin, lo, hi, hue, count)."""
    rng = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    j = with_scalars(df.where(F.col(x).isNotNull()).select(x, hue), rng)
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(x) - F.col("_mn")) / w), F.lit(bins - 1))).cast("int")
    return (j.select(b.alias("bin"), F.col(hue), "_mn", "_mx")
            .groupBy("bin", hue, "_mn", "_mx").agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / bins).alias("lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * (F.col("_mx") - F.col("_mn")) / bins).alias("hi"),
                    hue, "count"))


def box_stats(df: DataFrame, group: str, x: str, whisker: float = 1.5) -> DataFrame:
    """Per group: q1, median, q3, Tukey fences and the number of points outside them."""
    rs = running_sums(value_counts_by(df, [group], x), [group], x, ["cnt"])
    q = pick_quantiles(rs, [group], x, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = (q.withColumn("lower_fence", F.col("q1") - whisker * (F.col("q3") - F.col("q1")))
          .withColumn("upper_fence", F.col("q3") + whisker * (F.col("q3") - F.col("q1"))))
    # the stored value counts already say how many rows lie outside: no second read
    outside = (F.col(x) < F.col("lower_fence")) | (F.col(x) > F.col("upper_fence"))
    out = rs.select(group, x, "cnt").join(q.select(group, "lower_fence", "upper_fence"), group).groupBy(group).agg(
        F.coalesce(F.sum(F.when(outside, F.col("cnt"))), F.lit(0)).alias("n_outliers"))
    return q.join(out, group).select(group, "n", "q1", "median", "q3", "lower_fence", "upper_fence",
                                     "n_outliers")


def pairwise_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r and sample covariance for every column pair, one aggregate pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.struct(F.corr(a, b).alias("r"), F.covar_samp(a, b).alias("cov")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    kv = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                      F.col(f"p{i}.r").alias("corr"), F.col(f"p{i}.cov").alias("covar"))
                             for i, (a, b) in enumerate(pairs)])).alias("kv")
    return agg.select(kv).select("kv.*")


def group_values_topn(df: DataFrame, group: str, x: str, n: int) -> DataFrame:
    """The n largest values of x per group (with repeats), listed in descending order.

    Ranks come from range-partitioned running counts over distinct values, so a hot
    group is split across tasks; only the bounded n values per group are gathered."""
    vc = value_counts_by(df.select(group, (-F.col(x)).alias("_neg")), [group], "_neg")
    rs = running_sums(vc, [group], "_neg", ["cnt"]).where(F.col("cnt_before") < n)
    taken = rs.select(group, (-F.col("_neg")).alias("v"),
                      F.least(F.col("cnt"), F.lit(n) - F.col("cnt_before")).alias("take"))
    rep = taken.select(group, "v", F.explode(F.array_repeat(F.col("v"), F.col("take").cast("int"))).alias("_v"))
    return rep.groupBy(group).agg(F.sort_array(F.collect_list("_v"), asc=False).alias("top_values"))
