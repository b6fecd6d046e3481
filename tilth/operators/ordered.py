"""Ordered running sums that stay distributed when one group is huge.

Exact quantiles, mid-ranks, empirical CDFs (KS, Wasserstein) and rank-capped
listings all need "how many rows of this group come before value v".  A window
``PARTITION BY group ORDER BY value`` would send a whole group to one task, so
a group holding a third of the data would sit in a single task.  Instead:

1. callers pre-aggregate to one row per (group, value) with counts (map-side
   combine, so duplicated values never travel twice); that table is stored once;
2. its values are cut into ranges of about ``ROWS_PER_RANGE`` rows, the same for all
   groups, so a hot group is spread over many ranges: numbers and times at approximate
   quantiles (at most ``MAX_RANGES`` reach the driver); text, and tables that need more
   ranges, by Spark's range partitioning on the whole value, whose result is stored;
3. a window over (group, range) gives the sums inside a range, and a table with a
   row for each (group, range) gives every range its offset.

Everything runs in the JVM.  The cuts only spread the work: any cuts give the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.session import materialize

ROWS_PER_RANGE = 100_000
MAX_RANGES = 1000

_RANGE = "_rs_range"


def _code(df: DataFrame, c: str) -> Column:
    """A number that never falls where the column rises."""
    kind, col = df.schema[c].dataType, F.col(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def with_ranges(df: DataFrame, order_col: str) -> tuple[DataFrame, int]:
    """Add the number of the row's range; also the number of ranges."""
    wanted = df.count() // ROWS_PER_RANGE
    if wanted < 2:
        return df.withColumn(_RANGE, F.lit(0.0)), 1
    if wanted > MAX_RANGES or isinstance(df.schema[order_col].dataType, T.StringType):
        # equal values share a partition, partitions rise with the value; stored, so that a
        # task that runs again cannot deal other ranges
        spread = df.repartitionByRange(wanted, order_col).withColumn(_RANGE, F.spark_partition_id().cast("double"))
        return materialize(spread), wanted
    coded = df.withColumn("_rs_code", _code(df, order_col))
    cuts = coded.agg(F.percentile_approx("_rs_code", [i / wanted for i in range(1, wanted)], 20 * wanted)).first()[0]
    inner = sorted({x for x in cuts if abs(x) != float("inf")})
    if not inner:
        return df.withColumn(_RANGE, F.lit(0.0)), 1
    cutter = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="_rs_code", outputCol=_RANGE)
    return cutter.transform(coded).drop("_rs_code"), len(inner) + 1


def running_sums(df: DataFrame, group_cols: list[str], order_col: str,
                 sum_cols: list[str]) -> DataFrame:
    """For a table distinct on (group_cols, order_col) with non-null order values, add
    ``<c>_before`` (sum of c over smaller values in the group), ``<c>_total`` (group
    total) and ``prev_<order_col>`` (previous distinct value in the group, null first)."""
    groups, sums = list(group_cols), list(sum_cols)
    stored = materialize(df.select(*groups, order_col, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in sums]))
    base, n_ranges = with_ranges(stored, order_col)
    inside = Window.partitionBy(*groups, _RANGE).orderBy(order_col)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = base.select(
        "*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c + "_before") for c in sums],
        F.lag(order_col).over(inside).alias("prev_" + order_col))
    keep = [*groups, order_col, *sums]
    prev = F.col("prev_" + order_col)
    if n_ranges == 1:
        whole = Window.partitionBy(*groups, _RANGE)
        return local.select(*keep, *[c + "_before" for c in sums],
                            *[F.sum(c).over(whole).alias(c + "_total") for c in sums], prev)
    per_range = base.groupBy(*groups, _RANGE).agg(
        *[F.sum(c).alias("_s_" + c) for c in sums], F.max(order_col).alias("_last"))
    ahead = Window.partitionBy(*groups).orderBy(_RANGE)
    w_all = Window.partitionBy(*groups)
    offsets = per_range.select(
        F.col(_RANGE).alias("_o_range"), *[F.col(g).alias("_o_" + g) for g in groups],
        *[F.coalesce(F.sum("_s_" + c).over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off_" + c)
          for c in sums],
        *[F.sum("_s_" + c).over(w_all).alias(c + "_total") for c in sums],
        F.lag("_last").over(ahead).alias("_last_before"))
    same = reduce(lambda a, b: a & b, [F.col(_RANGE) == F.col("_o_range")]
                  + [F.col(g).eqNullSafe(F.col("_o_" + g)) for g in groups])
    return local.join(offsets, same).select(
        *keep, *[(F.col(c + "_before") + F.col("_off_" + c)).alias(c + "_before") for c in sums],
        *[c + "_total" for c in sums], F.coalesce(prev, F.col("_last_before")).alias("prev_" + order_col))


def value_counts_by(df: DataFrame, group_cols: list[str], value_col: str,
                    count_col: str = "cnt") -> DataFrame:
    """One row per (group, non-null value) with its multiplicity (map-side combined)."""
    v = F.col(value_col)
    cond = v.isNotNull()
    if isinstance(df.schema[value_col].dataType, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(v)
    return df.where(cond).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias(count_col))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: dict[str, float]) -> DataFrame:
    """Exact linearly interpolated quantiles (pandas/NumPy 'linear', Spark ``percentile``)
    per group, without gathering a group into one task.  Also returns ``n``."""
    vc = value_counts_by(df, group_cols, value_col)
    rs = running_sums(vc, group_cols, value_col, ["cnt"])
    return pick_quantiles(rs, group_cols, value_col, probs)


def pick_quantiles(rs: DataFrame, group_cols: list[str], value_col: str,
                   probs: dict[str, float]) -> DataFrame:
    """Quantiles from a running-count table (``running_sums`` over value counts with
    ``cnt``): only the rows holding ranks floor(h) and floor(h)+1 are kept."""
    n = F.col("cnt_total")
    lo_hit, hi_hit, aggs = [], [], []
    for name, p in probs.items():
        h = (n - 1) * F.lit(float(p))
        k = F.floor(h)
        k1 = F.least(k + 1, n - 1)
        lo = (F.col("cnt_before") <= k) & (k < F.col("cnt_before") + F.col("cnt"))
        hi = (F.col("cnt_before") <= k1) & (k1 < F.col("cnt_before") + F.col("cnt"))
        lo_hit.append(lo)
        hi_hit.append(hi)
        aggs += [F.max(F.when(lo, F.col(value_col))).alias("_lo_" + name),
                 F.max(F.when(hi, F.col(value_col))).alias("_hi_" + name),
                 F.max(h - k).alias("_fr_" + name)]
    keep = reduce(lambda a, b: a | b, lo_hit + hi_hit)
    picked = rs.where(keep).groupBy(*group_cols).agg(F.max("cnt_total").alias("n"), *aggs)
    return picked.select(
        *group_cols, "n",
        *[(F.col("_lo_" + m).cast("double")
           + F.col("_fr_" + m) * (F.col("_hi_" + m).cast("double") - F.col("_lo_" + m).cast("double"))
           ).alias(m) for m in probs])


def midranks(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """Mid-rank of every distinct value inside each group (ties share the average rank).

    Returns group_cols, value, cnt, midrank, n (group size)."""
    return midranks_of_counts(value_counts_by(df, group_cols, value_col), group_cols, value_col)


def midranks_of_counts(counts: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """The same from a table of counts (``cnt``) of each (group, value)."""
    rs = running_sums(counts, group_cols, value_col, ["cnt"])
    return rs.select(*group_cols, value_col, "cnt",
                     (F.col("cnt_before") + (F.col("cnt") + 1) / 2.0).alias("midrank"),
                     F.col("cnt_total").alias("n"))
