"""Projection, filters and cleaning.

Row identity is an explicit key column: removing rows "by index" is a
``left_anti`` join on that key, and renumbering uses distributed running counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tilth.operators.common import with_scalars
from tilth.operators.ordered import exact_quantiles, running_sums
from tilth.session import materialize

# Tokens read as missing when a CSV is loaded (pandas' default NA set).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column subset in the given order; a missing column raises AnalysisException."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise AnalysisException(f"columns not found: {missing}")
    return df.select(*[_c(c) for c in cols])


def normalized_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case names and replace spaces with underscores; refuse collisions."""
    new = [normalized_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"normalised column names collide: {new}")
    return df.toDF(*new)


def drop_null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def fill_null(df: DataFrame, col: str, value) -> DataFrame:
    return df.fillna({col: value})


def fill_row_when_null(df: DataFrame, trigger: str, value: str) -> DataFrame:
    """On rows whose trigger column is null, fill every null string column with value."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    hit = _c(trigger).isNull()
    return df.select(*[F.when(hit, F.coalesce(_c(c), F.lit(value))).otherwise(_c(c)).alias(c)
                       if c in strings else _c(c) for c in df.columns])


def filter_label(df: DataFrame, col: str, label) -> DataFrame:
    return df.where(_c(col) == F.lit(label))


def double_text(c: Column) -> Column:
    """Every digit of a double's shortest text, without exponent: 2.0 -> '2.0', 1e-7 ->
    '0.0000001', 1e20 -> '100000000000000000000.0'.  NaN and infinities keep their names."""
    text = c.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    whole = F.regexp_extract(text, r"^-?(\d+)\.(\d+)E(-?\d+)$", 1)
    part = F.regexp_replace(F.regexp_extract(text, r"^-?(\d+)\.(\d+)E(-?\d+)$", 2), "0+$", "")
    power = F.regexp_extract(text, r"^-?(\d+)\.(\d+)E(-?\d+)$", 3).try_cast("int")
    digits = F.concat(whole, part)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    point = F.char_length(whole) + power
    large = F.concat(F.rpad(digits, F.greatest(point, F.char_length(digits)), F.lit("0")), F.lit("."))
    large = F.when(F.char_length(digits) <= point, F.concat(large, F.lit("0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.char_length(digits))))
    return F.when(~text.contains("E"), text).when(power < 0, F.concat(sign, small)).otherwise(F.concat(sign, large))


def recast_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Make numeric columns categorical by turning them into text."""
    out = df
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
            out = out.withColumn(c, double_text(_c(c).cast("double")))
        else:
            out = out.withColumn(c, _c(c).cast("string"))
    return out


def iqr_outliers(df: DataFrame, target: str, variable: str, labels: list,
                 whisker: float = 1.5) -> DataFrame:
    """Rows of the given segments whose target lies strictly outside the Tukey fences
    of their own segment.  All segments are handled in one pass; the fence table has
    one row per requested label, so broadcasting it is bounded by the argument."""
    j = df.where(_c(variable).isin(list(labels))).join(
        F.broadcast(_fences(df, target, variable, labels, whisker)), _c(variable) == F.col("_seg"))
    return j.where((_c(target) < F.col("_lo")) | (_c(target) > F.col("_hi"))).select(*[_c(c) for c in df.columns])


def drop_iqr_outliers(df: DataFrame, target: str, variable: str, labels: list, whisker: float = 1.5) -> DataFrame:
    """The rows ``iqr_outliers`` would not return: judged by the joined fence, map-only."""
    fences = F.broadcast(_fences(df, target, variable, labels, whisker))
    outside = (_c(target) < F.col("_lo")) | (_c(target) > F.col("_hi"))
    return df.join(fences, _c(variable) == F.col("_seg"), "left").where(
        ~F.coalesce(outside, F.lit(False))).select(*[_c(c) for c in df.columns])


def _fences(df: DataFrame, target: str, variable: str, labels: list, whisker: float) -> DataFrame:
    seg = df.where(_c(variable).isin(list(labels)))
    q = exact_quantiles(seg, [variable], target, {"_q1": 0.25, "_q3": 0.75})
    return q.select(
        _c(variable).alias("_seg"),
        (F.col("_q1") - whisker * (F.col("_q3") - F.col("_q1"))).alias("_lo"),
        (F.col("_q3") + whisker * (F.col("_q3") - F.col("_q1"))).alias("_hi"))


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def remove_rows(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Drop rows by identity: anti join on the key column."""
    return df.join(rows.select(_c(key)).distinct(), key, "left_anti")


def renumber(df: DataFrame, order_cols: str | list[str], name: str = "row_idx") -> DataFrame:
    """Dense 0-based row numbers without a global window; every row stays once.

    Rows stand by ``order_cols`` (NaN after the numbers, nulls last), rows equal in all of them
    by a hash of the whole row; rows equal in everything are interchangeable.  Each column is
    one level of running counts over distinct values inside the ties of the columns before
    it, so neither the table nor a tie that holds a third of it lands in one task.  Levels end
    where no ties are left."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    hashed = df.withColumn("_row", F.xxhash64(*[_c(c) for c in df.columns])).withColumn("_task", F.spark_partition_id())
    rows = materialize(hashed.withColumn(name, F.lit(0).cast("long")))
    for depth, c in enumerate([*cols, "_row"]):
        rows = _add_level(rows, [*cols, "_row"][:depth], c, name)
        counts = rows.groupBy(*[_c(x) for x in [*cols, "_row"][:depth + 1]]).agg(F.count(F.lit(1)).alias("n"))
        if not counts.where("n > 1").limit(1).count():
            return rows.drop("_row", "_task")
    same = [_c(x) for x in [*cols, "_row"]]
    per_task = rows.groupBy(*[*same, "_task"]).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*same).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select(*same, "_task", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    own = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*same, "_task").orderBy("_task")) - 1)
    out = _null_safe_join(own, starts, [*cols, "_row", "_task"], "_start")
    return out.withColumn(name, F.col(name) + F.col("_start") + F.col("_nth")).drop("_row", "_task", "_start", "_nth")


def _null_safe_join(rows: DataFrame, table: DataFrame, on: list[str], value: str) -> DataFrame:
    other = table.select(*[_c(c).alias(f"_on{i}") for i, c in enumerate(on)], value)
    same = reduce(lambda a, b: a & b, [_c(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)])
    return rows.join(other, same).drop(*[f"_on{i}" for i in range(len(on))])


def _add_level(rows: DataFrame, above: list[str], c: str, name: str) -> DataFrame:
    """Add to ``name`` how many rows of the same ``above`` have a smaller ``c``."""
    nan = F.isnan(_c(c)) if isinstance(rows.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.lit(False)
    kind = F.when(_c(c).isNull(), 2).when(nan, 1).otherwise(0)
    groups = [f"_g{i}" for i in range(len(above))]
    counts = materialize(rows.groupBy(*[_c(x).alias(g) for x, g in zip(above, groups, strict=True)], _c(c).alias("_v"), kind.alias("_kind"))
                         .agg(F.count(F.lit(1)).alias("_n")))
    plain = running_sums(counts.where("_kind = 0").select(*groups, "_v", "_n"), groups, "_v", ["_n"]).select(
        *groups, "_v", F.col("_n_before").alias("_before"))
    totals = counts.groupBy(*groups).agg(F.sum(F.when(F.col("_kind") == 0, F.col("_n")).otherwise(0)).alias("_t0"),
                                         F.sum(F.when(F.col("_kind") < 2, F.col("_n")).otherwise(0)).alias("_t1"))
    odd = counts.where("_kind > 0")
    if groups:
        odd = odd.join(totals.select(*[F.col(g).alias("t" + g) for g in groups], "_t0", "_t1"),
                       reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col("t" + g)) for g in groups]))
    else:
        odd = with_scalars(odd, totals)
    last = odd.select(*groups, "_v", F.when(F.col("_kind") == 1, F.col("_t0")).otherwise(F.col("_t1")).alias("_before"))
    offsets = plain.unionByName(last).select(*[F.col(g).alias(x) for g, x in zip(groups, above, strict=True)], F.col("_v").alias(c), "_before")
    out = _null_safe_join(rows, offsets, [*above, c], "_before")
    return out.withColumn(name, F.col(name) + F.col("_before")).drop("_before")
