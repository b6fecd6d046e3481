"""Encoding, alignment and splitting.

Vocabulary: strings become ``col=value`` features, numbers keep their column
name, features sorted by name (dictionary-vectoriser convention).  The
vocabulary is model state and small (distinct categories), so it is the one
thing brought to the driver when wide columns or ML stages are built.

Splits are hash-based on a key column: reproducible under any partitioning
and on any engine that has md5, unlike ``randomSplit``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators.common import with_scalars
from tilth.operators.ordered import running_sums


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def vocabulary(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """(idx, feature, column, value) sorted by feature name; nulls add no feature."""
    parts = [df.select(F.lit(c).alias("column"), _c(c).cast("string").alias("value"))
             .where(F.col("value").isNotNull()).distinct() for c in categorical]
    cats = reduce(lambda a, b: a.unionByName(b), parts) if parts else None
    spark = df.sparkSession
    nums = spark.createDataFrame([(c, None) for c in numeric], "column string, value string") \
        if numeric else None
    allv = cats.unionByName(nums) if cats is not None and nums is not None else (cats or nums)
    allv = allv.withColumn("feature", F.when(F.col("value").isNull(), F.col("column"))
                           .otherwise(F.concat(F.col("column"), F.lit("="), F.col("value"))))
    ranked = running_sums(allv.withColumn("_one", F.lit(1).cast("long")), [], "feature", ["_one"])
    return ranked.join(allv, "feature").select(
        F.col("_one_before").cast("int").alias("idx"), "feature", "column", "value")


MAX_WIDE_FEATURES = 10_000


def learn_vocabulary(df: DataFrame, categorical: list[str], numeric: list[str],
                     max_features: int = MAX_WIDE_FEATURES) -> list[tuple]:
    """The vocabulary as model state on the driver (as a fitted encoder keeps it): the
    distinct (column, value) pairs are found by Spark, then numbered in name order.

    Only for dense (wide) encodings of few categories: at most ``max_features + 1``
    pairs are ever fetched, and a larger vocabulary raises.  High-cardinality columns
    go through ``vocabulary`` + ``encode_long`` (joined, never collected) or
    ``ml_encoder`` (sparse vectors)."""
    parts = [df.select(F.lit(c).alias("column"), _c(c).cast("string").alias("value"))
             .where(F.col("value").isNotNull()) for c in categorical]
    room = max_features - len(numeric)
    pairs = (reduce(lambda a, b: a.unionByName(b), parts).distinct().limit(room + 1).collect()
             if parts else [])
    if len(pairs) > room:
        raise ValueError(f"vocabulary exceeds {max_features} features; use vocabulary() with "
                         "encode_long() or ml_encoder() for high-cardinality columns")
    feats = [(f"{r['column']}={r['value']}", r["column"], r["value"]) for r in pairs]
    feats += [(c, c, None) for c in numeric]
    return [(i, f, c, v) for i, (f, c, v) in enumerate(sorted(feats, key=lambda t: t[0]))]


def encode_wide(df: DataFrame, vocab: list[tuple], keep: list[str]) -> DataFrame:
    """Dense one-hot columns named after the features; unseen categories -> all zeros."""
    cols = []
    for _, feature, column, value in vocab:
        if value is None:
            cols.append(F.coalesce(_c(column).cast("double"), F.lit(0.0)).alias(feature))
        else:
            cols.append(F.coalesce((_c(column).cast("string") == F.lit(value)).cast("int"),
                                   F.lit(0)).alias(feature))
    return df.select(*[_c(k) for k in keep], *cols)


def encode_long(df: DataFrame, vocab: DataFrame, key: str, categorical: list[str],
                numeric: list[str]) -> DataFrame:
    """Sparse encoding as (key, idx, feature, value) for non-zero entries only.

    The vocabulary is joined, not collected; unseen categories find no match and
    so encode as zeros (no entry)."""
    pairs = ([F.struct(F.lit(c).alias("column"), F.concat(F.lit(c + "="), _c(c).cast("string")).alias("feature"),
                       F.lit(1.0).alias("value")) for c in categorical]
             + [F.struct(F.lit(c).alias("column"), F.lit(c).alias("feature"),
                         _c(c).cast("double").alias("value")) for c in numeric])
    long = df.select(_c(key), F.explode(F.array(*pairs)).alias("kv")).select(key, "kv.feature", "kv.value")
    long = long.where(F.col("feature").isNotNull() & F.col("value").isNotNull() & (F.col("value") != 0))
    return long.join(vocab.select("idx", "feature"), "feature").select(key, "idx", "feature", "value")


def vocabulary_mismatch(train_vocab: DataFrame, new_vocab: DataFrame) -> DataFrame:
    """Features present on one side only, by name (both directions)."""
    return mismatch(train_vocab.select("feature"), new_vocab.select("feature"))


def mismatch(train_features: DataFrame, new_features: DataFrame) -> DataFrame:
    """The same from two tables of distinct feature names: one full outer join."""
    a = train_features.select("feature", F.lit(1).alias("_train"))
    b = new_features.select("feature", F.lit(1).alias("_new"))
    j = a.join(b, "feature", "full").where(F.col("_train").isNull() | F.col("_new").isNull())
    return j.select("feature", F.when(F.col("_new").isNull(), "only_train").otherwise("only_new").alias("side"))


def feature_names(df: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """The distinct feature names of a table, without numbering them: one pass."""
    parts = [F.when(_c(c).isNotNull(), F.concat(F.lit(f"{c}="), _c(c).cast("string"))) for c in categorical]
    names = F.explode(F.array_compact(F.array(*parts, *[F.lit(c) for c in numeric]))).alias("feature")
    return df.select(names).distinct()


def align_intersect(df: DataFrame, reference_cols: list[str]) -> DataFrame:
    """Keep the columns of df that also exist in the reference, in reference order."""
    return df.select(*[_c(c) for c in reference_cols if c in df.columns])


def align_pad(*dfs: DataFrame, fill=0) -> DataFrame:
    """Union by name; columns a side lacks are filled on that side, so true nulls of the
    side that has them stay null."""
    types = {f.name: f.dataType for d in reversed(dfs) for f in d.schema.fields}
    padded = [d.withColumns({c: F.lit(fill).cast(t) for c, t in types.items() if c not in d.columns}) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b), padded)


def hash_unit(key: Column, seed: int) -> Column:
    """Uniform [0, 1) number from md5(seed:key); same value in Spark and DuckDB."""
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8)
    return F.conv(h, 16, 10).cast("double") / float(2 ** 32)


def split_label(key: Column, test_size: float = 0.2, val_size: float = 0.25, seed: int = 42) -> Column:
    """test with share test_size, then val_size of the rest, then train (60/20/20 default)."""
    u = hash_unit(key, seed)
    return (F.when(u < test_size, "test")
            .when(u < test_size + (1 - test_size) * val_size, "val").otherwise("train"))


def split(df: DataFrame, key: str, test_size: float = 0.2, val_size: float = 0.25,
          seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_label(_c(key), test_size, val_size, seed))


def split_exact(df: DataFrame, key: str, test_size: float = 0.2, val_size: float = 0.25,
                seed: int = 42) -> DataFrame:
    """Exact counts: test = ceil(n * test_size), val = ceil(rest * val_size), in md5 order.

    Positions come from range-partitioned running counts, not a global window.  Rows
    sharing a key share the position of the first of them (rank semantics), so the
    result is deterministic even when keys repeat."""
    order = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))), F.lit(":"),
                     _c(key).cast("string"))
    with_ord = df.withColumn("_ord", order)
    counts = with_ord.groupBy("_ord").agg(F.count(F.lit(1)).alias("_one"))
    rs = running_sums(counts, [], "_ord", ["_one"])
    n = F.col("_one_total")
    n_test = F.ceil(n * test_size)
    n_val = F.ceil((n - n_test) * val_size)
    pos = F.col("_one_before")
    # the last position of test and of val; rows are then labelled by comparison alone
    cuts = rs.agg(F.max(F.when(pos < n_test, F.col("_ord"))).alias("_test_to"),
                  F.max(F.when(pos < n_test + n_val, F.col("_ord"))).alias("_val_to"))
    lab = F.when(F.col("_ord") <= F.col("_test_to"), "test").when(F.col("_ord") <= F.col("_val_to"), "val").otherwise("train")
    return with_scalars(with_ord, cuts).withColumn("split", lab).drop("_ord", "_test_to", "_val_to")


def split_report(df: DataFrame, split_col: str = "split") -> DataFrame:
    g = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    return with_scalars(g, tot).select(split_col, "n", (F.col("n") / F.col("_t")).alias("share"))


def standardize(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """(x - mean) / population std; a constant column gets scale 1."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"_s_{i}") for i, c in enumerate(cols)])
    j = with_scalars(df, stats)
    scale = lambda i: F.when(F.col(f"_s_{i}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{i}"))
    return j.select(*[_c(k) for k in keep],
                    *[((_c(c) - F.col(f"_m_{i}")) / scale(i)).alias(c) for i, c in enumerate(cols)])


def ml_encoder(categorical: list[str], numeric: list[str], output: str = "features") -> Pipeline:
    """Production encoder: alphabetical string indexing (unseen kept as the last index),
    one-hot with the last slot dropped (so unseen encodes as all zeros), assembled with
    the numeric columns into one sparse vector."""
    # one multi-column indexer: all vocabularies are learned in a single pass
    idx = ([StringIndexer(inputCols=list(categorical), outputCols=[f"_{c}_idx" for c in categorical],
                          handleInvalid="keep", stringOrderType="alphabetAsc")] if categorical else [])
    ohe = OneHotEncoder(inputCols=[f"_{c}_idx" for c in categorical],
                        outputCols=[f"_{c}_ohe" for c in categorical], dropLast=True)
    asm = VectorAssembler(inputCols=[f"_{c}_ohe" for c in categorical] + numeric,
                          outputCol=output, handleInvalid="keep")
    return Pipeline(stages=idx + ([ohe] if categorical else []) + [asm])
