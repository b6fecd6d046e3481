"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order.  A document's virtual finish time is
the number of tokens its source has served up to its end, divided by the source's target;
a source that needs more than it has is served again, up to ``max_epochs`` times.  All
sources progress at their targets, so the total budget is used up at one moment of
virtual time, when each source has served its target.  The cut at that moment, inside the
documents being served, is therefore taken in closed form from each source's own totals;
the global range sort by the finish time of the first copy only orders the output.

Running totals stay spread: a source is cut by shuffle hash into buckets of some
thousand documents, a window runs inside a bucket, and the bucket's start comes from a
table with a row for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.llm.common import materialize, words

DOCS_PER_BUCKET = 1024
HASH_BITS = 40


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """A number below 2**40 from an md5 of seed and id (of the text where there is no id)."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))
    digest = F.md5(F.concat(F.lit(seed + ":"), named))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def bucket_of(key: Column, n_buckets: int) -> Column:
    """Which of ``n_buckets`` equal parts of the key's range a key lies in.  The top 24 bits
    decide, so the product stays below 2**63 up to 2**39 buckets (5 * 10**14 documents)."""
    return F.shiftright(F.shiftright(key, HASH_BITS - 24) * F.lit(n_buckets).cast("long"), 24)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all
    sizes; a target stops at ``max_epochs`` times its source's size and the excess is
    reshared by weight until none is above.  That end state is found at once: order the
    sources by size per weight, and cap those for which the share of the rest, per
    weight, exceeds their limit.  The table has a row for each source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", w.cast("long"))
    limit = (F.col("source_size") * max_epochs).cast("long")
    earlier = Window.orderBy((limit / F.col("weight")), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(
        F.col("source").asc_nulls_last())
    filled = weighed.select(
        "*", limit.alias("__limit"),
        (F.sum("source_size").over(everything)
         - F.coalesce(F.sum(limit).over(earlier), F.lit(0))).alias("__left"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("__weights_left"))
    # capped while the limit is at or below left * weight / weights_left (whole numbers: exact)
    big = "decimal(19,0)"
    filled = filled.withColumn("__capped", F.col("__left").cast(big) * F.col("weight").cast(big)
                               >= F.col("__limit").cast(big) * F.col("__weights_left").cast(big))
    uncapped = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("weight")
    level = filled.select(
        "*",
        F.max(F.when(~F.col("__capped"), F.col("__left"))).over(uncapped).alias("__share"),
        F.max(F.when(~F.col("__capped"), F.col("__weights_left"))).over(uncapped).alias("__share_weights"))
    return level.select(
        "source", "source_size", "weight",
        F.when(F.col("__capped"), F.col("__limit").cast("double"))
         .otherwise(F.col("__share").cast("double") * F.col("weight") / F.col("__share_weights")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                seed: str = "mix", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document, sorted over all sources by virtual finish time:
    doc_id, source, size, source_size, target, shuffle_key, virtual_finish, taken.

    ``taken`` counts the words of all copies that the mix takes: whole copies up to the
    cut, and at the cut the part that still fits.  Each source's taken words are its
    target, rounded down.  ``virtual_finish`` is the end of the first copy.

    Defined results: null text has size 0 and is never taken; null is a source of its
    own, the last; rows with one doc_id are separate documents in the queue, ties stand
    by size; reruns agree, because the order hangs on md5 of seed and id alone; an empty
    table gives an empty table; only doc_id, source and text are read."""
    source = F.col(source_col)
    sized = materialize(docs.select(
        "doc_id", source.alias("source"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__row"),
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("v"), source)).alias("__src"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        shuffle_key(F.col("doc_id"), F.col(text_col), seed).alias("shuffle_key")))
    n_buckets = max(1, sized.count() // DOCS_PER_BUCKET)
    bucketed = sized.withColumn("__bucket", bucket_of(F.col("shuffle_key"), n_buckets))
    sums = bucketed.groupBy("__src", "source", "__bucket").agg(F.sum("size").alias("__sum"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("__sum").alias("source_size")), weights, max_epochs)
    targets = targets.select(
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source")).alias("__src"),
        "source_size", "target")
    before = Window.partitionBy("__src").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__src", "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    queue = bucketed.join(starts.join(targets, "__src"), ["__src", "__bucket"])
    inside = Window.partitionBy("__src", "__bucket").orderBy("shuffle_key", "doc_id", "size", "__row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    queue = queue.withColumn("__end", F.col("__start") + F.sum("size").over(inside))
    budget = F.floor("target")
    cut = [F.greatest(F.lit(0), F.least(F.col("size"), budget - (F.lit(e) * F.col("source_size")
                                                                 + F.col("__end") - F.col("size"))))
           for e in range(max_epochs)]
    return queue.select(
        "doc_id", "source", "size", "source_size", "target", "shuffle_key", "__row",
        F.when(F.col("target") > 0, F.col("__end") / F.col("target")).otherwise(0.0).alias("virtual_finish"),
        sum(cut[1:], cut[0]).cast("long").alias("taken")).orderBy("virtual_finish", "source", "shuffle_key")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes something of, with size, source_size, target, taken and
    virtual_finish beside their own columns (own columns of those names are replaced).

    Texts join the plan by id and text hash; rows repeating both come out as one row with
    all the words taken of them."""
    added = ["size", "source_size", "target", "virtual_finish", "taken"]
    plan = mix_sources(docs, **options).groupBy(F.col("doc_id").alias("__id"), F.col("__row").alias("__of")).agg(
        *[F.min(c).alias(c) for c in added[:4]], F.sum("taken").alias("taken")).where(F.col("taken") > 0)
    own = docs.drop(*added).withColumn("__row", F.xxhash64(F.coalesce(F.col(options.get("text_col", "text")), F.lit(""))))
    joined = own.join(plan, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__of")))
    once = joined.dropDuplicates(["__id", "__of"])
    return once.select(*[c for c in own.columns if c != "__row"], *added)
