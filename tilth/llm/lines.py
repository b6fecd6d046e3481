"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble.

The texts themselves are shuffled once, to meet the places of their dropped lines; what
is counted and joined is a hash, an id and a place for each line.  A line that a third of
all documents hold is pre-aggregated on the map side and, in the join, is a skewed key
that adaptive execution splits: its side of the join is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import ASCII_SPACE, ascii_lower, let, materialize


def _key_hash(key: Column) -> list[Column]:
    """96 bits of a line key: at a trillion distinct lines a chance match stays unlikely."""
    return [F.xxhash64(key).alias("__h"), F.hash(key).alias("__g")]


def exploded_lines(docs: DataFrame, min_chars: int, text_col: str = "text") -> DataFrame:
    """(doc_id, __row, __pos, __h, __g) of each line whose key has ``min_chars`` code points.
    ``__row`` is a hash of the text, so that rows repeating a doc_id keep their own places."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("__row"),
                        F.posexplode(F.split(ascii_lower(text), "\n")).alias("__pos", "__line"))
    key = F.btrim(F.col("__line"), F.lit(ASCII_SPACE))
    return lines.select("doc_id", "__row", "__pos", key.alias("__key")).where(
        F.char_length("__key") >= min_chars).select("doc_id", "__row", "__pos", *_key_hash(F.col("__key")))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The keys found in at least ``min_docs`` documents, with the smallest doc_id.

    Two documents differ exactly if the least and the greatest id differ, so the usual
    threshold needs no distinct count; rows without an id count as one document."""
    one_more = F.max(F.col("doc_id").isNull().cast("int"))
    least, most = F.min("doc_id"), F.max("doc_id")
    if min_docs <= 2:
        n = F.when(least.isNull(), 0).when(least == most, 1).otherwise(2) + one_more
    else:
        n = F.count_distinct("doc_id") + one_more
    counted = lines.groupBy("__h", "__g").agg(least.alias("__keeper"), n.alias("__n_docs"))
    return counted.where(F.col("__n_docs") >= min_docs).select("__h", "__g", "__keeper")


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, text_col: str = "text") -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` (long) and ``kept_text``.

    A line's key is the line without ASCII space at both ends, A-Z lower-cased.  Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines except in the smallest doc_id that holds them (there every line stays).

    Defined results: null or empty text is one empty line, and stays one; rows with one
    doc_id are one document; rows without doc_id are together one document, after all
    others; an empty table gives an empty table; input columns named like the three
    outputs are replaced."""
    lines = exploded_lines(docs, min_chars, text_col)
    # stored, so that both sides of the join are dealt anew and a very common line's rows
    # (a skewed key with one row on the other side) can be split over tasks
    keys = materialize(repeated_lines(lines, min_docs))
    mine = F.col("doc_id").eqNullSafe(F.col("__keeper"))
    drops = (lines.join(keys, ["__h", "__g"]).where(~mine)
             .groupBy(F.col("doc_id").alias("__id"), F.col("__row").alias("__of"))
             .agg(F.collect_set("__pos").alias("__drop")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.drop("n_lines", "n_dropped", "kept_text").withColumn("__row", F.xxhash64(text))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__of")), "left")
    drop = F.coalesce(F.col("__drop"), F.array().cast("array<int>"))

    def kept(parts: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), drop)
        return F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")

    return joined.select(
        *[F.col(c) for c in rows.columns if c != "__row"],
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.size(drop).cast("long").alias("n_dropped"),
        F.when(F.size(drop) == 0, text).otherwise(let(F.split(text, "\n"), kept)).alias("kept_text"))


def replace_with_kept(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The documents with their remaining lines as text and their new length."""
    out = dedup_lines(docs, min_chars, min_docs).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
