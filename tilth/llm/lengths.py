"""Token counts as an exact length histogram.

Documents are encoded once; what is kept is how many documents have each length.  Suffix
sums over the histogram answer every question about a context limit: how many documents
reach it, how many tokens they have, what remains when each is truncated to it, and which
length a quantile falls on.

The suffix sums are built in two levels (``SPAN`` lengths to a block), so neither level
gathers the histogram in one task, however long the longest document is.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import materialize
from tilth.llm.tokens import VOCABULARY, encoding, ship_vocabulary

SPAN = 1024


_LONG_BLANK = 1000
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % _LONG_BLANK)


def count_tokens(enc, text: str) -> int:
    """Length of the encoded text.

    The vocabulary's pattern takes a run of white space as one piece, all but its last
    character if a word follows, by stepping back from the run's end; on a very long run its
    engine runs out of stack.  Such runs are cut out here: what stands before the run, the
    run less the character that the pattern leaves to what follows, and the rest with that
    character are the pieces it would have made."""
    n, at = 0, 0
    for run in _BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        n += len(enc.encode_ordinary(text[at:run.start()])) + len(enc._encode_single_piece(text[run.start():end].encode()))
        at = end
    return n + len(enc.encode_ordinary(text[at:]))


def _lengths(shipped, schema: pa.Schema):
    def run(batches):
        enc = encoding(shipped)
        for batch in batches:
            n = [count_tokens(enc, t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], schema=schema)
    return run


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every document; null text has no tokens."""
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType())])
    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(
        _lengths(ship_vocabulary(docs.sparkSession, vocabulary), to_arrow_schema(out)), out)


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs: ``n_tokens``, ``n_docs``, and with it as a limit

    * ``docs_reaching`` / ``tokens_reaching``: documents of at least that length, their tokens;
    * ``docs_within`` / ``tokens_within``: documents of at most that length, their tokens;
    * ``truncated_total``: tokens left when every document is cut to that length.

    Defined results: rows without a length are left out; repeated rows each count; an empty
    table gives an empty table."""
    # stored: the blocks and the final join both read it, and the texts are encoded once
    hist = materialize(lengths.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))
    hist = hist.withColumn("__block", F.floor(F.col("n_tokens") / SPAN))
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = hist.groupBy("__block").agg(F.sum("n_docs").alias("__d"), F.sum(tokens).alias("__t"))
    later = Window.orderBy(F.desc("__block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "__block", F.coalesce(F.sum("__d").over(later), F.lit(0)).alias("__d"),
        F.coalesce(F.sum("__t").over(later), F.lit(0)).alias("__t"),
        F.sum("__d").over(every).alias("__all_d"), F.sum("__t").over(every).alias("__all_t"))
    inside = Window.partitionBy("__block").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = hist.join(blocks, "__block").select(
        "n_tokens", "n_docs", "__all_d", "__all_t",
        (F.col("__d") + F.sum("n_docs").over(inside)).alias("docs_reaching"),
        (F.col("__t") + F.sum(tokens).over(inside)).alias("tokens_reaching"))
    return out.select(
        "n_tokens", "n_docs", "docs_reaching", "tokens_reaching",
        (F.col("__all_d") - F.col("docs_reaching") + F.col("n_docs")).alias("docs_within"),
        (F.col("__all_t") - F.col("tokens_reaching") + tokens).alias("tokens_within"),
        (F.col("__all_t") - F.col("tokens_reaching") + F.col("n_tokens") * F.col("docs_reaching")).alias("truncated_total"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total, n_truncated) for any limits: one pass over the
    histogram, for every limit a sum of lengths cut at it."""
    lim = F.explode(F.array(*[F.lit(x).cast("long") for x in sorted(set(limits))])).alias("context_limit")
    return hist.select("n_tokens", "n_docs", lim).groupBy("context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_total"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("n_truncated"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length such that at least that share of the documents
    are no longer."""
    row = F.col("docs_within") >= F.col("share") * (F.col("docs_within") + F.col("docs_reaching") - F.col("n_docs"))
    s = F.explode(F.array(*[F.lit(float(x)) for x in sorted(set(shares))])).alias("share")
    return hist.select("*", s).where(row).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
