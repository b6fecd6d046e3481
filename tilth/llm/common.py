"""Helpers shared by the text operators: word splitting, ASCII folding, table access.

Conventions of all operators here
---------------------------------
* A null text counts as a text without words (each operator says what it returns).
* Columns an operator adds replace input columns of the same name; other input
  columns are left alone.  Internal columns start with ``__``.
* Rows repeated with one ``doc_id`` are the same document; each row still gets
  its own result row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilth.session import materialize

__all__ = ["ASCII_SPACE", "SPACE_RUN", "ascii_lower", "let", "materialize", "read", "words", "word_list",
           "folded_words", "sha256_hex", "bounded_ids", "class_sample"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, through Spark's own reader (any file system Spark can reach)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text (byte length equals length) takes Spark's
    fast ``lower``; other text is translated letter by letter so that letters outside
    ASCII keep their case."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expression once: ``body`` sees a lambda variable, so an expensive value that
    it uses several times is computed once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (empty for null)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def word_list(text: str | None) -> list[bytes]:
    """The same words, A-Z lower-cased, inside a Python task: ``bytes.split`` separates at
    exactly the six ASCII spaces and ``bytes.lower`` touches A-Z only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))


def folded_words(text: str | None) -> list[bytes]:
    """Words ``[0-9a-z]`` and everything outside ASCII, A-Z lower-cased: one byte
    translation turns each separator into a blank, then the text is split at blanks."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def bounded_ids(rows: DataFrame, bound: int, *keep: str) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of ``doc_id``: the same ones on every run.
    Only ids and labels travel here, never texts, so the result may be broadcast."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    return rows.orderBy(order, "doc_id", *keep).limit(bound)


def shares(counts: dict, bound: int) -> dict:
    """How many rows of each class a sample of ``bound`` takes: small classes whole, the rest
    alike."""
    left, out = bound, {}
    for i, (label, n) in enumerate(sorted(counts.items(), key=lambda kv: (kv[1], str(kv[0])))):
        out[label] = min(n, left // (len(counts) - i))
        left -= out[label]
    return out


def class_sample(rows: DataFrame, bound: int, label: str) -> tuple[DataFrame, dict, dict]:
    """At most ``bound`` rows of (doc_id, label), divided among the classes so that a rare one
    is there, chosen by a hash of ``doc_id``; with the classes' counts and shares.

    Only ids and labels travel, so the result may be broadcast.  Of more than ``bound``
    classes the largest are taken.  A cut on the hash leaves about twice a class's share
    before its rows are ranked, so no task gets a whole class."""
    top = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), label).limit(bound).collect()
    counts = {r[label]: r["__n"] for r in top}
    quota = shares(counts, bound)
    table = rows.sparkSession.createDataFrame(
        [(k, q, min(1.0, (2 * q + 100) / counts[k]) * 2.0**31) for k, q in quota.items()],
        rows.select(label).schema.add("__quota", "long").add("__below", "double"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    near = rows.join(F.broadcast(table), label).where(F.pmod(order, F.lit(2**31)) < F.col("__below"))
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.pmod(order, F.lit(2**31)), "doc_id"))
    return near.withColumn("__place", place).where("__place <= __quota").select("doc_id", label), counts, quota
