"""From raw documents to a training mix, in five stages.

Each stage is one operator over all documents the stage before kept.  ``run`` writes each
stage's result as Parquet into the folder of ``spark.checkpoint.dir`` and reads it back,
so a lost executor costs part of one stage only and the plan of a stage stays small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm import decontam, lines, mixing, neardup, quality, sql
from tilth.llm.common import read
from tilth.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


NEAR_WIDTH = 5     # words in a shingle of the near-duplicate stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go.

    Null and empty texts have no words and are rejected; very long texts are judged whole;
    repeated rows are judged alike; a null id stays or goes by its text."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; every document stays, with what is left.

    A null text stays null, an empty one empty; lines stay in the smallest doc_id that holds
    them; rows of one doc_id are one document, rows without an id together the last one."""
    return lines.replace_with_kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id.

    Texts without words and rows without doc_id are linked with nothing and stay; rows of
    one doc_id stay or go together.  doc_id must be integral."""
    gone = neardup.near_duplicates(docs, width=NEAR_WIDTH).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    Null and empty texts hold none and stay; items without words occur nowhere; rows with
    the same id and text go together."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the words taken of each (``size``, ``source_size``,
    ``target``, ``taken``; columns of these names are replaced).

    Texts without words are never taken; a null source is a source of its own; rows equal in
    id and text come out as one with all words taken of them.  Every stage gives an empty
    table for an empty one and passes columns it does not know."""
    return mixing.mixed_documents(docs).drop("virtual_finish")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


_COLUMNS = "doc_id, lang, source"
ORACLE_SQL: str | None = sql.statement(
    sql.quality("documents")
    + ["s1 AS (SELECT d.* FROM documents d JOIN q_out USING (doc_id) WHERE kept)"]
    + sql.lines("s1")
    + [f"s2 AS (SELECT {_COLUMNS}, CASE WHEN text IS NOT NULL THEN kept_text END AS text, "
       "length(CASE WHEN text IS NOT NULL THEN kept_text END)::BIGINT AS n_chars FROM s1 JOIN l_out USING (doc_id))"]
    + sql.near_duplicates("s2", width=NEAR_WIDTH)
    + ["s3 AS (SELECT s2.* FROM s2 JOIN n_out USING (doc_id) WHERE kept)"]
    + sql.contamination("s3")
    + ["s4 AS (SELECT s3.* FROM s3 JOIN c_out USING (doc_id) WHERE NOT contaminated)"]
    + sql.mixing("s4"),
    "SELECT s4.doc_id, text, lang, s4.source, n_chars, size, source_size, target, taken "
    "FROM s4 JOIN m_out USING (doc_id) WHERE taken > 0")
