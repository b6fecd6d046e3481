"""The queries of the text operators over the driver tables, and their SQL.

Each takes (spark, sf_dir), reads whole tables through Spark and returns one row per
document or conversation (op6: per length) with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm import (chat, decontam, langid, lengths, lines, mixing, neardup, phrases, quality,
                       ranked, repeats, secrets, sql, toxicity)
from tilth.llm.common import read, sha256_hex

Query = Callable[[SparkSession, str], DataFrame]

CONTROL = "<|im_end|><|im_start|>assistant ok"


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (an id that is null counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(fold_of(F.col("doc_id"), 5) != 0))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    made = chat.format_chats(turns.unionByName(probe))
    back = made.select("conv_id", "segments", "formatted", "valid_order", "order_errors",
                       chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha256_hex(told).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), sha256_hex(F.col("loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid_order",
        F.size("order_errors").cast("long").alias("n_order_errors"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = fold_of(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held).select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(lengths.token_lengths(read(spark, sf_dir, "documents")))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.arrays_overlap("failed_rules", F.array(*[F.lit(r.name) for r in quality.BASE_RULES]))
    return judged.select("doc_id", *quality.SIGNALS, base.alias("base_failed"), "kept")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(read(spark, sf_dir, "documents")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


def op11_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(read(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_mix_sources, op3_chat_format, op4_language_id, op5_decontamination, op6_token_counts,
    op7_minhash_dedup, op8_quality_rules, op9_secret_scan, op10_line_dedup, op11_repeated_bytes, op12_phrase_mining,
    op13_ranked_search)}

ORACLE: dict[str, str] = {
    "op2_mix_sources": sql.statement(sql.mixing("documents"), "SELECT doc_id, size, source_size, target, taken FROM m_out"),
    "op3_chat_format": sql.chats(),
    "op5_decontamination": sql.statement(sql.contamination("documents"), "SELECT * FROM c_out"),
    "op7_minhash_dedup": sql.statement(sql.near_duplicates("documents"), "SELECT * FROM n_out"),
    "op8_quality_rules": sql.statement(sql.quality("documents"), "SELECT * FROM q_out"),
    "op10_line_dedup": sql.statement(
        sql.lines("documents"), "SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM l_out"),
    "op11_repeated_bytes": sql.repeated_bytes(),
    "op12_phrase_mining": sql.collocations(),
    "op13_ranked_search": sql.ranked(),
}
