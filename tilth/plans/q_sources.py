"""Source and sink keys.

Each key writes a driver table to the shared scratch folder in the format under
test, reads it back through the library's reader and aggregates, so the round
trip (types, missing tokens, separators, partition pruning) is checked against
the same aggregate computed directly by the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.operators import encode as E
from tilth.plans.bindings import (MODEL_CATEGORICAL, MODEL_NUMERIC, V_MODEL, V_SURVEY, V_VERSIONS, table,
                                  v_model, v_survey, v_versions, with_ctes)
from tilth.plans.catalog import query, rounded
from tilth.plans.q_encode import V_SPLIT
from tilth.session import scratch_path
from tilth.sources import files as S

SURVEY_CSV_SCHEMA = T.StructType([
    T.StructField("Order key", T.LongType()), T.StructField("Education", T.StringType()),
    T.StructField("Acreage", T.DoubleType()), T.StructField("Order status", T.StringType()),
    T.StructField("Customer key", T.LongType())])

CUSTOMER_CSV_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@query("scan_csv", with_ctes(V_SURVEY) + """
SELECT "Order status" AS order_status, count(*) AS n, count("Education") AS n_education,
       count("Acreage") AS n_acreage, round(sum("Acreage"), 2) AS sum_acreage,
       CAST(sum("Customer key") AS BIGINT) AS sum_customer
FROM v_survey GROUP BY 1""")
def scan_csv(spark, d):
    path = scratch_path(spark, "survey-csv")
    S.write_csv(v_survey(spark, d), path)
    back = S.read_csv(spark, path, SURVEY_CSV_SCHEMA)
    out = back.groupBy(F.col("Order status").alias("order_status")).agg(
        F.count(F.lit(1)).alias("n"), F.count("Education").alias("n_education"),
        F.count("Acreage").alias("n_acreage"), F.sum("Acreage").alias("sum_acreage"),
        F.sum("Customer key").alias("sum_customer"))
    return rounded(out, {"sum_acreage": 2})


@query("scan_csv_semicolon", """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS sum_acctbal, count(DISTINCT c_nationkey) AS nations
FROM customer GROUP BY 1""")
def scan_csv_semicolon(spark, d):
    path = scratch_path(spark, "customer-csv")
    S.write_csv(table(spark, d, "customer"), path, sep=";")
    back = S.read_csv(spark, path, CUSTOMER_CSV_SCHEMA, sep=";", glob="*.csv")
    out = back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("sum_acctbal"),
                                           F.countDistinct("c_nationkey").alias("nations"))
    return rounded(out, {"sum_acctbal": 2})


@query("scan_csv_text", "SELECT doc_id, sha256(text) AS text_sha256, lang, n_chars, 0::BIGINT AS n_corrupt FROM documents")
def scan_csv_text(spark, d):
    """Whole texts with quotes, commas and line breaks through a file whose columns stand in
    another order than the schema's."""
    path = scratch_path(spark, "documents-csv")
    S.write_csv(table(spark, d, "documents").select("text", "n_chars", "doc_id", "lang"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType())])
    back = S.read_csv(spark, path, schema, multi_line=True, corrupt_col="corrupt")
    return back.select("doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"), "lang", "n_chars",
                       F.size("corrupt").cast("long").alias("n_corrupt"))


@query("csv_sink", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_sink(spark, d):
    """The CSV sink read back in full."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    path = scratch_path(spark, "supplier-csv")
    S.write_csv(s, path)
    return S.read_csv(spark, path, s.schema)


@query("month_slice", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS sum_value FROM events
WHERE strftime(ts, '%Y_%m') = '2024_01' GROUP BY 1""")
def month_slice(spark, d):
    path = scratch_path(spark, "events-by-month")
    S.write_month_partitioned(table(spark, d, "events"), "ts", path)
    sl = S.read_month(spark, path, "2024_01")
    out = sl.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum_value"))
    return rounded(out, {"sum_value": 4})


@query("split_sink_roundtrip", with_ctes(V_MODEL, V_SPLIT) + """
SELECT split, count(*) AS n, round(sum(target), 2) AS target_sum FROM v_split GROUP BY 1""")
def split_sink_roundtrip(spark, d):
    path = scratch_path(spark, "splits")
    S.write_splits(E.split(v_model(spark, d), "row_key"), path)
    back = S.read_splits(spark, path)
    out = back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("target_sum"))
    return rounded(out, {"target_sum": 2})


# ---- encoded matrix with its feature names (item 9) ---------------------------

def _matrix_sql() -> str:
    from tilth.plans.q_encode import _model_vocab_features, _wide_sql_cols
    feats = _model_vocab_features()
    sums = "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, round(CAST(sum(\"{f}\") AS DOUBLE), 4) AS total, count(*) AS n_rows FROM m"
        for f in feats)
    return with_ctes(V_MODEL) + f""",
m AS (SELECT row_key, {_wide_sql_cols(feats)} FROM v_model)
{sums}"""


@query("matrix_roundtrip", _matrix_sql())
def matrix_roundtrip(spark, d):
    """The dense encoded matrix is stored with its feature names as Parquet columns and
    read back (in place of an array file plus a names file); every column is summed."""
    m = v_model(spark, d)
    vocab = E.learn_vocabulary(m, MODEL_CATEGORICAL, MODEL_NUMERIC)
    path = scratch_path(spark, "encoded-matrix")
    E.encode_wide(m, vocab, ["row_key"]).write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    names = [f for _, f, _, _ in vocab]
    from tilth.operators.profile import to_long
    long = to_long(back, names, name_col="feature", value_col="v")
    out = long.groupBy("feature").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n_rows"))
    return rounded(out, {"total": 4})


# ---- run records through the JSON sink and the tolerant reader (items 10, 12) --

@query("run_info_roundtrip", with_ctes(V_VERSIONS) + """
SELECT model_name, count(*) AS n, true AS valid, round(sum(rmse), 4) AS sum_rmse, max(version) AS max_version
FROM v_versions GROUP BY 1""")
def run_info_roundtrip(spark, d):
    """One run record per registered version through the JSON sink and the tolerant reader."""
    v = v_versions(spark, d)
    record = F.struct(
        F.col("run_id"), F.col("model_name"), F.col("version").alias("model_version"),
        F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("r2"), F.col("r2")).alias("metrics"),
        F.create_map(F.lit("alpha"), F.lit(1.0)).alias("parameters"),
        F.concat(F.lit("models:/"), F.col("model_name"), F.lit("/"), F.col("version").cast("string"))
         .alias("model_path"))
    path = scratch_path(spark, "run-info")
    S.write_json(v.select(record.alias("r")).select("r.*"), path)
    back = S.read_run_info(spark, path, multi_line=False)
    out = back.groupBy("model_name", "valid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("metrics")["rmse"]).alias("sum_rmse"),
        F.max("model_version").alias("max_version"))
    return rounded(out.select("model_name", "n", "valid", "sum_rmse", "max_version"), {"sum_rmse": 4})
