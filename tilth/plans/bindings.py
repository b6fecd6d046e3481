"""Bindings of the operators to the driver tables.

Each binding exists twice: as a DataFrame built from the parquet tables, and as
SQL text the DuckDB oracle inlines as a CTE.  Both read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as Spark reads it: input splits set the number of tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- raw survey stand-in: orders with injected missing values ----------------

def v_survey(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("Order key"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("Education"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("Acreage"),
        F.col("o_orderstatus").alias("Order status"),
        F.col("o_custkey").alias("Customer key"))


V_SURVEY = """v_survey AS (
  SELECT o_orderkey AS "Order key",
         nullif(o_orderpriority, '5-LOW') AS "Education",
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS "Acreage",
         o_orderstatus AS "Order status",
         o_custkey AS "Customer key"
  FROM orders)"""


# ---- categorical feature vs target ------------------------------------------

def v_group(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice")


V_GROUP = """v_group AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_extendedprice FROM lineitem)"""


# ---- skewed target with real IQR outliers ------------------------------------

def v_skew(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


V_SKEW = """v_skew AS (SELECT doc_id, lang, source, n_chars FROM documents)"""


# ---- modelling table ---------------------------------------------------------

MODEL_CATEGORICAL = ["l_returnflag", "l_linestatus", "line_no"]
MODEL_NUMERIC = ["l_quantity", "l_discount", "l_tax"]


def v_model(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        "l_returnflag", "l_linestatus",
        F.col("l_linenumber").cast("string").alias("line_no"),
        "l_quantity", "l_discount", "l_tax",
        (1000 * F.col("l_quantity") - 50000 * F.col("l_discount")
         + F.when(F.col("l_returnflag") == "A", 5000).otherwise(0)
         + 0.1 * F.col("l_extendedprice")).alias("target"))


V_MODEL = """v_model AS (
  SELECT concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key,
         l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS line_no,
         l_quantity, l_discount, l_tax,
         1000 * l_quantity - 50000 * l_discount
           + CASE WHEN l_returnflag = 'A' THEN 5000 ELSE 0 END
           + 0.1 * l_extendedprice AS target
  FROM lineitem)"""


# ---- reference vs current period --------------------------------------------

REFERENCE_END = "2024-01-16"
DRIFT_NUMERIC = ["value", "user_id"]
DRIFT_CATEGORICAL = ["event_type"]


def v_events_tagged(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "event_type", "value",
        F.when(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz"), "reference")
         .otherwise("current").alias("dataset"))


def v_events_reference(spark, sf_dir) -> DataFrame:
    """The reference period itself, filtered on the timestamp so the bound reaches the scan."""
    e = table(spark, sf_dir, "events")
    return e.where(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz")).select(
        "event_id", "user_id", "event_type", "value")


V_EVENTS_TAGGED = """v_tagged AS (
  SELECT event_id, user_id, event_type, value,
         CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END AS dataset
  FROM events)"""


# ---- stored monitoring runs: one per day ------------------------------------

def v_runs(spark, sf_dir) -> DataFrame:
    """Per-day error metrics of a naive per-user mean model over ``events``."""
    e = table(spark, sf_dir, "events")
    user_mean = e.groupBy("user_id").agg(F.avg("value").alias("pred"))
    scored = e.join(user_mean, "user_id").select(
        F.to_date("ts").alias("day"), F.col("value").alias("y"), "pred")
    return scored.groupBy("day").agg(
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("pred"), 2))).alias("rmse"),
        (1 - F.sum(F.pow(F.col("y") - F.col("pred"), 2))
         / F.when(F.var_pop("y") != 0, F.var_pop("y") * F.count("y"))).alias("r2"),
        F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"),
        F.count(F.lit(1)).alias("n"))


V_RUNS = """v_user_mean AS (SELECT user_id, avg(value) AS pred FROM events GROUP BY user_id),
v_runs AS (
  SELECT CAST(e.ts AS DATE) AS day,
         sqrt(avg((e.value - m.pred) ^ 2)) AS rmse,
         1 - sum((e.value - m.pred) ^ 2)
           / nullif(var_pop(e.value) * count(e.value), 0) AS r2,
         avg(abs(e.value - m.pred)) AS mae,
         count(*) AS n
  FROM events e JOIN v_user_mean m USING (user_id)
  GROUP BY 1)"""


# ---- registry rows -----------------------------------------------------------

def v_versions(spark, sf_dir) -> DataFrame:
    """Registered runs: model per nation, version = supplier key, alternating raw /
    optimised runs, metrics derived from the account balance, stage cycling."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("model_"), F.col("s_nationkey").cast("string")).alias("model_name"),
        F.col("s_suppkey").alias("version"),
        F.when(F.col("s_suppkey") % 2 == 1, "raw").otherwise("optimized").alias("kind"),
        (F.abs(F.col("s_acctbal")) / 100 + 1).alias("rmse"),
        (1 - F.abs(F.col("s_acctbal")) / 20000).alias("r2"),
        F.element_at(F.array(F.lit("None"), F.lit("Staging"), F.lit("Production"), F.lit("Archived")),
                     (F.col("s_suppkey") % 4 + 1).cast("int")).alias("stage"),
        F.col("s_name").alias("run_id"))


V_VERSIONS = """v_versions AS (
  SELECT 'model_' || CAST(s_nationkey AS VARCHAR) AS model_name,
         s_suppkey AS version,
         CASE WHEN s_suppkey % 2 = 1 THEN 'raw' ELSE 'optimized' END AS kind,
         abs(s_acctbal) / 100 + 1 AS rmse,
         1 - abs(s_acctbal) / 20000 AS r2,
         ['None', 'Staging', 'Production', 'Archived'][CAST(s_suppkey % 4 AS INTEGER) + 1] AS stage,
         s_name AS run_id
  FROM supplier)"""


# ---- the same registry with gaps: NaN, null and zero metrics -------------------

def v_versions_gaps(spark, sf_dir) -> DataFrame:
    v, n = v_versions(spark, sf_dir), F.col("version")
    nan = F.lit(float("nan"))
    return v.withColumn("rmse", F.when(n % 7 == 3, nan).when(n % 11 == 5, F.lit(None)).when(n % 13 == 6, 0.0)
                        .otherwise(F.col("rmse"))).withColumn(
        "r2", F.when(n % 9 == 4, nan).when(n % 8 == 5, F.lit(None)).when(n % 5 == 2, 0.0).otherwise(F.col("r2")))


# NaN counts as missing in every rule, so the SQL side writes null for both
V_VERSIONS_GAPS = V_VERSIONS + """,
v_gaps AS (
  SELECT model_name, version, kind, stage, run_id,
         CASE WHEN version % 7 = 3 OR version % 11 = 5 THEN NULL WHEN version % 13 = 6 THEN 0 ELSE rmse END AS rmse,
         CASE WHEN version % 9 = 4 OR version % 8 = 5 THEN NULL WHEN version % 5 = 2 THEN 0 ELSE r2 END AS r2
  FROM v_versions),
last AS (SELECT * FROM v_gaps QUALIFY row_number() OVER (PARTITION BY model_name, kind ORDER BY version DESC) = 1),
prod AS (SELECT * FROM v_gaps WHERE stage = 'Production'
         QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
