"""Cleaning keys bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import cleaning as C
from tilth.plans.bindings import (MODEL_CATEGORICAL, MODEL_NUMERIC, V_MODEL, V_SKEW, V_SURVEY, table,
                                  v_model, v_skew, v_survey, with_ctes)
from tilth.plans.catalog import query
from tilth.plans.survey import prepare_survey as _prepare, prepare_survey_strict as _strict

_SURVEY_SUBSET = ["Order key", "Education", "Acreage", "Order status"]


def _dtext(x: str) -> str:
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


@query("project_subset", with_ctes(V_SURVEY) + """
SELECT "Education", "Acreage", "Order status" FROM v_survey""")
def project_subset(spark, d):
    return C.project(v_survey(spark, d), ["Education", "Acreage", "Order status"])


@query("normalize_names", with_ctes(V_SURVEY) + """
SELECT "Order key" AS order_key, "Education" AS education, "Acreage" AS acreage,
       "Order status" AS order_status, "Customer key" AS customer_key FROM v_survey""")
def normalize_names(spark, d):
    return C.normalize_names(v_survey(spark, d))


@query("drop_null_rows", with_ctes(V_SURVEY) + """
SELECT * FROM v_survey WHERE "Acreage" IS NOT NULL""")
def drop_null_rows(spark, d):
    return C.drop_null_rows(v_survey(spark, d), ["Acreage"])


@query("fill_null_column", with_ctes(V_SURVEY) + """
SELECT "Order key", coalesce("Education", 'No educated') AS "Education", "Acreage", "Order status",
       "Customer key" FROM v_survey""")
def fill_null_column(spark, d):
    return C.fill_null(v_survey(spark, d), "Education", "No educated")


@query("fill_null_row", with_ctes(V_SURVEY) + """
SELECT "Order key",
       CASE WHEN "Education" IS NULL THEN coalesce("Education", 'No educated') ELSE "Education" END AS "Education",
       "Acreage",
       CASE WHEN "Education" IS NULL THEN coalesce("Order status", 'No educated') ELSE "Order status" END
         AS "Order status",
       "Customer key" FROM v_survey""")
def fill_null_row(spark, d):
    return C.fill_row_when_null(v_survey(spark, d), "Education", "No educated")


@query("drop_column", with_ctes(V_SURVEY) + """
SELECT "Order key", "Education", "Acreage", "Order status" FROM v_survey""")
def drop_column(spark, d):
    return v_survey(spark, d).drop("Customer key")


@query("filter_label", with_ctes(V_SURVEY) + """
SELECT * FROM v_survey WHERE "Order status" = 'F'""")
def filter_label(spark, d):
    return C.filter_label(v_survey(spark, d), "Order status", "F")


@query("recast_categorical", with_ctes(V_SURVEY) + f"""
SELECT "Order key", CAST("Customer key" AS VARCHAR) AS "Customer key", {_dtext('"Acreage"')} AS "Acreage"
FROM v_survey""")
def recast_categorical(spark, d):
    s = v_survey(spark, d).select("Order key", "Customer key", "Acreage")
    return C.recast_text(s, ["Customer key", "Acreage"])


def _iqr_sql(src: str, labels: str) -> str:
    return f"""(SELECT s.doc_id, s.lang, s.source, s.n_chars FROM {src} s JOIN (
      SELECT lang AS seg, quantile_cont(n_chars, 0.25) AS a, quantile_cont(n_chars, 0.75) AS b
      FROM {src} WHERE lang IN ({labels}) GROUP BY 1) q ON s.lang = q.seg
    WHERE s.n_chars < q.a - 1.5 * (q.b - q.a) OR s.n_chars > q.b + 1.5 * (q.b - q.a))"""


@query("iqr_outliers", with_ctes(V_SKEW) + "SELECT * FROM " + _iqr_sql("v_skew", "'de', 'fr'"))
def iqr_outliers(spark, d):
    return C.iqr_outliers(v_skew(spark, d), "n_chars", "lang", ["de", "fr"])


@query("union_outliers", with_ctes(V_SKEW) + "SELECT * FROM " + _iqr_sql("v_skew", "'de'")
       + " UNION ALL SELECT * FROM " + _iqr_sql("v_skew", "'en'"))
def union_outliers(spark, d):
    s = v_skew(spark, d)
    return C.union_all(C.iqr_outliers(s, "n_chars", "lang", ["de"]),
                       C.iqr_outliers(s, "n_chars", "lang", ["en"]))


@query("remove_outliers", with_ctes(V_SKEW) + """
SELECT * FROM v_skew WHERE doc_id NOT IN (SELECT doc_id FROM """ + _iqr_sql("v_skew", "'de', 'en'") + ")")
def remove_outliers(spark, d):
    s = v_skew(spark, d)
    return C.remove_rows(s, C.iqr_outliers(s, "n_chars", "lang", ["de", "en"]), "doc_id")


_FEATURES = ["l_returnflag", "line_no", "l_quantity", "l_discount", "target"]


@query("select_features", with_ctes(V_MODEL) + "SELECT " + ", ".join(_FEATURES) + " FROM v_model")
def select_features(spark, d):
    return C.project(v_model(spark, d), _FEATURES)


@query("renumber_rows", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_idx, o_orderkey, o_totalprice
FROM orders""")
def renumber_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return C.renumber(o, "o_orderkey").select("row_idx", "o_orderkey", "o_totalprice")


@query("prepare_survey", with_ctes(V_SURVEY) + """
SELECT "Order key" AS order_key, coalesce("Education", 'No educated') AS education, "Acreage" AS acreage,
       "Order status" AS order_status
FROM v_survey WHERE "Acreage" IS NOT NULL""")
def prepare_survey(spark, d):
    return _prepare(v_survey(spark, d), _SURVEY_SUBSET)


def _round_sql(src: str, var: str, labels: str) -> str:
    return f"""(SELECT f.order_key FROM {src} f JOIN (
      SELECT {var} AS seg, quantile_cont(acreage, 0.25) AS a, quantile_cont(acreage, 0.75) AS b
      FROM {src} WHERE {var} IN ({labels}) GROUP BY 1) q ON f.{var} = q.seg
    WHERE f.acreage < q.a - 1.5 * (q.b - q.a) OR f.acreage > q.b + 1.5 * (q.b - q.a))"""


@query("prepare_survey_strict", with_ctes(V_SURVEY) + f""",
s AS (SELECT "Order key" AS order_key, "Education" AS education, "Acreage" AS acreage,
             "Order status" AS order_status, "Customer key" AS customer_key
      FROM v_survey WHERE "Acreage" IS NOT NULL),
f AS (SELECT order_key, coalesce(education, 'No educated') AS education, acreage,
             CASE WHEN education IS NULL THEN coalesce(order_status, 'No educated') ELSE order_status END
               AS order_status, customer_key FROM s),
r1 AS (SELECT * FROM f WHERE order_key NOT IN (SELECT order_key FROM {_round_sql('f', 'order_status', "'F'")}
                                               UNION ALL SELECT order_key FROM {_round_sql('f', 'order_status', "'P'")})),
r2 AS (SELECT * FROM r1 WHERE order_key NOT IN (SELECT order_key FROM {_round_sql('r1', 'education', "'1-URGENT'")}))
SELECT order_key, education, {_dtext('acreage')} AS acreage, order_status,
       CAST(customer_key AS VARCHAR) AS customer_key FROM r2""")
def prepare_survey_strict(spark, d):
    return _strict(v_survey(spark, d), _SURVEY_SUBSET + ["Customer key"], key="order_key",
                   target="acreage", required="acreage", trigger="education", fill_value="No educated",
                   first_segments=("order_status", ["F", "P"]),
                   second_segments=("education", ["1-URGENT"]),
                   to_text=["customer_key", "acreage"])


@query("renumber_ties", with_ctes(V_SURVEY) + """
SELECT row_number() OVER (ORDER BY "Education" ASC NULLS LAST, "Acreage" ASC NULLS LAST, "Order key") - 1 AS row_idx,
       "Education" AS education, "Acreage" AS acreage, "Order key" AS order_key FROM v_survey""")
def renumber_ties(spark, d):
    """Order columns with nulls and many ties: every row once, nulls last."""
    out = C.renumber(v_survey(spark, d), ["Education", "Acreage", "Order key"])
    return out.select("row_idx", F.col("Education").alias("education"), F.col("Acreage").alias("acreage"),
                      F.col("Order key").alias("order_key"))
