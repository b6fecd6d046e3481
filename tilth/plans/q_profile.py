"""Profiling keys bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import profile as P
from tilth.plans.bindings import V_GROUP, V_SKEW, V_SURVEY, table, v_group, v_skew, v_survey, with_ctes
from tilth.plans.catalog import query, rnd, rounded


@query("profile_shape", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders")
def profile_shape(spark, d):
    return P.shape(table(spark, d, "orders"))


@query("profile_info", with_ctes(V_SURVEY) + """
SELECT 'Order key' AS "column", 0 AS position, 'bigint' AS dtype, count("Order key") AS non_null FROM v_survey
UNION ALL SELECT 'Education', 1, 'string', count("Education") FROM v_survey
UNION ALL SELECT 'Acreage', 2, 'double', count("Acreage") FROM v_survey
UNION ALL SELECT 'Order status', 3, 'string', count("Order status") FROM v_survey
UNION ALL SELECT 'Customer key', 4, 'bigint', count("Customer key") FROM v_survey""")
def profile_info(spark, d):
    return P.info(v_survey(spark, d))


@query("null_counts", with_ctes(V_SURVEY) + """
SELECT 'Order key' AS "column", count_if("Order key" IS NULL) AS null_count FROM v_survey
UNION ALL SELECT 'Education', count_if("Education" IS NULL) FROM v_survey
UNION ALL SELECT 'Acreage', count_if("Acreage" IS NULL) FROM v_survey
UNION ALL SELECT 'Order status', count_if("Order status" IS NULL) FROM v_survey
UNION ALL SELECT 'Customer key', count_if("Customer key" IS NULL) FROM v_survey""")
def null_counts(spark, d):
    return P.null_counts(v_survey(spark, d))


@query("null_total", with_ctes(V_SURVEY) + """
SELECT CAST(count_if("Education" IS NULL) + count_if("Acreage" IS NULL) AS BIGINT) AS null_total
FROM v_survey""")
def null_total(spark, d):
    return P.null_total(v_survey(spark, d))


@query("missing_pct", with_ctes(V_SURVEY) + """
SELECT 'Education' AS "column", count_if("Education" IS NULL) AS missing,
       round(100.0 * count_if("Education" IS NULL) / count(*), 6) AS missing_pct FROM v_survey
UNION ALL
SELECT 'Acreage', count_if("Acreage" IS NULL), round(100.0 * count_if("Acreage" IS NULL) / count(*), 6)
FROM v_survey""")
def missing_pct(spark, d):
    return rounded(P.missing_pct(v_survey(spark, d), ["Education", "Acreage"]), {"missing_pct": 6})


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", """
WITH long AS (
  SELECT 'l_quantity' AS "column", l_quantity AS value FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max
FROM long GROUP BY "column" """)
def describe_numeric(spark, d):
    out = P.describe_numeric(table(spark, d, "lineitem"), _DESC_COLS)
    return rounded(out, {c: 6 for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]})


@query("describe_categorical", """
WITH long AS (
  SELECT 'c_mktsegment' AS "column", c_mktsegment AS value FROM customer
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer),
vc AS (SELECT "column", value, count(*) AS freq FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY freq DESC, value) AS rk FROM vc)
SELECT "column", CAST(sum(freq) AS BIGINT) AS count, count(*) AS unique,
       max(CASE WHEN rk = 1 THEN value END) AS top, max(CASE WHEN rk = 1 THEN freq END) AS freq
FROM ranked GROUP BY "column" """)
def describe_categorical(spark, d):
    return P.describe_categorical(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"])


@query("dup_rows", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS n_distinct,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS BIGINT)
         AS n_duplicates
FROM documents""")
def dup_rows(spark, d):
    return P.duplicate_rows(table(spark, d, "documents").select("text", "lang", "source"))


@query("dup_subset", """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
  FROM documents) WHERE rn > 1""")
def dup_subset(spark, d):
    out = P.duplicated_on(table(spark, d, "documents"), ["text"], "doc_id")
    return out.select("doc_id", "lang", "source", "n_chars")


@query("value_counts", """
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def value_counts(spark, d):
    return P.value_counts(table(spark, d, "orders"), "o_orderpriority")


@query("constant_columns", with_ctes(V_GROUP) + """
SELECT 'l_orderkey' AS "column", coalesce(min(l_orderkey) = max(l_orderkey), false) AS is_constant FROM v_group
UNION ALL SELECT 'l_linenumber', coalesce(min(l_linenumber) = max(l_linenumber), false) FROM v_group
UNION ALL SELECT 'l_returnflag', coalesce(min(l_returnflag) = max(l_returnflag), false) FROM v_group
UNION ALL SELECT 'l_linestatus', coalesce(min(l_linestatus) = max(l_linestatus), false) FROM v_group
UNION ALL SELECT 'l_extendedprice', coalesce(min(l_extendedprice) = max(l_extendedprice), false) FROM v_group""")
def constant_columns(spark, d):
    return P.constant_columns(v_group(spark, d))


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, d):
    return P.distinct_values(table(spark, d, "customer"), "c_mktsegment")


@query("head_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def head_n(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.head(o, 10, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("central_tendency", with_ctes(V_SKEW) + """
SELECT lang, round(avg(n_chars), 6) AS mean, round(quantile_cont(n_chars, 0.5), 6) AS median
FROM v_skew GROUP BY lang""")
def central_tendency(spark, d):
    return rounded(P.central_tendency(v_skew(spark, d), "n_chars", ["lang"]), {"mean": 6, "median": 6})


@query("dispersion", with_ctes(V_SKEW) + """
SELECT lang, round(stddev_samp(n_chars), 6) AS std, round(var_samp(n_chars), 4) AS var,
       round(quantile_cont(n_chars, 0.25), 6) AS q1, round(quantile_cont(n_chars, 0.75), 6) AS q3,
       round(quantile_cont(n_chars, 0.75) - quantile_cont(n_chars, 0.25), 6) AS iqr
FROM v_skew GROUP BY lang""")
def dispersion(spark, d):
    return rounded(P.dispersion(v_skew(spark, d), "n_chars", ["lang"]),
                   {"std": 6, "var": 4, "q1": 6, "q3": 6, "iqr": 6})


@query("shape_stats", with_ctes(V_SKEW) + """
SELECT lang, count(n_chars) AS n, round(skewness(n_chars), 6) AS skew, round(kurtosis(n_chars), 6) AS kurt
FROM v_skew GROUP BY lang""")
def shape_stats(spark, d):
    return rounded(P.shape_stats(v_skew(spark, d), "n_chars", ["lang"]), {"skew": 6, "kurt": 6})


@query("histogram_by", """
WITH r AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (
  SELECT CAST(CASE WHEN (r.mx - r.mn) / 10 = 0 THEN 0
              ELSE least(floor((o.o_totalprice - r.mn) / ((r.mx - r.mn) / 10)), 9) END AS INTEGER) AS bin,
         o.o_orderstatus, r.mn, r.mx
  FROM orders o, r WHERE o.o_totalprice IS NOT NULL)
SELECT bin, round(mn + bin * (mx - mn) / 10, 4) AS lo, round(mn + (bin + 1) * (mx - mn) / 10, 4) AS hi,
       o_orderstatus, count(*) AS count
FROM b GROUP BY bin, mn, mx, o_orderstatus""")
def histogram_by(spark, d):
    out = P.histogram_by(table(spark, d, "orders"), "o_totalprice", "o_orderstatus", 10)
    return rounded(out, {"lo": 4, "hi": 4})


@query("box_stats", with_ctes(V_SKEW) + """,
q AS (SELECT lang, count(*) AS n, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS median,
             quantile_cont(n_chars, 0.75) AS q3 FROM v_skew GROUP BY lang),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.lang, f.n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(f.lower_fence, 6) AS lower_fence, round(f.upper_fence, 6) AS upper_fence,
       count_if(v.n_chars < f.lower_fence OR v.n_chars > f.upper_fence) AS n_outliers
FROM f JOIN v_skew v USING (lang)
GROUP BY f.lang, f.n, f.q1, f.median, f.q3, f.lower_fence, f.upper_fence""")
def box_stats(spark, d):
    return rounded(P.box_stats(v_skew(spark, d), "lang", "n_chars"),
                   {c: 6 for c in ["q1", "median", "q3", "lower_fence", "upper_fence"]})


@query("pairwise_corr", """
SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b,
       round(corr(l_quantity, l_extendedprice), 6) AS corr, round(covar_samp(l_quantity, l_extendedprice), 4) AS covar
FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6),
       round(covar_samp(l_quantity, l_discount), 4) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6),
       round(covar_samp(l_extendedprice, l_discount), 4) FROM lineitem""")
def pairwise_corr(spark, d):
    out = P.pairwise_corr(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(out, {"corr": 6, "covar": 4})


@query("group_values_topn", """
SELECT o_orderpriority, string_agg(printf('%.2f', o_totalprice), ',' ORDER BY o_totalprice DESC) AS top_values
FROM (SELECT o_orderpriority, o_totalprice,
             row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rn FROM orders)
WHERE rn <= 5 GROUP BY o_orderpriority""")
def group_values_topn(spark, d):
    out = P.group_values_topn(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", 5)
    return out.select("o_orderpriority", F.concat_ws(",", F.transform(
        "top_values", lambda x: F.format_string("%.2f", x))).alias("top_values"))


@query("missing_rule", """
WITH t AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders),
c AS (SELECT count_if(x IS NULL OR isnan(x)) AS m, count(*) AS n FROM t)
SELECT 'x' AS "column", m AS missing, round(100.0 * m / n, 6) AS missing_pct, m AS null_count, n - m AS non_null FROM c""")
def missing_rule(spark, d):
    """NaN and null are missing alike in all counts."""
    key = F.col("o_orderkey")
    t = table(spark, d, "orders").select(F.when(key % 5 == 0, float("nan")).when(key % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("x"))
    out = P.missing_pct(t).join(P.null_counts(t), "column").join(P.info(t).select("column", "non_null"), "column")
    return rounded(out, {"missing_pct": 6})
