"""Encoding and splitting keys bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import encode as E
from tilth.plans.bindings import MODEL_CATEGORICAL, MODEL_NUMERIC, V_MODEL, table, v_model, with_ctes
from tilth.plans.catalog import query, rounded

# TPC-H category domains used to write the wide oracle columns.
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
LINE_NUMBERS = ["1", "2", "3", "4", "5", "6", "7"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TRAIN_REGION = 0
NATIONS_ALL = [str(i) for i in range(25)]
# The nation keys of region 0 in the driver's nation table (the Spark side
# finds them with a semi join on n_regionkey; the oracle's wide columns need the names).
NATIONS_TRAIN = ["0", "5", "10", "15", "20"]

_CUST_CAT = ["c_mktsegment", "c_nationkey"]
_CUST_NUM = ["c_acctbal"]


def _model_vocab_features():
    feats = ([f"l_returnflag={v}" for v in RETURN_FLAGS] + [f"l_linestatus={v}" for v in LINE_STATUSES]
             + [f"line_no={v}" for v in LINE_NUMBERS] + MODEL_NUMERIC)
    return sorted(feats)


def _wide_sql_cols(features, numeric_alias=None):
    out = []
    for f in features:
        if "=" in f:
            col, val = f.split("=", 1)
            src = numeric_alias.get(col, col) if numeric_alias else col
            out.append(f"CAST(coalesce(CAST({src} AS VARCHAR) = '{val}', false) AS INTEGER) AS \"{f}\"")
        else:
            out.append(f"coalesce(CAST({f} AS DOUBLE), 0.0) AS \"{f}\"")
    return ", ".join(out)


def _vocab_sql(src: str, cats: list[str], nums: list[str]) -> str:
    parts = [f"SELECT DISTINCT '{c}=' || CAST({c} AS VARCHAR) AS feature, '{c}' AS \"column\", "
             f"CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL" for c in cats]
    parts += [f"SELECT '{c}', '{c}', CAST(NULL AS VARCHAR)" for c in nums]
    return ("(SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS idx, feature, \"column\", value"
            " FROM (" + " UNION ALL ".join(parts) + "))")


def _customers(spark, d):
    return table(spark, d, "customer")


def _train_customers(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").where(F.col("n_regionkey") == TRAIN_REGION)
    return c.join(n, c.c_nationkey == n.n_nationkey, "left_semi")


_TRAIN_CUST_SQL = f"""tr AS (SELECT c.* FROM customer c WHERE c.c_nationkey IN (
  SELECT n_nationkey FROM nation WHERE n_regionkey = {TRAIN_REGION}))"""


@query("onehot_vocabulary", with_ctes(V_MODEL) + "SELECT * FROM "
       + _vocab_sql("v_model", MODEL_CATEGORICAL, MODEL_NUMERIC))
def onehot_vocabulary(spark, d):
    return E.vocabulary(v_model(spark, d), MODEL_CATEGORICAL, MODEL_NUMERIC)


@query("onehot_encode", with_ctes(V_MODEL) + "SELECT row_key, "
       + _wide_sql_cols(_model_vocab_features()) + " FROM v_model")
def onehot_encode(spark, d):
    m = v_model(spark, d)
    vocab = E.learn_vocabulary(m, MODEL_CATEGORICAL, MODEL_NUMERIC)
    return E.encode_wide(m, vocab, ["row_key"])


@query("onehot_encode_unseen", with_ctes(_TRAIN_CUST_SQL) + f""",
v AS {_vocab_sql('tr', _CUST_CAT, _CUST_NUM)},
l AS (SELECT c_custkey, 'c_mktsegment=' || c_mktsegment AS feature, CAST(1.0 AS DOUBLE) AS value FROM customer
      UNION ALL SELECT c_custkey, 'c_nationkey=' || CAST(c_nationkey AS VARCHAR), CAST(1.0 AS DOUBLE) FROM customer
      UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer)
SELECT l.c_custkey, v.idx, l.feature, round(l.value, 4) AS value
FROM l JOIN v USING (feature) WHERE l.value IS NOT NULL AND l.value <> 0""")
def onehot_encode_unseen(spark, d):
    vocab = E.vocabulary(_train_customers(spark, d), _CUST_CAT, _CUST_NUM)
    out = E.encode_long(_customers(spark, d), vocab, "c_custkey", _CUST_CAT, _CUST_NUM)
    return rounded(out, {"value": 4})


@query("feature_mismatch", with_ctes(_TRAIN_CUST_SQL) + f""",
a AS {_vocab_sql('tr', _CUST_CAT, _CUST_NUM)},
b AS {_vocab_sql('customer', _CUST_CAT, _CUST_NUM)}
SELECT feature, 'only_train' AS side FROM (SELECT feature FROM a EXCEPT SELECT feature FROM b)
UNION ALL
SELECT feature, 'only_new' FROM (SELECT feature FROM b EXCEPT SELECT feature FROM a)""")
def feature_mismatch(spark, d):
    a, b = [E.feature_names(c, _CUST_CAT, _CUST_NUM) for c in (_train_customers(spark, d), _customers(spark, d))]
    return E.mismatch(a, b)


def _cust_features(nations):
    return sorted([f"c_mktsegment={s}" for s in SEGMENTS] + [f"c_nationkey={n}" for n in nations] + _CUST_NUM)


@query("align_intersect", "SELECT c_custkey, " + _wide_sql_cols(_cust_features(NATIONS_TRAIN))
       + " FROM customer")
def align_intersect(spark, d):
    cust = _customers(spark, d)
    full = E.encode_wide(cust, E.learn_vocabulary(cust, _CUST_CAT, _CUST_NUM), ["c_custkey"])
    train_cols = [f for _, f, _, _ in E.learn_vocabulary(_train_customers(spark, d), _CUST_CAT, _CUST_NUM)]
    return E.align_intersect(full, ["c_custkey"] + train_cols)


@query("align_pad", "SELECT c_custkey, " + _wide_sql_cols(_cust_features(NATIONS_ALL)) + " FROM customer")
def align_pad(spark, d):
    tr = _train_customers(spark, d)
    new = _customers(spark, d).join(tr.select("c_custkey"), "c_custkey", "left_anti")
    a = E.encode_wide(tr, E.learn_vocabulary(tr, _CUST_CAT, _CUST_NUM), ["c_custkey"])
    b = E.encode_wide(new, E.learn_vocabulary(new, _CUST_CAT, _CUST_NUM), ["c_custkey"])
    return E.align_pad(a, b)


_SPLIT_SQL = """CASE WHEN u < 0.2 THEN 'test' WHEN u < 0.4 THEN 'val' ELSE 'train' END"""
_U_SQL = "CAST(('0x' || substr(md5('42:' || row_key), 1, 8)) AS BIGINT) / 4294967296.0"
V_SPLIT = f"""v_split AS (
  SELECT *, {_SPLIT_SQL.replace('u <', _U_SQL + ' <')} AS split FROM v_model)"""


def _split_model(spark, d):
    return E.split(v_model(spark, d), "row_key")


@query("split_60_20_20", with_ctes(V_MODEL, V_SPLIT) + "SELECT row_key, split FROM v_split")
def split_60_20_20(spark, d):
    return _split_model(spark, d).select("row_key", "split")


@query("split_exact", with_ctes(V_MODEL) + """,
r AS (SELECT row_key, rank() OVER (ORDER BY md5('42:' || row_key) || ':' || row_key) - 1 AS pos,
             count(*) OVER () AS n FROM v_model),
c AS (SELECT *, ceil(n * 0.2) AS n_test FROM r),
c2 AS (SELECT *, ceil((n - n_test) * 0.25) AS n_val FROM c)
SELECT row_key, CASE WHEN pos < n_test THEN 'test' WHEN pos < n_test + n_val THEN 'val' ELSE 'train' END AS split
FROM c2""")
def split_exact(spark, d):
    return E.split_exact(v_model(spark, d), "row_key").select("row_key", "split")


@query("split_report", with_ctes(V_MODEL, V_SPLIT) + """
SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM v_split), 6) AS share
FROM v_split GROUP BY split""")
def split_report(spark, d):
    return rounded(E.split_report(_split_model(spark, d)), {"share": 6})


@query("union_train_val", with_ctes(V_MODEL, V_SPLIT) + """
SELECT row_key, split, round(target, 4) AS target FROM v_split WHERE split = 'train'
UNION ALL SELECT row_key, split, round(target, 4) FROM v_split WHERE split = 'val'""")
def union_train_val(spark, d):
    s = _split_model(spark, d).select("row_key", "split", "target")
    out = s.where(F.col("split") == "train").unionByName(s.where(F.col("split") == "val"))
    return rounded(out, {"target": 4})


@query("standardize", with_ctes(V_MODEL) + """,
s AS (SELECT avg(l_quantity) AS m0, stddev_pop(l_quantity) AS s0, avg(l_discount) AS m1,
             stddev_pop(l_discount) AS s1, avg(l_tax) AS m2, stddev_pop(l_tax) AS s2 FROM v_model)
SELECT row_key,
       round((l_quantity - m0) / CASE WHEN s0 = 0 THEN 1 ELSE s0 END, 6) AS l_quantity,
       round((l_discount - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS l_discount,
       round((l_tax - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) AS l_tax
FROM v_model, s""")
def standardize(spark, d):
    out = E.standardize(v_model(spark, d), MODEL_NUMERIC, ["row_key"])
    return rounded(out, {c: 6 for c in MODEL_NUMERIC})


@query("prep_end_to_end", with_ctes(V_MODEL, V_SPLIT) + """
SELECT split, count(*) AS n, round(sum(target), 2) AS target_sum,
       (SELECT count(*) FROM """ + _vocab_sql("v_model", MODEL_CATEGORICAL, MODEL_NUMERIC) + """) AS n_features
FROM v_split GROUP BY split""")
def prep_end_to_end(spark, d):
    from tilth.plans.survey import prepare_for_model
    return rounded(prepare_for_model(v_model(spark, d), "row_key", "target", MODEL_CATEGORICAL, MODEL_NUMERIC),
                   {"target_sum": 2})
