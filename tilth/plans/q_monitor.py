"""Monitoring and drift keys bound to ``events``.

Reference = events before 2024-01-16, current = the rest.  The scoring model is
the per-user mean of the reference period (global mean for unseen users), a
fit that SQL can reproduce.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import monitor as M
from tilth.plans.bindings import (DRIFT_CATEGORICAL, DRIFT_NUMERIC, V_EVENTS_TAGGED, V_RUNS, table,
                                  v_events_reference, v_events_tagged, v_runs, with_ctes)
from tilth.plans.catalog import query, rounded

GENERATED_AT = "2024-02-01T00:00:00"
_R6 = 6


def _scored(spark, d):
    t = v_events_tagged(spark, d)
    model = M.group_mean_model(v_events_reference(spark, d), "user_id", "value")
    return M.score_group_mean(t, model, "user_id")


_SCORED_SQL = V_EVENTS_TAGGED + """,
pk AS (SELECT user_id, avg(value) AS p FROM v_tagged WHERE dataset = 'reference' GROUP BY 1),
ov AS (SELECT avg(value) AS f FROM v_tagged WHERE dataset = 'reference'),
scored AS (SELECT t.event_id, t.dataset, t.user_id, t.event_type, t.value, coalesce(pk.p, ov.f) AS prediction
           FROM v_tagged t LEFT JOIN pk USING (user_id), ov)"""


@query("scored_sets", "WITH " + _SCORED_SQL + """
SELECT event_id, dataset, user_id, value, round(prediction, 6) AS prediction FROM scored""")
def scored_sets(spark, d):
    s = _scored(spark, d).select("event_id", "dataset", "user_id", "value", "prediction")
    return rounded(s, {"prediction": _R6})


@query("performance_report", "WITH " + _SCORED_SQL + """
SELECT dataset, count(*) AS n, round(sqrt(sum((prediction - value) ^ 2) / count(*)), 6) AS rmse,
       round(1 - sum((prediction - value) ^ 2) / (var_pop(value) * count(*)), 6) AS r2,
       round(avg(abs(prediction - value)), 6) AS mae, round(avg(prediction - value), 6) + 0.0 AS mean_error,
       round(stddev_samp(prediction - value), 6) AS error_std
FROM scored GROUP BY dataset""")
def performance_report(spark, d):
    out = M.performance(_scored(spark, d), "value", "prediction", ["dataset"])
    return rounded(out, {c: _R6 for c in ["rmse", "r2", "mae", "mean_error", "error_std"]})


_LONG_NUM = """long AS (SELECT dataset, 'value' AS "column", CAST(value AS DOUBLE) AS v FROM v_tagged
          UNION ALL SELECT dataset, 'user_id', CAST(user_id AS DOUBLE) FROM v_tagged),
c AS (SELECT "column", v, count_if(dataset = 'reference') AS nr, count_if(dataset = 'current') AS nc
      FROM long GROUP BY 1, 2),
cum AS (SELECT "column", v, lag(v) OVER w AS pv,
               sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, nr, nc,
               sum(nr) OVER (PARTITION BY "column") AS tr, sum(nc) OVER (PARTITION BY "column") AS tc
        FROM c WINDOW w AS (PARTITION BY "column" ORDER BY v ROWS UNBOUNDED PRECEDING))"""

# The other series of the Kolmogorov tail, which converges for any argument given enough terms.
_KS_P = """(SELECT CASE WHEN lam <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 1 - sqrt(2 * pi()) / lam
   * sum(exp(0 - pow((2 * k - 1) * pi(), 2) / (8 * lam * lam))))) END FROM range(1, 401) t(k))"""


@query("drift_ks", "WITH " + V_EVENTS_TAGGED + ",\n" + _LONG_NUM + """,
d AS (SELECT "column", max(abs(cr / tr - cc / tc)) AS statistic, CAST(max(tr) AS BIGINT) AS n_ref,
             CAST(max(tc) AS BIGINT) AS n_cur FROM cum GROUP BY 1),
l AS (SELECT *, sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * statistic AS lam FROM d)
SELECT "column", round(statistic, 6) AS statistic, n_ref, n_cur, round(""" + _KS_P + """, 6) AS p_value FROM l""")
def drift_ks(spark, d):
    return rounded(M.ks_test(v_events_tagged(spark, d), DRIFT_NUMERIC), {"statistic": 6, "p_value": 6})


@query("drift_wasserstein", "WITH " + V_EVENTS_TAGGED + ",\n" + _LONG_NUM + """,
w AS (SELECT "column", sum(CASE WHEN pv IS NOT NULL
                                THEN abs((cr - nr) / tr - (cc - nc) / tc) * (v - pv) ELSE 0 END) AS w,
             CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur FROM cum GROUP BY 1),
sd AS (SELECT "column", stddev_pop(v) AS sd FROM long WHERE dataset = 'reference' GROUP BY 1)
SELECT w."column", n_ref, n_cur, round(w / greatest(coalesce(sd, 0), 0.001), 6) AS statistic
FROM w LEFT JOIN sd USING ("column")""")
def drift_wasserstein(spark, d):
    return rounded(M.wasserstein(v_events_tagged(spark, d), DRIFT_NUMERIC), {"statistic": 6})


_SHARES = """s AS (SELECT 'event_type' AS "column", event_type AS v, count_if(dataset = 'reference') AS nr,
             count_if(dataset = 'current') AS nc FROM v_tagged WHERE event_type IS NOT NULL GROUP BY 1, 2),
t AS (SELECT "column", sum(nr) AS tr, sum(nc) AS tc FROM s GROUP BY 1),
st AS (SELECT * FROM s JOIN t USING ("column"))"""


@query("drift_chi2", "WITH " + V_EVENTS_TAGGED + ",\n" + _SHARES + """,
x AS (SELECT "column", sum(CASE WHEN nr * tc / tr > 0 THEN (nc - nr * tc / tr) ^ 2 / (nr * tc / tr) ELSE 0 END)
               AS statistic, count(*) AS k, CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur
      FROM st GROUP BY 1)
SELECT "column", round(statistic, 6) AS statistic, k, n_ref, n_cur, k - 1 AS df,
       round(exp(-statistic / 2) * (1 + statistic / 2), 6) AS p_value FROM x""")
def drift_chi2(spark, d):
    return rounded(M.chi2_test(v_events_tagged(spark, d), DRIFT_CATEGORICAL), {"statistic": 6, "p_value": 6})


_JS_SQL = """js AS (SELECT "column", CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur,
             sqrt(greatest(sum(0.5 * CASE WHEN nr > 0 THEN (nr / tr) * ln((nr / tr) / ((nr / tr + nc / tc) / 2)) ELSE 0 END
                     + 0.5 * CASE WHEN nc > 0 THEN (nc / tc) * ln((nc / tc) / ((nr / tr + nc / tc) / 2)) ELSE 0 END),
                          0)) AS statistic
      FROM st GROUP BY 1)"""


@query("drift_js", "WITH " + V_EVENTS_TAGGED + ",\n" + _SHARES + ",\n" + _JS_SQL + """
SELECT "column", n_ref, n_cur, round(statistic, 6) AS statistic FROM js""")
def drift_js(spark, d):
    return rounded(M.jensen_shannon(v_events_tagged(spark, d), DRIFT_CATEGORICAL), {"statistic": 6})


_COLUMN_DRIFT_SQL = "WITH " + V_EVENTS_TAGGED + ",\n" + _LONG_NUM + ",\n" + _SHARES + ",\n" + _JS_SQL + """,
w AS (SELECT "column", sum(CASE WHEN pv IS NOT NULL
                                THEN abs((cr - nr) / tr - (cc - nc) / tc) * (v - pv) ELSE 0 END) AS w
      FROM cum GROUP BY 1),
sd AS (SELECT "column", stddev_pop(v) AS sd FROM long WHERE dataset = 'reference' GROUP BY 1),
cols AS (
  SELECT "column", 'wasserstein' AS test, w / greatest(coalesce(sd, 0), 0.001) AS statistic
  FROM w LEFT JOIN sd USING ("column")
  UNION ALL SELECT "column", 'jensen_shannon', statistic FROM js),
flagged AS (SELECT *, CAST(NULL AS DOUBLE) AS p_value, statistic >= 0.1 AS drifted FROM cols)"""


@query("column_drift", _COLUMN_DRIFT_SQL + """
SELECT "column", test, round(statistic, 6) AS statistic, p_value, drifted FROM flagged""")
def column_drift(spark, d):
    out = M.column_drift(v_events_tagged(spark, d), DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return rounded(out, {"statistic": 6, "p_value": 6})


@query("dataset_drift", _COLUMN_DRIFT_SQL + """
SELECT count(*) AS n_columns, count_if(drifted) AS n_drifted,
       round(count_if(drifted) / count(*), 6) AS share,
       count_if(drifted) / count(*) >= 0.5 AS dataset_drift FROM flagged""")
def dataset_drift(spark, d):
    cols = M.column_drift(v_events_tagged(spark, d), DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return rounded(M.dataset_drift(cols), {"share": 6})


_TESTED = {"value": "ks", "event_type": "chi2", "is_first_type": "proportion"}


def _tested_events(spark, d):
    t = v_events_tagged(spark, d)
    return t.withColumn("is_first_type", F.col("event_type") == t.agg(F.min("event_type").alias("m")).scalar())


@query("column_drift_tests", "WITH " + V_EVENTS_TAGGED + ",\n" + _LONG_NUM + ",\n" + _SHARES + """,
ks AS (SELECT max(abs(cr / tr - cc / tc)) AS statistic,
              sqrt(max(tr)::DOUBLE * max(tc) / (max(tr) + max(tc))) * max(abs(cr / tr - cc / tc)) AS lam
       FROM cum WHERE "column" = 'value'),
chi AS (SELECT sum((nc - nr::DOUBLE * tc / tr) ^ 2 / (nr::DOUBLE * tc / tr)) AS x2 FROM st),
pr AS (SELECT max(nr) FILTER (WHERE v = f) AS x, max(nc) FILTER (WHERE v = f) AS y, max(tr) AS a, max(tc) AS b
       FROM st, (SELECT min(v) AS f FROM st)),
z AS (SELECT (y / b - x / a) / sqrt((x + y) / (a + b) * (1 - (x + y) / (a + b)) * (1 / a + 1 / b)) AS z FROM pr),
tests AS (
  SELECT 'value' AS "column", 'ks' AS test, statistic, """ + _KS_P + """ AS p_value FROM ks
  UNION ALL SELECT 'event_type', 'chi2', x2, exp(-x2 / 2) * (1 + x2 / 2) FROM chi)
SELECT "column", test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM tests
UNION ALL SELECT 'is_first_type', 'proportion', round(z, 6), NULL, abs(z) > 1.959963984540054 FROM z""")
def column_drift_tests(spark, d):
    """The tests by name; the normal tail has no SQL, so its flag stands for it."""
    out = M.column_drift(_tested_events(spark, d), ["value"], ["event_type", "is_first_type"], methods=_TESTED)
    out = out.withColumn("p_value", F.when(F.col("test") != "proportion", F.col("p_value")))
    return rounded(out, {"statistic": 6, "p_value": 6})


# Identical data: no formula is needed to know the answer.
@query("drift_identical", """
SELECT * FROM (VALUES
  ('value', 'ks', 0.0, 1.0, false), ('user_id', 'wasserstein', 0.0, NULL, false),
  ('event_type', 'chi2', 0.0, 1.0, false), ('kind', 'jensen_shannon', 0.0, NULL, false)
) t("column", test, statistic, p_value, drifted)""")
def drift_identical(spark, d):
    e = table(spark, d, "events").select("user_id", "value", "event_type", F.col("event_type").alias("kind"))
    out = M.column_drift(M.tag(e, e), ["value", "user_id"], ["event_type", "kind"],
                         methods={"value": "ks", "event_type": "chi2"})
    return rounded(out, {"statistic": 6, "p_value": 6})


@query("drift_reference_only", """
SELECT unnest(['value', 'user_id', 'event_type', 'kind']) AS "column",
       unnest(['ks', 'wasserstein', 'chi2', 'jensen_shannon']) AS test,
       CAST(NULL AS DOUBLE) AS statistic, CAST(NULL AS DOUBLE) AS p_value, false AS drifted""")
def drift_reference_only(spark, d):
    e = table(spark, d, "events").select("user_id", "value", "event_type", F.col("event_type").alias("kind"))
    return M.column_drift(M.tag(e, None), ["value", "user_id"], ["event_type", "kind"],
                          methods={"value": "ks", "event_type": "chi2"})


@query("data_summary", "WITH " + V_EVENTS_TAGGED + """,
l AS (SELECT dataset, 'value' AS "column", CAST(value AS DOUBLE) AS x, CAST(value AS VARCHAR) AS s FROM v_tagged
      UNION ALL SELECT dataset, 'user_id', CAST(user_id AS DOUBLE), CAST(user_id AS VARCHAR) FROM v_tagged
      UNION ALL SELECT dataset, 'event_type', NULL, event_type FROM v_tagged)
SELECT dataset, "column", count(*) AS n_rows, count_if(s IS NULL) AS n_missing, count(DISTINCT s) AS n_distinct,
       round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max
FROM l GROUP BY 1, 2""")
def data_summary(spark, d):
    out = M.data_summary(v_events_tagged(spark, d), DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    return rounded(out, {"mean": 4, "std": 4, "min": 6, "max": 6})


@query("report_metadata", "WITH " + V_EVENTS_TAGGED + f"""
SELECT count_if(dataset = 'reference') AS reference_samples, count_if(dataset = 'current') AS current_samples,
       3 AS n_features,
       CASE WHEN count_if(dataset = 'current') > 0 THEN 'reference_vs_current' ELSE 'reference_only' END
         AS analysis_type,
       '{GENERATED_AT}' AS generated_at
FROM v_tagged""")
def report_metadata(spark, d):
    return M.report_metadata(v_events_tagged(spark, d), len(DRIFT_NUMERIC + DRIFT_CATEGORICAL),
                             generated_at=GENERATED_AT)


def _requested_and_existing(spark, d):
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_type")
    requested = e.select("day").distinct()
    existing = (e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
                .select("day", "event_type").distinct())
    return requested, existing


@query("report_idempotent", """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, ts, event_type FROM events),
req AS (SELECT DISTINCT day FROM e),
ex AS (SELECT day, count(*) AS n FROM (SELECT DISTINCT day, event_type FROM e WHERE ts < TIMESTAMP '2024-01-16')
       GROUP BY day)
SELECT r.day, CASE WHEN coalesce(ex.n, 0) > 0 THEN 'skipped' ELSE 'created' END AS status,
       CASE WHEN coalesce(ex.n, 0) > 0 THEN 'reports already exist' ELSE 'new' END AS reason,
       coalesce(ex.n, 0) AS existing_reports
FROM req r LEFT JOIN ex USING (day)""")
def report_idempotent(spark, d):
    requested, existing = _requested_and_existing(spark, d)
    return M.idempotent_runs(requested, existing, ["day"])


@query("metric_trend", "WITH " + V_RUNS + """
SELECT strftime(day, '%Y-%m-%d') AS day, 'events' AS project, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       round(mae, 6) AS mae, n,
       round(rmse - lag(rmse) OVER (ORDER BY day), 6) AS rmse_change,
       round(r2 - lag(r2) OVER (ORDER BY day), 6) AS r2_change,
       round(mae - lag(mae) OVER (ORDER BY day), 6) AS mae_change
FROM v_runs""")
def metric_trend(spark, d):
    runs = v_runs(spark, d).withColumn("project", F.lit("events"))
    out = M.metric_trend(runs, "day", ["rmse", "r2", "mae"], by=["project"])
    out = out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
    return rounded(out, {c: 6 for c in ["rmse", "r2", "mae", "rmse_change", "r2_change", "mae_change"]})


@query("stream_period_report", """
WITH pk AS (SELECT user_id, avg(value) AS p FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
ov AS (SELECT avg(value) AS f FROM events WHERE ts < TIMESTAMP '2024-01-16'),
s AS (SELECT strftime(e.ts, '%Y-%m-%d') AS period, e.value AS y, coalesce(pk.p, ov.f) - e.value AS e
      FROM events e LEFT JOIN pk USING (user_id), ov)
SELECT period, count(*) AS n, round(sqrt(sum(e * e) / count(*)), 6) AS rmse,
       round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
       round(sum(abs(e)) / count(*), 6) AS mae, round(sum(e) / count(*), 6) + 0.0 AS mean_error
FROM s GROUP BY 1""")
def stream_period_report(spark, d):
    """Daily performance reports produced by the streaming monitor over day folders."""
    from pyspark.sql import types as T

    from tilth.session import scratch_path
    from tilth.streaming.monthly import period_reports, run_period_monitor
    e = table(spark, d, "events")
    files = scratch_path(spark, "events-by-day")
    (e.select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("period"))
     .write.partitionBy("period").parquet(files))
    model = M.group_mean_model(v_events_reference(spark, d), "user_id", "value")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("value", T.DoubleType()), T.StructField("period", T.StringType())])
    reports = scratch_path(spark, "period-reports")
    run_period_monitor(spark, files, schema, model, "user_id", "value", "period", reports,
                       scratch_path(spark, "period-stream-ckpt"), max_files_per_trigger=100)
    return rounded(period_reports(spark, reports, "period"), {c: 6 for c in ["rmse", "r2", "mae", "mean_error"]})
