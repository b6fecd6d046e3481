"""Report keys.

``v_reports``: one nested JSON report per (project = event_type, day) built by
Spark from ``events``: current RMSE and the project's reference RMSE as widget
counters, R2 as a direct value, MAE as a mean with a count, and a drift entry (a
text or a ``drift_score``).  By the day of month the metric results stand at the top,
under ``report`` or under layers no schema knows, counters lie deeper, and numbers
and timestamps (with UTC offsets too) are written in several formats.  The oracle derives
the expected values from ``events``, not from a parser's rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.text import parse_number, parse_timestamp
from tilth.operators import reports as R
from tilth.plans.bindings import table
from tilth.plans.catalog import query, rounded
from tilth.session import materialize, scratch_path
from tilth.sources import files as S

BY = ["project"]


def _fmt(x, dom):
    plain = F.format_string("%.4f", x)
    return (F.when(dom % 3 == 0, plain).when(dom % 3 == 1, F.regexp_replace(plain, "[.]", ","))
            .otherwise(F.format_string("%.4e", x)))


def _ts_text(t, dom):
    return (F.when(dom % 4 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(dom % 4 == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(dom % 4 == 2, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .when(dom % 8 == 3, F.concat(F.date_format(t + F.make_dt_interval(hours=F.lit(5), mins=F.lit(30)),
                                                       "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def report_inputs(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("project"), F.to_date("ts").alias("day"),
                                         "ts", "user_id", F.col("value").alias("y"))
    um = e.groupBy("user_id").agg(F.avg("y").alias("pred"))
    s = e.join(um, "user_id")
    err2 = F.pow(F.col("y") - F.col("pred"), 2)
    per_day = s.groupBy("project", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err2)).alias("rmse"),
        (1 - F.try_divide(F.sum(err2), F.var_pop("y") * F.count(F.lit(1))))
        .alias("r2"),
        F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"), F.max("ts").alias("t_end"))
    ref = s.groupBy("project").agg(F.sqrt(F.avg(err2)).alias("rmse_ref"))
    return per_day.join(ref, "project").withColumn("dom", F.dayofmonth("day")).withColumn(
        "report_id", F.concat_ws("-", "project", F.date_format("day", "yyyy-MM-dd")))


def v_reports(spark, d):
    """(report_id, project, json): the report documents."""
    r = report_inputs(spark, d)
    dom = F.col("dom")
    none = F.lit(None)

    shape = T.StructType(R.METRIC.fields + [
        T.StructField("drift_score", T.DoubleType()),
        T.StructField("body", T.StructType([T.StructField("panels", R.METRIC["widget"].dataType)]))])

    def metric(display, value=none, widget=none, mean=none, count=none, score=none, panels=none):
        return F.struct(F.lit(display).alias("display_name"), value.cast("string").alias("value"),
                        widget.alias("widget"), mean.alias("mean"), count.alias("count"), score.alias("drift_score"),
                        F.when(panels.isNotNull(), F.struct(panels.alias("panels"))).alias("body")).cast(shape)

    def counter_widget(title, v):
        return F.struct(F.lit(title).alias("title"), F.struct(F.array(F.struct(
            _fmt(v, dom).alias("value"), F.lit("RMSE").alias("label"))).alias("counters")).alias("params"))

    drifted = F.col("rmse") > 1.1 * F.col("rmse_ref")
    widgets = F.array(counter_widget("Current", F.col("rmse")), counter_widget("Reference", F.col("rmse_ref")))
    deeper, scored = dom % 6 == 5, dom % 2 == 1
    results = F.create_map(
        F.lit("m_rmse"), metric("RMSE", widget=F.when(~deeper, widgets), panels=F.when(deeper, widgets)),
        F.lit("m_r2"), metric("R2 Score", value=_fmt(F.col("r2"), dom)),
        F.lit("m_mae"), metric("Mean Absolute Error", mean=F.struct(_fmt(F.col("mae"), dom).alias("value")),
                               count=F.struct(F.col("n").cast("string").alias("value"))),
        F.lit("m_drift"), metric(
            "Share of Drifted Columns",
            value=F.when(scored, F.lit("0.0")).when(drifted, F.lit("Drift detected")).otherwise(F.lit("0.0")),
            score=F.when(scored, F.when(drifted, F.col("rmse") / F.col("rmse_ref") - 1).otherwise(F.lit(0.0)))))
    doc = F.struct(F.col("report_id").alias("id"), _ts_text(F.col("t_end"), dom).alias("timestamp"),
                   F.concat(F.lit("Performance "), F.col("project")).alias("name"),
                   F.when(dom % 3 == 0, results).alias("metric_results"),
                   F.when(dom % 3 == 1, F.struct(results.alias("metric_results"))).alias("report"),
                   F.when(dom % 3 == 2, F.struct(F.array(F.struct(F.struct(results.alias("metric_results")).alias("body"))).alias(
                       "versions"))).alias("payload"))
    return r.select("report_id", "project", F.to_json(doc).alias("json"))


def reports_table(spark, d):
    """Walked reports, stored once (they are documents at rest, read by every comparison)."""
    return materialize(R.walk_reports(v_reports(spark, d).drop("report_id")))


def _summary(spark, d):
    """Stored too: changes, transitions and messages all start from it."""
    return materialize(R.summarize(reports_table(spark, d), BY))


def _pairs(spark, d):
    return R.baseline_current(_summary(spark, d), BY)


# ---- oracle side -------------------------------------------------------------

def _fmt_sql(x):
    plain = f"printf('%.4f', {x})"
    return (f"(CASE WHEN dom % 3 = 0 THEN {plain} WHEN dom % 3 = 1 THEN replace({plain}, '.', ',') "
            f"ELSE printf('%.4e', {x}) END)")


_TS_SQL = """(CASE WHEN dom % 4 = 0 THEN strftime(t_end, '%Y-%m-%dT%H:%M:%S.%fZ')
  WHEN dom % 4 = 1 THEN strftime(t_end, '%Y-%m-%dT%H:%M:%S')
  WHEN dom % 4 = 2 THEN strftime(t_end, '%Y-%m-%d %H:%M:%S')
  WHEN dom % 8 = 3 THEN strftime(t_end + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30'
  ELSE strftime(t_end, '%Y-%m-%dT%H:%M:%SZ') END)"""

def _written(x):
    """The number a text was written from, to the digits written (not a parser's rule)."""
    return f"CAST(CASE WHEN dom % 3 = 2 THEN printf('%.4e', {x}) ELSE printf('%.4f', {x}) END AS DOUBLE)"


RI = f"""um AS (SELECT user_id, avg(value) AS pred FROM events GROUP BY 1),
s AS (SELECT e.event_type AS project, CAST(e.ts AS DATE) AS day, e.ts, e.value AS y, um.pred
      FROM events e JOIN um USING (user_id)),
pd AS (SELECT project, day, count(*) AS n, sqrt(avg((y - pred) ^ 2)) AS rmse,
              1 - sum((y - pred) ^ 2) / nullif(var_pop(y) * count(*), 0) AS r2,
              avg(abs(y - pred)) AS mae, max(ts) AS t_end FROM s GROUP BY 1, 2),
rf AS (SELECT project, sqrt(avg((y - pred) ^ 2)) AS rmse_ref FROM s GROUP BY 1),
ri0 AS (SELECT pd.*, rf.rmse_ref, dayofmonth(day) AS dom,
               project || '-' || strftime(day, '%Y-%m-%d') AS report_id FROM pd JOIN rf USING (project)),
ri AS (SELECT *, {_fmt_sql('rmse')} AS rmse_txt, {_fmt_sql('rmse_ref')} AS ref_txt, {_fmt_sql('r2')} AS r2_txt,
              {_fmt_sql('mae')} AS mae_txt, {_TS_SQL} AS ts_txt, rmse > 1.1 * rmse_ref AS drift FROM ri0),
rp AS (SELECT *, {_written('rmse')} AS rmse_cur_v, {_written('rmse_ref')} AS rmse_ref_v,
              {_written('r2')} AS r2_v, {_written('mae')} AS mae_v,
              CASE WHEN dom % 4 = 0 THEN t_end ELSE date_trunc('second', t_end) END AS ts_v FROM ri),
usable AS (SELECT * FROM rp WHERE rmse_cur_v IS NOT NULL OR rmse_ref_v IS NOT NULL OR r2_v IS NOT NULL
           OR mae_v IS NOT NULL OR drift),
bc AS (SELECT project, arg_min(report_id, (ts_v, report_id)) AS b_id, arg_max(report_id, (ts_v, report_id)) AS c_id,
              count(*) AS n_reports FROM usable GROUP BY 1),
pairs AS (SELECT bc.project, bc.n_reports, b.report_id AS b_id, b.ts_txt AS b_ts, b.drift AS b_drift,
                 coalesce(b.rmse_cur_v, b.rmse_ref_v) AS b_rmse, b.r2_v AS b_r2, b.mae_v AS b_mae,
                 c.report_id AS c_id, c.ts_txt AS c_ts, c.drift AS c_drift,
                 coalesce(c.rmse_cur_v, c.rmse_ref_v) AS c_rmse, c.r2_v AS c_r2, c.mae_v AS c_mae
          FROM bc JOIN rp b ON b.report_id = bc.b_id JOIN rp c ON c.report_id = bc.c_id),
ch0 AS (SELECT project, 'rmse' AS metric, b_rmse AS baseline, c_rmse AS current FROM pairs
        UNION ALL SELECT project, 'r2', b_r2, c_r2 FROM pairs
        UNION ALL SELECT project, 'mae', b_mae, c_mae FROM pairs),
ch AS (SELECT project, metric, baseline, current,
              CASE WHEN baseline IS NOT NULL AND current IS NOT NULL THEN current - baseline END AS absolute_change,
              CASE WHEN baseline IS NULL OR current IS NULL THEN NULL
                   WHEN baseline = 0 THEN (CASE WHEN current <> 0 THEN 'inf'::DOUBLE ELSE 0.0 END)
                   ELSE (current - baseline) / abs(baseline) * 100.0 END AS percentage_change,
              CASE WHEN baseline IS NULL OR current IS NULL THEN 'unknown'
                   WHEN (metric = 'r2' AND current > baseline) OR (metric <> 'r2' AND current < baseline)
                     THEN 'improvement'
                   WHEN (metric = 'r2' AND current < baseline) OR (metric <> 'r2' AND current > baseline)
                     THEN 'degradation'
                   ELSE 'no_change' END AS direction
       FROM ch0 WHERE baseline IS NOT NULL OR current IS NOT NULL),
al AS (SELECT ch.*, 0.05 AS threshold FROM ch WHERE direction = 'degradation' AND abs(percentage_change) > 5.0),
tr AS (SELECT project, b_id AS baseline_report, c_id AS current_report, b_drift AS baseline_drift,
              c_drift AS current_drift,
              CASE WHEN c_drift AND NOT b_drift THEN 'new_drift' WHEN b_drift AND NOT c_drift THEN 'resolved'
                   WHEN b_drift AND c_drift THEN 'persisting' ELSE 'none' END AS transition FROM pairs),
rows AS (
  SELECT project, 'drift' AS alert_type, '{R.DRIFT_SUBJECT}' AS subject,
         'DATA DRIFT DETECTED' || chr(10) || chr(10) || 'Baseline report: ' || baseline_report || ' (no drift)'
           || chr(10) || 'Current report: ' || current_report || ' (drift detected)' AS message
  FROM tr WHERE transition = 'new_drift'
  UNION ALL
  SELECT al.project, 'performance', '{R.PERF_SUBJECT}',
         'PERFORMANCE DEGRADATION DETECTED' || chr(10) || chr(10)
           || string_agg(printf('%s: %.6f -> %.6f (%+.2f%%, threshold: +/-%.1f%%)', upper(al.metric), al.baseline,
                                al.current, al.percentage_change, al.threshold * 100), chr(10) ORDER BY al.metric)
           || chr(10) || chr(10) || 'Baseline report: ' || p.b_id || chr(10) || 'Current report: ' || p.c_id
  FROM al JOIN pairs p USING (project) GROUP BY al.project, p.b_id, p.c_id)"""


def _with(sql: str) -> str:
    return "WITH " + RI + "\n" + sql


@query("report_scan", _with("""
SELECT report_id, 'Performance ' || project AS name, ts_txt AS timestamp, 4 AS n_metrics FROM ri"""))
def report_scan(spark, d):
    path = scratch_path(spark, "reports")
    S.write_one_file_per_key(v_reports(spark, d), "report_id", "json", path)
    back = R.walk_reports(spark.read.text(path, wholetext=True).select("value"), "value")
    ids = F.transform("fields", lambda f: F.get(f["path"], F.col("results_depth").cast("int")))
    return back.select("report_id", "name", "timestamp", F.size(F.array_distinct(ids)).alias("n_metrics"))


@query("report_walk", _with("""
SELECT CASE dom % 3 WHEN 0 THEN 'top' WHEN 1 THEN 'report' ELSE 'payload' END AS layer, dom % 7 = 4 AS malformed,
       count(*) AS n_reports, sum(CASE WHEN dom % 7 = 4 THEN 0 ELSE 4 END)::BIGINT AS n_metrics,
       sum(CASE WHEN dom % 7 = 4 THEN 0 WHEN r2 IS NULL THEN 4 ELSE 5 END)::BIGINT AS n_readings
FROM ri GROUP BY ALL"""))
def report_walk(spark, d):
    """Metric results under known and unknown layers; every seventh day's documents are cut short."""
    r = v_reports(spark, d).withColumn("dom", F.dayofmonth(F.to_date(F.right("report_id", F.lit(10)))))
    cut = F.when(F.col("dom") % 7 == 4, F.expr("left(json, length(json) - 5)")).otherwise(F.col("json"))
    layer = F.when(F.col("dom") % 3 == 0, "top").when(F.col("dom") % 3 == 1, "report").otherwise("payload")
    walked = materialize(R.walk_reports(r.select(F.col("report_id").alias("key"), layer.alias("layer"), cut.alias("json"))))
    ids = F.transform("fields", lambda f: F.get(f["path"], F.col("results_depth").cast("int")))
    n = R.walked_metrics(walked).groupBy("report_id").agg(F.count(F.lit(1)).alias("n"))
    return walked.join(n, "report_id", "left").groupBy("layer", "malformed").agg(
        F.count(F.lit(1)).alias("n_reports"), F.sum(F.greatest(F.size(F.array_distinct(ids)), F.lit(0))).alias("n_metrics"),
        F.sum(F.coalesce("n", F.lit(0))).alias("n_readings"))


@query("report_metrics", _with("""
SELECT report_id, 'rmse' AS metric, 'current' AS side, rmse_cur_v AS value FROM rp WHERE rmse_cur_v IS NOT NULL
UNION ALL SELECT report_id, 'rmse', 'reference', rmse_ref_v FROM rp WHERE rmse_ref_v IS NOT NULL
UNION ALL SELECT report_id, 'r2', 'value', r2_v FROM rp WHERE r2_v IS NOT NULL
UNION ALL SELECT report_id, 'mae', 'value', mae_v FROM rp WHERE mae_v IS NOT NULL
UNION ALL SELECT report_id, 'mae', 'count', CAST(n AS DOUBLE) FROM rp"""))
def report_metrics(spark, d):
    return R.walked_metrics(reports_table(spark, d)).select("report_id", "metric", "side", "value")


@query("report_metric_choice", _with("""
SELECT report_id, rmse_cur_v AS rmse_current, rmse_ref_v AS rmse_reference,
       coalesce(rmse_cur_v, rmse_ref_v) AS rmse, CAST(NULL AS DOUBLE) AS r2_current,
       CAST(NULL AS DOUBLE) AS r2_reference, r2_v AS r2, CAST(NULL AS DOUBLE) AS mae_current,
       CAST(NULL AS DOUBLE) AS mae_reference, mae_v AS mae FROM rp"""))
def report_metric_choice(spark, d):
    rep = reports_table(spark, d)
    return R.metric_choice(R.walked_metrics(rep), rep)


@query("report_drift_flag", _with("SELECT report_id, drift AS drift_detected FROM rp"))
def report_drift_flag(spark, d):
    return R.walked_drift(reports_table(spark, d))


@query("parse_number", _with("SELECT report_id, rmse_txt AS raw, rmse_cur_v AS parsed FROM rp"))
def parse_number_key(spark, d):
    r = report_inputs(spark, d)
    txt = _fmt(F.col("rmse"), F.col("dom"))
    return r.select("report_id", txt.alias("raw"), parse_number(txt).alias("parsed"))


@query("parse_timestamp", _with("""
SELECT report_id, ts_txt AS timestamp, strftime(ts_v, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM rp"""))
def parse_timestamp_key(spark, d):
    rep = reports_table(spark, d)
    return rep.select("report_id", "timestamp", F.date_format(parse_timestamp(F.col("timestamp")),
                                                              "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query("usable_reports", _with("""
SELECT report_id, project, (rmse_cur_v IS NOT NULL OR rmse_ref_v IS NOT NULL OR r2_v IS NOT NULL
                            OR mae_v IS NOT NULL OR drift) AS usable FROM rp"""))
def usable_reports(spark, d):
    return _summary(spark, d).select("report_id", "project", "usable")


@query("baseline_current", _with("""
SELECT project, b_id AS baseline_report, b_ts AS baseline_timestamp, c_id AS current_report,
       c_ts AS current_timestamp, n_reports FROM pairs"""))
def baseline_current(spark, d):
    p = _pairs(spark, d)
    return p.select("project", F.col("baseline.report_id").alias("baseline_report"),
                    F.col("baseline.timestamp").alias("baseline_timestamp"),
                    F.col("current.report_id").alias("current_report"),
                    F.col("current.timestamp").alias("current_timestamp"), "n_reports")


_CH_ROUND = {"baseline": 6, "current": 6, "absolute_change": 6, "percentage_change": 4}


@query("metric_change", _with("""
SELECT project, metric, round(baseline, 6) AS baseline, round(current, 6) AS current,
       round(absolute_change, 6) AS absolute_change, round(percentage_change, 4) AS percentage_change, direction
FROM ch"""))
def metric_change(spark, d):
    return rounded(R.metric_changes(_pairs(spark, d), BY), _CH_ROUND)


@query("degradation_alerts", _with("""
SELECT project, metric, round(baseline, 6) AS baseline, round(current, 6) AS current,
       round(percentage_change, 4) AS percentage_change, threshold FROM al"""))
def degradation_alerts(spark, d):
    ch = R.metric_changes(_pairs(spark, d), BY)
    al = R.degradation_alerts(ch, R.thresholds_table(spark))
    return rounded(al.select("project", "metric", "baseline", "current", "percentage_change", "threshold"),
                   {"baseline": 6, "current": 6, "percentage_change": 4})


@query("drift_transition", _with("SELECT * FROM tr"))
def drift_transition(spark, d):
    return R.drift_transition(_pairs(spark, d), BY)


def _alerts(spark, d):
    pairs = _pairs(spark, d)
    ch = R.metric_changes(pairs, BY)
    al = R.degradation_alerts(ch, R.thresholds_table(spark))
    return pairs, R.alert_rows(pairs, al, R.drift_transition(pairs, BY), BY)


@query("alert_rows", _with("SELECT * FROM rows"))
def alert_rows(spark, d):
    return _alerts(spark, d)[1]


@query("alert_route", _with("""
SELECT p.project, coalesce(c.n, 0) AS alert_count,
       CASE WHEN coalesce(c.n, 0) > 0 THEN 'notify' ELSE 'no_action' END AS route
FROM pairs p LEFT JOIN (SELECT project, count(*) AS n FROM rows GROUP BY 1) c USING (project)"""))
def alert_route(spark, d):
    pairs, rows = _alerts(spark, d)
    return R.alert_route(pairs, rows, BY)
