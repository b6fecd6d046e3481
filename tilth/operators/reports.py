"""Report parsing, comparison and alerts.

Reports are nested JSON documents (metric id -> display name, widgets with
counters, direct value, mean, count).  Parsing is a walk without a schema (``walk_reports``)
or, for documents of the known form, ``from_json`` + ``posexplode``; choosing a value is an aggregate over (report, metric, side); comparing the
oldest and newest report of each project is ``min_by`` / ``max_by``.  Nothing
is looped over on the driver, so any number of projects and reports works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.text import parse_number, parse_timestamp
from tilth.operators.jsonwalk import is_json, walk_json

COUNTER = T.StructType([T.StructField("value", T.StringType()), T.StructField("label", T.StringType())])
WIDGET = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("params", T.StructType([T.StructField("counters", T.ArrayType(COUNTER))]))])
VALUE_BOX = T.StructType([T.StructField("value", T.StringType())])
METRIC = T.StructType([
    T.StructField("display_name", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("widget", T.ArrayType(WIDGET)), T.StructField("mean", VALUE_BOX),
    T.StructField("count", VALUE_BOX)])
REPORT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("metric_results", T.MapType(T.StringType(), METRIC)),
    T.StructField("report", T.StructType([T.StructField("metric_results", T.MapType(T.StringType(), METRIC))]))])

METRICS = ("rmse", "r2", "mae")
# Per-metric degradation thresholds (fractions) used by default.
DEFAULT_THRESHOLDS = {"rmse": 0.05, "r2": 0.05, "mae": 0.05}


def parse_reports(df: DataFrame, json_col: str = "json") -> DataFrame:
    """JSON text column -> typed report columns.  The metrics stand at the top or under
    ``report``; ``metric_text`` keeps their original JSON, fields outside the schema included."""
    text = F.coalesce(F.get_json_object(json_col, "$.metric_results"),
                      F.get_json_object(json_col, "$.report.metric_results"))
    r = F.from_json(F.col(json_col), REPORT_SCHEMA)
    return df.select(*[c for c in df.columns if c != json_col], r.alias("_r"), text.alias("metric_text")).select(
        *[c for c in df.columns if c != json_col],
        F.col("_r.id").alias("report_id"), F.col("_r.timestamp").alias("timestamp"),
        F.col("_r.name").alias("name"), F.coalesce("_r.metric_results", "_r.report.metric_results").alias("metric_results"), "metric_text")


def classify_metric(display: F.Column) -> F.Column:
    d = F.lower(F.coalesce(display, F.lit("")))
    return (F.when(d.contains("rmse"), "rmse")
            .when(d.contains("r2") | d.contains("r-squared"), "r2")
            .when(d.contains("mean absolute error") | d.contains("mae"), "mae"))


def report_metrics(reports: DataFrame) -> DataFrame:
    """Long table of every numeric reading: (report_id, metric, side, position, value).

    Side: widget title with 'current'/'reference'; else the counter label ('value'
    for labels with 'mean', 'score' or empty); direct value and mean -> 'value';
    count -> 'count'.  Position orders readings as the document lists them."""
    m = reports.select("report_id", F.posexplode("metric_results").alias("m_pos", "metric_id", "m"))
    m = m.withColumn("metric", classify_metric(F.col("m.display_name"))).where(F.col("metric").isNotNull())
    w = m.select("report_id", "metric", "m_pos", F.posexplode("m.widget").alias("w_pos", "w"))
    c = w.select("report_id", "metric", "m_pos", "w_pos", F.lower(F.coalesce("w.title", F.lit(""))).alias("title"),
                 F.posexplode("w.params.counters").alias("c_pos", "c"))
    label = F.lower(F.coalesce(F.col("c.label"), F.lit("")))
    side = (F.when(F.col("title").contains("current"), "current")
            .when(F.col("title").contains("reference"), "reference")
            .when(label.contains("mean") | (label == "") | label.contains("score"), "value")
            .otherwise(label))
    raw = F.when(F.col("c.value").isNull() | (F.col("c.value") == ""), F.col("c.label")).otherwise(F.col("c.value"))
    counters = c.select("report_id", "metric", side.alias("side"), "m_pos", F.lit(0).alias("kind"),
                        "w_pos", "c_pos", parse_number(raw).alias("value"))

    def direct(field, kind, side_name):
        return m.select("report_id", "metric", F.lit(side_name).alias("side"), "m_pos", F.lit(kind).alias("kind"),
                        F.lit(0).alias("w_pos"), F.lit(0).alias("c_pos"), parse_number(F.col(field)).alias("value"))

    out = (counters.unionByName(direct("m.value", 1, "value")).unionByName(direct("m.mean.value", 2, "value"))
           .unionByName(direct("m.count.value", 3, "count")))
    return out.where(F.col("value").isNotNull())


RESULTS = "metric_results"
_HANDED = ("display_name", "title", "label", "value")


def walk_reports(df: DataFrame, json_col: str = "json") -> DataFrame:
    """JSON text column -> report columns (report_id, timestamp, name, ``malformed``) and the
    ``fields`` of its metric results, wherever in the document they lie (of several, the
    least deep that are not empty).  No schema: layers around the results, the widgets or the
    counters may be unknown.  A malformed or null document is a row without fields."""
    own = [c for c in df.columns if c != json_col]
    top = lambda name: F.get_json_object(json_col, f"$.{name}").alias(name)
    walked = walk_json(df.select(*own, F.get_json_object(json_col, "$.id").alias("report_id"), top("timestamp"), top("name"),
                                 (~F.coalesce(is_json(F.col(json_col)), F.lit(False))).alias("malformed"), json_col),
                       json_col, _HANDED, levels=14)
    depth = lambda f: F.array_position(f["path"], RESULTS)
    held = F.filter("fields", lambda f: (depth(f) > 0) & (F.size(f["path"]) > depth(f)))
    least = F.array_min(F.transform(held, depth))
    return walked.withColumn("fields", held).withColumn("results_depth", least).withColumn(
        "fields", F.filter("fields", lambda f: depth(f) == F.col("results_depth")))


def walked_metrics(reports: DataFrame) -> DataFrame:
    """The readings of ``report_metrics`` from walked reports.

    A metric is an object with a ``display_name`` below the metric results.  Its readings are
    the objects of any ``counters`` array below it (side by the title of the nearest object
    around, inside the metric), its own ``value``, and the ``value`` of ``mean`` and ``count``
    objects below it.  Positions order readings as the document lists them."""
    f = reports.select("report_id", "results_depth", F.explode("fields").alias("f"))
    display, title = F.col("f.inherited.display_name"), F.col("f.inherited.title")
    label, value = F.col("f.inherited.label"), F.col("f.inherited.value")
    f = f.withColumn("metric", classify_metric(display["text"])).where(
        F.col("metric").isNotNull() & (display["depth"] >= F.col("results_depth")))
    size = F.size("f.path")
    step = lambda back: F.get(F.col("f.path"), size - back)
    mine = lambda c: F.when(c["depth"] == size - 1, c["text"])
    counter = (F.coalesce(step(3) == "counters", F.lit(False)) & (size - 3 >= display["depth"]))
    empty = F.coalesce(mine(value), F.lit("")) == ""
    read = (F.when(counter, (step(1) == "value") & ~empty | (step(1) == "label") & empty)
            .otherwise((step(1) == "value") & ((size - 1 == display["depth"])
                                               | (step(2).isin("mean", "count") & (size - 2 >= display["depth"])))))
    own_title = F.lower(F.coalesce(F.when(title["depth"] > display["depth"], title["text"]), F.lit("")))
    own_label = F.lower(F.coalesce(mine(label), F.lit("")))
    counter_side = (F.when(own_title.contains("current"), "current").when(own_title.contains("reference"), "reference")
                    .when(own_label.contains("mean") | (own_label == "") | own_label.contains("score"), "value")
                    .otherwise(own_label))
    direct = size - 1 == display["depth"]
    kind = F.when(counter, 0).when(direct, 1).when(step(2) == "mean", 2).otherwise(3)
    side = F.when(counter, counter_side).when(~direct & (step(2) == "count"), "count").otherwise("value")
    return f.where(read).select(
        "report_id", "metric", side.alias("side"), F.slice("f.place", F.lit(1), display["depth"]).alias("m_pos"),
        kind.alias("kind"), F.col("f.place").alias("w_pos"), F.lit(0).alias("c_pos"),
        parse_number(F.col("f.text")).alias("value")).where(F.col("value").isNotNull())


def walked_drift(reports: DataFrame) -> DataFrame:
    """``drift_flag`` over the fields of walked reports: their keys and texts are the text."""
    says = lambda word: F.exists("fields", lambda f: (
        F.lower(F.concat_ws("\n", F.slice(f["path"], F.col("results_depth").cast("int") + 1, F.size(f["path"])), f["text"])).contains(word)))
    scored = F.exists("fields", lambda f: (F.lower(F.get(f["path"], F.size(f["path"]) - 1)) == "drift_score")
                      & F.coalesce(f["text"].try_cast("double") > 0, F.lit(False)))
    return reports.select("report_id", F.coalesce(says("drift") & (says("detected") | scored), F.lit(False)).alias("drift_detected"))


def metric_choice(readings: DataFrame, reports: DataFrame) -> DataFrame:
    """Per report: <metric>_current, <metric>_reference and the chosen <metric>
    (current, else value, else reference); the last reading of a side wins."""
    pos = F.struct("m_pos", "kind", "w_pos", "c_pos")
    last = readings.groupBy("report_id", "metric", "side").agg(F.max_by("value", pos).alias("v"))
    cols = []
    for m in METRICS:
        pick = lambda s: F.max(F.when((F.col("metric") == m) & (F.col("side") == s), F.col("v")))
        cols += [pick("current").alias(f"{m}_current"), pick("reference").alias(f"{m}_reference"),
                 F.coalesce(pick("current"), pick("value"), pick("reference")).alias(m)]
    per = last.groupBy("report_id").agg(*cols)
    return reports.select("report_id").join(per, "report_id", "left")


def drift_flag(reports: DataFrame) -> DataFrame:
    """Text rule over the original metric results: 'drift' and ('detected' or a drift_score
    above 0)."""
    text = F.col("metric_text") if "metric_text" in reports.columns else F.to_json("metric_results")
    dump = F.lower(F.coalesce(text, F.lit("")))
    score = F.array_max(F.transform(F.regexp_extract_all(dump, F.lit(r'"drift_score"\s*:\s*"?([0-9.e+-]+)'), 1),
                                    lambda x: x.try_cast("double")))
    flag = dump.contains("drift") & (dump.contains("detected") | F.coalesce(score > 0, F.lit(False)))
    return reports.select("report_id", flag.alias("drift_detected"))


def summarize(reports: DataFrame, by: list[str]) -> DataFrame:
    """One row per report (parsed or walked): keys, parsed timestamp, chosen metrics, drift flag,
    usable.  Reports without an id are left out."""
    walked = "results_depth" in reports.columns
    chosen = metric_choice((walked_metrics if walked else report_metrics)(reports), reports)
    drift = (walked_drift if walked else drift_flag)(reports)
    s = (reports.select(*by, "report_id", "timestamp", parse_timestamp(F.col("timestamp")).alias("ts"))
         .join(chosen, "report_id").join(drift, "report_id"))
    usable = F.col("rmse").isNotNull() | F.col("r2").isNotNull() | F.col("mae").isNotNull() | F.col("drift_detected")
    return s.withColumn("usable", usable)


def baseline_current(summary: DataFrame, by: list[str]) -> DataFrame:
    """Oldest usable report as baseline, newest as current (ties broken by report id)."""
    rec = F.struct("report_id", "timestamp", "ts", *METRICS, "drift_detected")
    order = F.struct("ts", "report_id")
    g = summary.where("usable").groupBy(*by).agg(F.min_by(rec, order).alias("baseline"),
                                                  F.max_by(rec, order).alias("current"),
                                                  F.count(F.lit(1)).alias("n_reports"))
    return g


def metric_changes(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Long table per metric: baseline, current, absolute and percent change, direction."""
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"baseline.{m}").alias("baseline"),
                                        F.col(f"current.{m}").alias("current")) for m in METRICS])).alias("kv")
    long = pairs.select(*by, rows).select(*by, "kv.*").where(
        F.col("baseline").isNotNull() | F.col("current").isNotNull())
    b, c = F.col("baseline"), F.col("current")
    known = b.isNotNull() & c.isNotNull()
    diff = c - b
    pct = F.when(~known, F.lit(None).cast("double")).when(b == 0, F.when(c != 0, F.lit(float("inf"))).otherwise(0.0)) \
        .otherwise(diff / F.abs(b) * 100.0)
    better = F.when(F.col("metric") == "r2", diff > 0).otherwise(diff < 0)
    worse = F.when(F.col("metric") == "r2", diff < 0).otherwise(diff > 0)
    direction = (F.when(~known, "unknown").when(better, "improvement").when(worse, "degradation")
                 .otherwise("no_change"))
    return long.select(*by, "metric", "baseline", "current", F.when(known, diff).alias("absolute_change"),
                       pct.alias("percentage_change"), direction.alias("direction"))


def thresholds_table(spark, thresholds: dict[str, float] | None = None) -> DataFrame:
    t = thresholds or DEFAULT_THRESHOLDS
    return spark.createDataFrame(sorted(t.items()), "metric string, threshold double")


def degradation_alerts(changes: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics whose change is a degradation larger than its threshold (strict), as percent."""
    j = changes.join(F.broadcast(thresholds), "metric")
    return j.where((F.col("direction") == "degradation")
                   & (F.abs(F.col("percentage_change")) > F.col("threshold") * 100))


def drift_transition(pairs: DataFrame, by: list[str]) -> DataFrame:
    bd = F.coalesce(F.col("baseline.drift_detected"), F.lit(False))
    cd = F.coalesce(F.col("current.drift_detected"), F.lit(False))
    status = (F.when(cd & ~bd, "new_drift").when(bd & ~cd, "resolved").when(bd & cd, "persisting")
              .otherwise("none"))
    return pairs.select(*by, F.col("baseline.report_id").alias("baseline_report"),
                        F.col("current.report_id").alias("current_report"),
                        bd.alias("baseline_drift"), cd.alias("current_drift"), status.alias("transition"))


# Alert subjects and headlines.
DRIFT_SUBJECT = "ML Model Alert: Data Drift Detected"
PERF_SUBJECT = "ML Model Alert: Performance Degradation"
DRIFT_HEADLINE = "DATA DRIFT DETECTED"
PERF_HEADLINE = "PERFORMANCE DEGRADATION DETECTED"
METRIC_LINE = "%s: %.6f -> %.6f (%+.2f%%, threshold: +/-%.1f%%)"


def alert_rows(pairs: DataFrame, alerts: DataFrame, transitions: DataFrame, by: list[str]) -> DataFrame:
    """One row per alert message: drift alerts for new drift, one performance alert per
    project listing every degraded metric."""
    drift = transitions.where(F.col("transition") == "new_drift").select(
        *by, F.lit("drift").alias("alert_type"), F.lit(DRIFT_SUBJECT).alias("subject"),
        F.concat(F.lit(DRIFT_HEADLINE + "\n\nBaseline report: "), F.col("baseline_report"),
                 F.lit(" (no drift)\nCurrent report: "), F.col("current_report"),
                 F.lit(" (drift detected)")).alias("message"))
    line = F.format_string(METRIC_LINE, F.upper("metric"),
                           F.col("baseline"), F.col("current"), F.col("percentage_change"),
                           F.col("threshold") * 100)
    perf = alerts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("metric", line.alias("line")))).alias("ls"))
    perf = perf.join(pairs.select(*by, F.col("baseline.report_id").alias("b"), F.col("current.report_id").alias("c")), by)
    perf = perf.select(*by, F.lit("performance").alias("alert_type"), F.lit(PERF_SUBJECT).alias("subject"),
                       F.concat(F.lit(PERF_HEADLINE + "\n\n"),
                                F.concat_ws("\n", F.transform("ls", lambda x: x["line"])),
                                F.lit("\n\nBaseline report: "), F.col("b"), F.lit("\nCurrent report: "),
                                F.col("c")).alias("message"))
    return drift.unionByName(perf)


def alert_route(pairs: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("alert_count"))
    j = pairs.select(*by).join(counts, by, "left").fillna(0, subset=["alert_count"])
    return j.withColumn("route", F.when(F.col("alert_count") > 0, "notify").otherwise("no_action"))
