"""Structured Streaming period monitor: state accumulates across restarts and the
report table equals the same computation done in batch."""

import os

from pyspark.sql import functions as F

from tilth.streaming import monthly as M

from conftest import SF01


def _model(ref):
    per_key = ref.groupBy("user_id").agg(F.avg("value").alias("_pred"))
    overall = ref.agg(F.avg("value").alias("_fallback"))
    return per_key, overall


def test_period_monitor_matches_batch_across_restarts(spark, tmp_dir):
    events = spark.read.parquet(f"{SF01}/events.parquet").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("day"))
    model = _model(events.where(F.col("day") < F.lit("2024-01-16").cast("date")))
    incoming = os.path.join(tmp_dir, "incoming")
    reports = os.path.join(tmp_dir, "reports")
    ckpt = os.path.join(tmp_dir, "ckpt")
    # every day's rows arrive in two waves, so each period's state is updated after a restart
    first = events.where(F.col("event_id") % 2 == 0)
    second = events.where(F.col("event_id") % 2 == 1)
    first.repartition(4).write.mode("append").parquet(incoming)
    M.run_period_monitor(spark, incoming, events.schema, model, "user_id", "value", "day", reports, ckpt,
                         max_files_per_trigger=2)
    after_first = M.period_reports(spark, reports, "day")
    n_first = {r["day"]: r["n"] for r in after_first.collect()}
    assert n_first == {r["day"]: r["count"] for r in first.groupBy("day").count().collect()}

    second.repartition(3).write.mode("append").parquet(incoming)
    M.run_period_monitor(spark, incoming, events.schema, model, "user_id", "value", "day", reports, ckpt,
                         max_files_per_trigger=2)
    got = {r["day"]: r for r in M.period_reports(spark, reports, "day").collect()}

    per_key, overall = model
    fallback = overall.first()["_fallback"]
    e = (events.join(per_key, "user_id", "left")
         .withColumn("_e", F.coalesce("_pred", F.lit(fallback)) - F.col("value")))
    want = e.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        F.avg(F.abs("_e")).alias("mae"), F.avg("_e").alias("mean_error")).collect()
    assert len(got) == len(want) == events.select("day").distinct().count()
    for w in want:
        g = got[w["day"]]
        assert g["n"] == w["n"]
        for m in ("rmse", "mae", "mean_error"):
            assert abs(g[m] - w[m]) <= 1e-9 * max(1.0, abs(w[m])), (w["day"], m, g[m], w[m])


def test_period_monitor_rerun_without_new_files_changes_nothing(spark, tmp_dir):
    events = spark.read.parquet(f"{SF01}/events.parquet").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("day"))
    model = _model(events)
    incoming, reports, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "rep", "ck"))
    events.repartition(2).write.parquet(incoming)
    for _ in range(2):
        M.run_period_monitor(spark, incoming, events.schema, model, "user_id", "value", "day", reports, ckpt)
    snaps = spark.read.parquet(reports)
    # the second run found no new file: no micro-batch, so no extra snapshot rows
    assert snaps.count() == events.select("day").distinct().count()
