"""Keys of tables that change by commits: each commits several times
under the shared folder, some of them twice, and returns what is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import monitor as M
from tilth.operators import registry as G
from tilth.plans.bindings import table, v_versions
from tilth.plans.catalog import query, rounded
from tilth.plans.q_model import _BASE, run_summary
from tilth.plans.q_registry import _PAIRS_SQL, REGISTERED_AT, REGISTERED_BY, _candidates
from tilth.session import scratch_path
from tilth.sources.committed import CommittedTable

_VERSION = ["model_name", "version", "stage", "run_id", "rmse", "r2"]


@query("registry_commits", "WITH " + _PAIRS_SQL + """,
d AS (SELECT n.*, CASE WHEN n.rmse < 100 AND n.r2 > 0.7 THEN 'Staging' ELSE 'Archived' END AS gate, p.prmse
      FROM newv n LEFT JOIN prod p USING (model_name)),
d2 AS (SELECT *, gate = 'Staging' AND (prmse IS NULL OR coalesce(
               CASE WHEN prmse <> 0 THEN (prmse - rmse) / prmse > 0.05 END, false)) AS promoted FROM d)
SELECT v.model_name, v.version, CASE WHEN d2.promoted AND v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage,
       v.run_id, round(v.rmse, 6) AS rmse, round(v.r2, 6) AS r2
FROM v_versions v LEFT JOIN d2 USING (model_name)
UNION ALL
SELECT model_name, version, CASE WHEN promoted THEN 'Production' ELSE gate END, run_id, round(rmse, 6), round(r2, 6) FROM d2""")
def registry_commits(spark, d):
    """A registry that is written: the versions, then new ones numbered after them (the same run
    twice: registered once), then their promotion, which rewrites the touched models."""
    registry = CommittedTable(spark, scratch_path(spark, "registry"), "model_name")
    registry.commit(lambda now: v_versions(spark, d).select(*_VERSION), token="load")
    candidates = _candidates(spark, d)

    def register(now):
        made = G.append_versions(now, candidates, REGISTERED_BY, REGISTERED_AT)
        return made.withColumn("stage", F.lit("None")).select(*_VERSION)

    def promote(now):
        top = now.groupBy("model_name").agg(F.max("version").alias("version"))
        new = now.where("stage = 'None'").join(top, ["model_name", "version"]).join(
            candidates.select("model_name", "run_id"), ["model_name", "run_id"], "left_semi")
        old = now.join(new.select("model_name", "version"), ["model_name", "version"], "left_anti")
        stages = G.promote(old, new)
        return now.join(stages, ["model_name", "version"]).withColumn("stage", F.col("new_stage")).select(*_VERSION)
    registry.commit(register, token="register")
    registry.commit(register, token="register")
    registry.commit(promote, overwrite=True, token="promote")
    registry.commit(promote, overwrite=True, token="promote")
    return rounded(registry.read(), {"rmse": 6, "r2": 6})


@query("report_commits", """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, ts, event_type, value FROM events),
r AS (SELECT day, count(*) AS n, round(avg(value), 6) AS mean_value, min(ts) < TIMESTAMP '2024-01-16' AS old FROM e GROUP BY day)
SELECT day, CASE WHEN day >= '2024-01-29' THEN 'forced' WHEN old THEN 'first' ELSE 'second' END AS run, n, mean_value FROM r""")
def report_commits(spark, d):
    """Reports by day that are written: a first run up to a day, a second one over all days that
    skips those with a report, a forced one that takes the place of two."""
    events = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    reports = events.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    store = CommittedTable(spark, scratch_path(spark, "reports"), "day")

    def run(name, wanted, force=False):
        def make(now):
            asked = reports.where(wanted)
            if now is not None:
                todo = M.idempotent_runs(asked.select("day"), now.select("day"), ["day"], force).where("status = 'created'")
                asked = asked.join(todo.select("day"), "day", "left_semi")
            return asked.select("day", F.lit(name).alias("run"), "n", "mean_value")
        store.commit(make, overwrite=force, token=name)
    run("first", F.col("day") < "2024-01-16")
    run("second", F.lit(True))
    run("second", F.lit(True))
    run("forced", F.col("day") >= "2024-01-29", force=True)
    return rounded(store.read(), {"mean_value": 6})


@query("run_log", _BASE + """
SELECT unnest(['run-1', 'run-2']) AS run_id, (SELECT count(*) FROM v_split WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM v_split WHERE split = 'val') AS n_val, (SELECT round(b, 6) FROM ols) AS param_slope""")
def run_log(spark, d):
    """Run summaries appended to a runs table; a run that is repeated adds nothing."""
    runs = CommittedTable(spark, scratch_path(spark, "runs"), "run_id")
    for run_id in ("run-1", "run-2", "run-1"):
        runs.commit(lambda now, r=run_id: run_summary(spark, d).select(F.lit(r).alias("run_id"), "n_train", "n_val", "param_slope"),
                    token=run_id)
    return runs.read()
