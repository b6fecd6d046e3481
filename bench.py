"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and print one JSON line with per-query seconds.

Each query is executed to completion through Spark's ``noop`` sink (the whole
plan runs, nothing is collected), after one warm-up query for JVM start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

BENCH_KEYS = [
    "describe_numeric", "box_stats", "prepare_survey", "prepare_survey_strict", "onehot_encode",
    "split_exact", "kruskal_wallis", "levene_median", "feature_screen", "performance_report",
    "dataset_drift", "drift_ks", "report_metric_choice", "alert_rows", "deploy_decision",
    "regression_metrics", "cv_loss", "ridge_fit", "scan_csv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tilth.session import build_session
    spark = build_session(f"local[{cpus}]", extra={"spark.ui.showConsoleProgress": "false"})
    from tilth.plans.catalog import QUERIES, load_all
    load_all()
    keys = [k for k in (sys.argv[1:] or BENCH_KEYS) if k in QUERIES]
    # warm-up: JVM code paths and the Python workers used by Arrow batches
    QUERIES["profile_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(1000).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"# {k}: {times[k]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
           "spark": spark.version}
    print(json.dumps(out))
    from tilth.session import clear_scratch
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
