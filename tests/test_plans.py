"""Physical-plan invariants of registered queries (what tools/plan_audit.py reports).

No cartesian or nested-loop joins, no row-at-a-time Python UDFs, no window without
a partition key over data-sized input; filters and projections reach the scan."""

import os
import sys

import pytest

from conftest import SF001

from tilth.plans.catalog import QUERIES, load_all

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_audit import audit  # noqa: E402

load_all()

KEYS = ["prepare_survey", "describe_numeric", "box_stats", "iqr_outliers", "dup_subset", "kruskal_wallis",
        "anova_oneway", "levene_median", "feature_screen", "cv_loss", "performance_report", "dataset_drift",
        "drift_ks", "report_metric_choice", "alert_rows", "deploy_decision", "promote_version", "split_exact",
        "onehot_encode_unseen", "regression_metrics", "metric_trend"]


def _plan(spark, key):
    df = QUERIES[key](spark, SF001)
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("key", KEYS)
def test_plan_invariants(spark, key):
    a = audit(_plan(spark, key))
    assert a["cross"] == 0
    assert a["python_row"] == 0
    # below two ranges of ROWS_PER_RANGE rows the running sums are one bounded window
    bounded = 2 if key in ("feature_screen", "split_exact", "onehot_encode_unseen") else 0
    assert a["windows_unpartitioned"] <= bounded


def test_reference_period_bound_reaches_the_scan(spark):
    plan = _plan(spark, "performance_report")
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "events.parquet" in ln]
    assert any("LessThan(ts," in ln for ln in scans), scans
    # only the columns the report reads
    assert all("props" not in ln.split("ReadSchema:")[1] for ln in scans)


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    """Only a local master may fall back to its own temporary folder."""
    from types import SimpleNamespace

    from tilth.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_scratch_tables_can_be_cleared(spark):
    import os

    from tilth.session import clear_scratch, scratch_path
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    clear_scratch(spark)
    assert not os.path.exists(local)
