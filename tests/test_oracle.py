"""Registered queries against their DuckDB oracles.

By default a representative key per section runs on sf0.001; set
TILTH_FULL_ORACLE=1 to run every key (tools/check_oracle.py does the same at sf0.01).
"""

import os

import pytest

from conftest import SF001

from tilth.plans.catalog import ORACLE, QUERIES, load_all

load_all()

SAMPLE = ["describe_numeric", "prepare_survey", "prepare_survey_strict", "split_exact", "onehot_encode_unseen",
          "kruskal_wallis", "levene_median", "drift_ks", "performance_report", "report_metric_choice",
          "alert_rows", "deploy_decision", "promote_version", "regression_metrics", "cv_loss", "scan_csv",
          "group_values_topn", "stream_period_report", "run_info_roundtrip", "matrix_roundtrip"]
KEYS = sorted(QUERIES) if os.environ.get("TILTH_FULL_ORACLE") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracle import duck as make
    return make(SF001)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    from check_oracle import compare
    res = compare(spark, duck, key, QUERIES[key], ORACLE.get(key), SF001)
    assert res["status"] in ("ok", "rows"), res


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
