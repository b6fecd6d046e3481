"""Report parsing on a hand-written nested document; selection rules on hand-computed cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tilth.operators import registry as G
from tilth.operators import reports as R
from tilth.sources import files as S

DOC = {
    "id": "r1", "timestamp": "2024-03-01T10:00:00Z", "name": "perf",
    "metric_results": {
        "a": {"display_name": "RMSE", "widget": [
            {"title": "Current data", "params": {"counters": [{"value": "12,5", "label": "RMSE"}]}},
            {"title": "Reference data", "params": {"counters": [{"value": "10.0", "label": "RMSE"}]}}]},
        "b": {"display_name": "R2 Score", "widget": [
            {"title": "Scores", "params": {"counters": [{"value": "0.50", "label": "Mean"},
                                                        {"value": "0.0", "label": "score"}]}}]},
        "c": {"display_name": "Mean Absolute Error", "mean": {"value": "3.25"}, "count": {"value": "40"}},
        "d": {"display_name": "Column summary", "value": "9.9"},
    },
}


@pytest.fixture()
def report_dir(tmp_dir):
    for i, doc in enumerate([DOC, {**DOC, "id": "r2", "timestamp": "not a time", "metric_results": {}}]):
        with open(os.path.join(tmp_dir, f"report_{i}.json"), "w") as f:
            json.dump(doc, f, indent=2)
    return tmp_dir


def test_parse_and_choose(spark, report_dir):
    rep = S.read_json_documents(spark, report_dir, R.REPORT_SCHEMA).withColumnRenamed("id", "report_id")
    readings = R.report_metrics(rep)
    got = {(r["metric"], r["side"]): r["value"] for r in readings.where(F.col("report_id") == "r1").collect()}
    # display names without rmse/r2/mae are skipped; both r2 counters are 'value' (last one wins)
    assert got[("rmse", "current")] == pytest.approx(12.5)
    assert got[("rmse", "reference")] == pytest.approx(10.0)
    assert got[("mae", "value")] == pytest.approx(3.25) and got[("mae", "count")] == 40.0
    chosen = {r["report_id"]: r for r in R.metric_choice(readings, rep).collect()}
    assert chosen["r1"]["rmse"] == pytest.approx(12.5)          # current preferred
    assert chosen["r1"]["r2"] == 0.0                             # the later reading, kept although 0.0
    assert chosen["r2"]["rmse"] is None
    summ = {r["report_id"]: r for r in R.summarize(rep.withColumn("project", F.lit("p")), ["project"]).collect()}
    assert summ["r1"]["usable"] and not summ["r2"]["usable"]
    assert str(summ["r2"]["ts"]).startswith("0001-01-01")       # unparsable timestamp sorts first


def _pairs(spark, raw, opt):
    rows = [("m", 1, "raw", raw[0], raw[1], "a")] + ([("m", 2, "optimized", opt[0], opt[1], "b")] if opt else [])
    runs = spark.createDataFrame(rows, "model_name string, version long, kind string, rmse double, r2 double, "
                                       "run_id string")
    return G.winner(G.pair_runs(runs)).first()


@pytest.mark.parametrize("raw,opt,winner", [
    ((100.0, 0.80), (95.0, 0.81), "optimized"),   # 5% lower rmse, better r2
    ((100.0, 0.80), (97.0, 0.70), "raw"),         # 3% gain does not justify worse r2
    ((100.0, 0.80), (90.0, 0.70), "optimized"),   # >5% gain outweighs worse r2
    ((100.0, 0.80), (100.5, 0.90), "optimized"),  # better r2, rmse within 1%
    ((100.0, 0.80), (110.0, 0.90), "raw"),        # better r2 but rmse 10% worse
    ((100.0, 0.80), (99.0, 0.80), "raw"),         # nothing significant
    ((100.0, 0.80), None, "raw"),                 # no optimised run
])
def test_winner_rule(spark, raw, opt, winner):
    assert _pairs(spark, raw, opt)["winner"] == winner


def test_deploy_decision_cases(spark):
    versions = spark.createDataFrame(
        [("a", 1, "Production", 100.0, "x"), ("b", 1, "Production", float("nan"), "y"), ("c", 1, "Staging", 5.0, "z")],
        "model_name string, version long, stage string, rmse double, run_id string")
    cands = spark.createDataFrame([("a", 94.0), ("b", 50.0), ("c", 9.0), ("d", 1.0)],
                                  "model_name string, candidate_rmse double")
    got = {r["model_name"]: (r["should_deploy"], r["reason"]) for r in G.deploy_decision(cands, versions).collect()}
    assert got["a"] == (True, "improvement above threshold")
    assert got["b"] == (True, "production rmse missing")
    assert got["c"] == (True, "no production model")
    assert got["d"] == (True, "no production model")
    cands2 = spark.createDataFrame([("a", 96.0)], "model_name string, candidate_rmse double")
    assert G.deploy_decision(cands2, versions).first()["should_deploy"] is False


def test_json_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("m", 1.5)], "model string, rmse double")
    path = os.path.join(tmp_dir, "summary")
    S.write_json(df, path)
    assert spark.read.json(path).first()["rmse"] == 1.5


def test_nested_report_and_drift_score(spark):
    import json

    from tilth.operators import reports as R
    rmse = {"m": {"display_name": "RMSE", "value": "1.5"}}
    docs = [("a", {"id": "a", "report": {"metric_results": rmse}}),
            ("b", {"id": "b", "metric_results": {"d": {"display_name": "Data Drift", "drift_score": 0.4}}}),
            ("c", {"id": "c", "metric_results": {"d": {"display_name": "Data Drift", "drift_score": 0.0}}})]
    df = R.parse_reports(spark.createDataFrame([(k, json.dumps(v)) for k, v in docs], "key string, json string"))
    flags = {r["report_id"]: r["drift_detected"] for r in R.drift_flag(df).collect()}
    assert flags == {"a": False, "b": True, "c": False}
    assert [tuple(r) for r in R.report_metrics(df).select("report_id", "metric", "value").collect()] == [("a", "rmse", 1.5)]


def test_offsets_are_converted_to_utc(spark):
    from pyspark.sql import functions as F

    from tilth.functions.text import parse_timestamp
    rows = [("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+05:00",), ("2024-01-02 03:04:05.5-0130",), ("2024-01-02",), ("x",)]
    got = [str(r[0]) for r in spark.createDataFrame(rows, "s string").select(parse_timestamp(F.col("s"))).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-01 22:04:05", "2024-01-02 04:34:05.500000", "2024-01-02 00:00:00",
                   "0001-01-01 00:00:00"]


def test_nan_never_wins(spark):
    from tilth.operators import registry as G
    nan = float("nan")
    runs = spark.createDataFrame(
        [("a", 1, "raw", nan, 0.5, "r1"), ("a", 2, "optimized", 9.0, 0.4, "r2"),
         ("b", 1, "raw", 9.0, 0.5, "r3"), ("b", 2, "optimized", nan, nan, "r4")],
        "model_name string, version long, kind string, rmse double, r2 double, run_id string")
    assert {r["winner"] for r in G.winner(G.pair_runs(runs)).collect()} == {"raw"}
    versions = runs.selectExpr("*", "'Production' as stage").where("kind = 'raw' and model_name = 'b'")
    cand = spark.createDataFrame([("b", nan), ("c", nan)], "model_name string, candidate_rmse double")
    got = {r["model_name"]: r["should_deploy"] for r in G.deploy_decision(cand, versions).collect()}
    assert got == {"b": False, "c": True}
    gate = spark.createDataFrame([(nan, 0.9), (1.0, nan), (1.0, 0.9)], "rmse double, r2 double")
    assert [r[0] for r in gate.select(G.quality_gate(gate)).collect()] == ["Archived", "Archived", "Staging"]


def test_several_candidates_get_their_own_numbers(spark):
    from tilth.operators import registry as G
    versions = spark.createDataFrame([("m", 3, "Production", 50.0, 0.9, "r0")],
                                     "model_name string, version long, stage string, rmse double, r2 double, run_id string")
    cand = spark.createDataFrame([("m", "r2", 20.0, 0.9), ("m", "r1", 10.0, 0.9), ("n", "r9", 500.0, 0.9)],
                                 "model_name string, run_id string, candidate_rmse double, candidate_r2 double")
    new = G.append_versions(versions, cand, "x", "t")
    assert sorted((r["model_name"], r["version"], r["run_id"]) for r in new.collect()) == [("m", 4, "r1"), ("m", 5, "r2"), ("n", 1, "r9")]
    got = {(r["model_name"], r["version"]): r["new_stage"] for r in G.promote(versions, new).collect()}
    assert got == {("m", 3): "Archived", ("m", 4): "Production", ("m", 5): "Staging", ("n", 1): "Archived"}
