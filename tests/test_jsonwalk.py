"""Documents of any nesting, and reports under layers that no schema knows."""

import json

import pytest
from pyspark.sql import functions as F

from tilth.operators import reports as R
from tilth.operators.jsonwalk import is_json, walk_json


def _plain(node, path=(), place=()):
    """The scalars, nulls and empty containers of a parsed document."""
    items = list(node.items()) if isinstance(node, dict) else [(str(i), v) for i, v in enumerate(node)]
    for i, (k, v) in enumerate(items):
        at = ((*path, k), (*place, i))
        if isinstance(v, (dict, list)) and v:
            yield from _plain(v, *at)
        else:
            yield *at, v if v is None or isinstance(v, str) else json.dumps(v)


DOCS = [
    {"z": {"b": 1.5, "title": "T", "a": '{"q": 1}'}, "y": [1, {"k": None}, "t", {}, []], "e": "", "t": True, "é b.c": {"[": "["}},
    [[[[[[[[[[{"deep": [{"x": "y"}]}]]]]]]]]], 7],
    {"a": "[1]", "b": "{}", "c": "[", "d": {"": {"": 0}}},
]


@pytest.mark.parametrize("levels", [1, 3, 20])
def test_walk_equals_plain_walk(spark, levels):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(90, '{"a":'), (91, None), (92, '"x"'), (93, "{}"), (94, "")]
    docs = spark.createDataFrame(rows, "i int, j string").withColumn("fields", F.lit(1))
    got = {r["i"]: sorted((tuple(f["place"]), tuple(f["path"]), f["text"]) for f in r["fields"])
           for r in walk_json(docs, "j", levels=levels).collect()}
    for i, d in enumerate(DOCS):
        assert got[i] == sorted((place, path, text) for path, place, text in _plain(d))
    assert all(got[i] == [] for i in range(90, 95))
    said = {r["i"]: r["ok"] for r in docs.select("i", is_json(F.col("j")).alias("ok")).collect()}
    assert said == {0: True, 1: True, 2: True, 90: False, 91: None, 92: True, 93: True, 94: False}


def test_inherited_fields(spark):
    doc = {"title": "outer", "a": [{"title": "inner", "x": 1}, {"x": 2}]}
    row = walk_json(spark.createDataFrame([(json.dumps(doc),)], "j string"), "j", ("title",)).first()
    handed = {f["text"]: tuple(f["inherited"]["title"]) for f in row["fields"] if f["path"][-1] == "x"}
    assert handed == {"1": ("inner", 2), "2": ("outer", 0)}
    empty = walk_json(spark.createDataFrame([], "j string"), "j")
    assert empty.count() == 0


METRICS = {
    "a": {"display_name": "RMSE", "widget": [
        {"title": "Current data", "params": {"counters": [{"value": "12,5", "label": "RMSE"}]}},
        {"title": "Reference data", "params": {"counters": [{"value": "10.0", "label": "RMSE"}]}}]},
    "b": {"display_name": "R2 Score", "widget": [
        {"title": "Scores", "params": {"counters": [{"value": "0.50", "label": "Mean"}, {"value": 0.0, "label": "score"},
                                                    {"label": "0.25"}, {"value": "", "label": "std 0.1"}]}}]},
    "c": {"display_name": "Mean Absolute Error", "mean": {"value": "3.25"}, "count": {"value": 40}, "std": {"value": 9}},
    "d": {"display_name": "Column summary", "value": "9.9", "drift_score": 0.2},
}


def _readings(df):
    return sorted((r["report_id"], r["metric"], r["side"], r["value"]) for r in df.collect())


def test_walked_reports_equal_parsed_reports(spark):
    head = {"timestamp": "2024-03-01T10:00:00Z", "name": "perf"}
    docs = [{**head, "id": "r1", "metric_results": METRICS}, {**head, "id": "r2", "report": {"metric_results": METRICS}},
            {**head, "id": "r3", "metric_results": {}, "report": {"metric_results": METRICS}}, {**head, "id": "r4", "metric_results": {}}]
    texts = spark.createDataFrame([("p", json.dumps(d)) for d in docs], "project string, json string")
    walked, parsed = R.walk_reports(texts), R.parse_reports(texts.where("json not like '%r3%'"))
    a, b = _readings(R.walked_metrics(walked)), _readings(R.report_metrics(parsed))
    assert [x for x in a if x[0] != "r3"] == b and b
    assert [x[1:] for x in a if x[0] == "r3"] == [x[1:] for x in a if x[0] == "r1"]
    drift = {r["report_id"]: r["drift_detected"] for r in R.walked_drift(walked).collect()}
    assert drift == {"r1": True, "r2": True, "r3": True, "r4": False}
    one = {r["report_id"]: r for r in R.summarize(walked, ["project"]).collect()}
    two = {r["report_id"]: r for r in R.summarize(parsed, ["project"]).collect()}
    assert all(one[k].asDict() == two[k].asDict() for k in two)


def test_unknown_layers_and_malformed_documents(spark):
    deep = {"display_name": "Some report on MAE", "title": "current", "v": [{"body": {"metric_results": [
        {"display_name": "RMSE", "any": {"panels": [{"title": "Current", "x": {"counters": [{"value": 3}]}}]}},
        {"display_name": "R2", "result": {"mean": {"value": 0.75}}}]}}]}
    texts = spark.createDataFrame([(json.dumps({"id": "d", **deep}),), ('{"id": "bad", "metric_results": {',), (None,), ("[]",)], "json string")
    walked = R.walk_reports(texts)
    assert _readings(R.walked_metrics(walked)) == [("d", "r2", "value", 0.75), ("d", "rmse", "current", 3.0)]
    assert walked.where("malformed").count() == 2 and walked.count() == 4
