"""Tolerant number and timestamp parsing, report drift text rule."""

import pytest
from pyspark.sql import functions as F

from tilth.functions.text import parse_number, parse_timestamp


@pytest.mark.parametrize("raw,expected", [
    ("12.5", 12.5), ("  -3 ", -3.0), ("RMSE: 45.10", 45.1), ("1,234.56", 1234.56), ("1.234,56", 1234.56),
    ("0,95", 0.95), ("1,234,567", 1234567.0), ("1.234.567", 1234567.0), ("1234.56", 1234.56),
    ("1e-5", 1e-5), ("2.5E+03 units", 2500.0), (".5", 0.5), ("n/a", None), ("", None), (None, None)])
def test_parse_number(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(parse_number(F.col("s")).alias("v")).first()["v"]
    if expected is None:
        assert got is None
    else:
        assert got == pytest.approx(expected)


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-05T10:11:12.123456Z", "2024-01-05 10:11:12.123456"),
    ("2024-01-05T10:11:12", "2024-01-05 10:11:12.000000"),
    ("2024-01-05 10:11:12", "2024-01-05 10:11:12.000000"),
    ("2024-01-05T10:11:12Z", "2024-01-05 10:11:12.000000"),
    ("garbage", "0001-01-01 00:00:00.000000"), (None, "0001-01-01 00:00:00.000000")])
def test_parse_timestamp(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(
        F.date_format(parse_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]
    assert got == expected


def test_drift_text_rule(spark):
    from tilth.operators import reports as R
    rows = [("a", {"m": {"display_name": "Data drift", "value": "detected"}}),
            ("b", {"m": {"display_name": "Data drift", "value": "0"}}),
            ("c", {"m": {"display_name": "RMSE", "value": "1.0"}})]
    df = spark.createDataFrame(rows, "report_id string, metric_results map<string, struct<display_name string, "
                                     "value string>>")
    got = {r["report_id"]: r["drift_detected"] for r in R.drift_flag(df).collect()}
    assert got == {"a": True, "b": False, "c": False}
