"""Registered queries against their SQL, the pipeline, and the plans."""

import os
import sys

import pytest
from text_fixtures import empty, messy  # noqa: F401

import corpus_pipeline
from tilth.llm import common, queries

SF001 = "/root/testdata/sf0.001"
ALL = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
SQL = {**queries.ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}


@pytest.fixture(scope="module")
def tools():
    sys.path.insert(0, os.path.join(os.path.dirname(corpus_pipeline.__file__), "tools"))
    import check_oracle
    return check_oracle


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, tools, key):
    res = tools.compare(spark, tools.duck(SF001), key, ALL[key], SQL[key], SF001)
    assert res["status"] == "ok", res


def test_stages_keep_the_columns(spark, messy, empty):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (messy.select(*plain), empty.select(*plain)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = common.materialize(stage(spark, docs, SF001))
            if name != "mix":
                assert docs.columns == plain, name


def test_entry_registers_all():
    import __spark_entry__ as entry
    assert set(ALL) <= set(entry.queries()) and set(k for k, v in SQL.items() if v) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", ["op2_mix_sources", "op3_chat_format", "op8_quality_rules", "op10_line_dedup"])
def test_native_queries_run_no_python(spark, key):
    plan = ALL[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
