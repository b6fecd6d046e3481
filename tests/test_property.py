"""Property test: distributed running sums equal a brute-force prefix sum for any data,
partition count and Arrow batch size (groups may be null, skewed or single-valued)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilth.operators.ordered import running_sums

rows = st.lists(st.tuples(st.sampled_from(["a", "b", None, "hot", "hot", "hot"]),
                          st.integers(min_value=-5, max_value=5)), min_size=1, max_size=300)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, parts=st.integers(min_value=1, max_value=7), batch=st.integers(min_value=1, max_value=50))
def test_running_sums_property(spark, data, parts, batch):
    pdf = pd.DataFrame(data, columns=["g", "v"])
    df = spark.createDataFrame(pdf, "g string, v long").groupBy("g", "v").agg(F.count(F.lit(1)).alias("cnt"))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = running_sums(df, ["g"], "v", ["cnt"]).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = pdf.assign(g=pdf["g"].fillna("<null>")).groupby(["g", "v"]).size().rename("cnt").reset_index()
    exp = exp.sort_values(["g", "v"])
    exp["before"] = exp.groupby("g")["cnt"].cumsum() - exp["cnt"]
    exp["total"] = exp.groupby("g")["cnt"].transform("sum")
    exp["prev"] = exp.groupby("g")["v"].shift(1)
    got = got.assign(g=got["g"].fillna("<null>")).sort_values(["g", "v"]).reset_index(drop=True)
    exp = exp.reset_index(drop=True)
    assert list(got["cnt_before"]) == list(exp["before"])
    assert list(got["cnt_total"]) == list(exp["total"])
    assert list(got["prev_v"].fillna(-99)) == list(exp["prev"].fillna(-99))
