"""Cleaning, encoding, splitting and file round trips (mirrors the reference's unit tests)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tilth.operators import cleaning as C
from tilth.operators import encode as E
from tilth.plans import survey
from tilth.sources import files as S

RAW_HEADER = ",".join(survey.SURVEY_COLUMNS)
RAW_ROWS = [
    "Primary,Male,20-30,3,2.5,100,2,1500,Bank,Yes,Extension,Gov,Group,English",
    "NA,Female,30-40,4,,150,3,1600,NGO,No,Radio,NGO,Individual,Local",
    "Tertiary,Male,46-55,5,3.0,200,4,1700,Self,Yes,TV,Private,Digital,English",
    "None,Female,26-35,6,4.0,120,5,1800,Family,No,Extension,Government,Group,Local",
    "Secondary,Male,36-45,7,2.0,50,1,1000,Cooperative,Yes,Radio,Gov,Individual,English",
]
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in ("Household size", "Fertilizer amount", "Laborers")
                   else T.DoubleType() if c in ("Acreage", "Yield") else T.StringType())
     for c in survey.SURVEY_COLUMNS])


@pytest.fixture()
def raw_csv(tmp_dir):
    path = os.path.join(tmp_dir, "corn.csv")
    with open(path, "w") as f:
        f.write(RAW_HEADER + "\n" + "\n".join(RAW_ROWS) + "\n")
    return path


def test_missing_file_raises(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        S.read_csv(spark, os.path.join(tmp_dir, "nope.csv"), RAW_SCHEMA).count()


def test_na_tokens_become_null_and_prepare(spark, raw_csv):
    raw = S.read_csv(spark, raw_csv, RAW_SCHEMA)
    assert raw.where(F.col("Education").isNull()).count() == 2          # 'NA' and 'None'
    prepared = survey.prepare_survey(raw)
    assert prepared.columns == [c.lower().replace(" ", "_") for c in survey.SURVEY_COLUMNS]
    assert prepared.count() == 4                                        # the row without acreage is dropped
    assert prepared.where(F.col("education") == survey.NO_EDUCATION).count() == 1
    assert prepared.where(F.col("acreage").isNull()).count() == 0


def test_select_significant_keeps_order_and_rows(spark, raw_csv):
    prepared = survey.prepare_survey(S.read_csv(spark, raw_csv, RAW_SCHEMA))
    sel = C.project(prepared, survey.SIGNIFICANT)
    assert sel.columns == survey.SIGNIFICANT
    assert sel.count() == prepared.count()
    with pytest.raises(AnalysisException):
        C.project(prepared, ["not_a_column"])


def test_directory_reads_every_csv(spark, tmp_dir):
    for i in range(3):
        with open(os.path.join(tmp_dir, f"part{i}.csv"), "w") as f:
            f.write("a,b\n" + f"{i},{i * 10}\n")
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as f:
        f.write("a,b\n99,99\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    df = S.read_csv(spark, tmp_dir, schema, glob="*.csv")
    assert sorted(r["a"] for r in df.collect()) == [0, 1, 2]


def test_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "a int, b int")
    path = os.path.join(tmp_dir, "rt")
    S.write_csv(df, path)
    back = S.read_csv(spark, path, T.StructType([T.StructField("a", T.IntegerType()),
                                                 T.StructField("b", T.IntegerType())]))
    assert sorted(map(tuple, back.collect())) == [(1, 2), (3, 4), (5, 6)]


def test_constant_rows_profile(spark):
    from tilth.operators import profile as P
    df = spark.createDataFrame([("x", 1.0)] * 50, "s string, v double")
    const = {r["column"]: r["is_constant"] for r in P.constant_columns(df).collect()}
    assert const == {"s": True, "v": True}
    assert P.duplicate_rows(df).first()["n_duplicates"] == 49


def test_split_shares_and_reproducibility(spark):
    df = spark.range(0, 5000).withColumn("key", F.col("id").cast("string"))
    s = E.split(df, "key")
    shares = {r["split"]: r["share"] for r in E.split_report(s).collect()}
    assert 0.15 <= shares["test"] <= 0.25 and 0.15 <= shares["val"] <= 0.25 and 0.55 <= shares["train"] <= 0.65
    a = sorted(map(tuple, s.select("key", "split").collect()))
    b = sorted(map(tuple, E.split(df.repartition(7), "key").select("key", "split").collect()))
    assert a == b
    ex = {r["split"]: r["n"] for r in E.split_report(E.split_exact(df, "key")).collect()}
    assert ex == {"test": 1000, "val": 1000, "train": 3000}


def test_unseen_category_encodes_as_zeros(spark):
    from pyspark.ml.linalg import Vectors  # noqa: F401
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    new = spark.createDataFrame([("a", 1.0), ("z", 5.0)], "c string, x double")
    model = E.ml_encoder(["c"], ["x"]).fit(train)
    rows = {r["c"]: r["features"].toArray().tolist() for r in model.transform(new).collect()}
    assert rows["a"] == [1.0, 0.0, 1.0]
    assert rows["z"] == [0.0, 0.0, 5.0]


def test_run_info_json_corrupt_and_valid(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good.json")
    bad = os.path.join(tmp_dir, "bad.json")
    with open(good, "w") as f:
        f.write('{"run_id": "r1", "model_name": "m", "model_version": 2, "metrics": {"rmse": 1.5, "r2": 0.9}}')
    with open(bad, "w") as f:
        f.write('{"run_id": "r2", "model_name": ')
    got = {r["source"]: r["valid"] for r in S.read_run_info(spark, tmp_dir)
           .withColumn("source", F.col("_metadata.file_name")).collect()}
    assert got == {"good.json": True, "bad.json": False}


def test_choose_source_switch(spark):
    base = spark.range(3)
    month = spark.range(5)
    assert S.choose_source(base, month, retraining=True).count() == 3
    assert S.choose_source(base, month, retraining=False).count() == 5
    assert S.choose_source(base, None, retraining=False).count() == 3


def test_wide_vocabulary_is_bounded_before_the_driver(spark):
    from conftest import SF001
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    small = E.learn_vocabulary(orders, ["o_orderstatus"], ["o_totalprice"], max_features=10)
    assert [f for _, f, _, _ in small][-1] == "o_totalprice"
    with pytest.raises(ValueError, match="exceeds"):
        E.learn_vocabulary(orders, ["o_orderkey"], [], max_features=100)
    # the joined (never collected) path handles the same column whole
    vocab = E.vocabulary(orders, ["o_orderkey"], [])
    assert vocab.count() == orders.count()
    long = E.encode_long(orders, vocab, "o_orderkey", ["o_orderkey"], [])
    assert long.count() == orders.count()


def test_csv_by_header_name_quotes_and_blanks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a.csv")
    with open(path, "w") as f:
        f.write('b,a,note\n1.5,7,"he said ""hi"", ok"\nx,8, y \nNA,9,"two\nlines"\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()),
                           T.StructField("note", T.StringType())])
    df = S.read_csv(spark, path, schema, multi_line=True, corrupt_col="bad")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (7, 1.5, 'he said "hi", ok', []), (8, None, " y ", ["b"]), (9, None, "two\nlines", [])]
    assert tuple(S.count_corrupt(df, "bad").first()) == (3, 1)
    with pytest.raises(ValueError, match="no column"):
        S.read_csv(spark, path, T.StructType([T.StructField("c", T.LongType())]))


def test_truncated_run_record_is_an_invalid_row(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runs.json")
    with open(path, "w") as f:
        f.write('{"run_id": "r1", "model_name": "m", "metrics": {"rmse": 1.0}}\n{"run_id": "r2", "mod\n')
    got = S.read_run_info(spark, path, multi_line=False).collect()
    assert sorted(r["valid"] for r in got) == [False, True]


def test_number_text_keeps_every_digit(spark):
    values = [2.0, 0.0001, 1e-7, 12345.12345678, 1e20, -3.5e-9, 123456789.125, 1.5e300, 0.1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(C.double_text(F.col("x"))).collect()]
    assert got[:7] == ["2.0", "0.0001", "0.0000001", "12345.12345678", "100000000000000000000.0", "-0.0000000035", "123456789.125"]
    assert [float(g) for g in got] == values and not any("E" in g for g in got)


def test_padding_keeps_true_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, 5)], "k long, only_a long")
    b = spark.createDataFrame([(3,)], "k long")
    assert sorted(map(tuple, E.align_pad(a, b).collect()), key=str) == [(1, None), (2, 5), (3, 0)]
