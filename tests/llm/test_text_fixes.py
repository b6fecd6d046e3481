"""Long blank runs, bucket arithmetic at any size, other text columns, the order of turns."""

import pytest
from pyspark.sql import functions as F
from text_fixtures import empty, messy  # noqa: F401

from tilth.llm import chat, decontam, lengths, mixing, tokens


@pytest.fixture(scope="module")
def enc(spark):
    return tokens.encoding(tokens.ship_vocabulary(spark))


@pytest.mark.parametrize("blank", [" ", "\t", "\n", "\n ", " \n", "　", "\xa0 "])
@pytest.mark.parametrize("tail", ["word", "", "'s", "7", "!", "\x1c"])
def test_blank_runs_count_like_the_plain_encoder(enc, blank, tail, monkeypatch):
    monkeypatch.setattr(lengths, "_BLANKS", lengths.re.compile(lengths._BLANKS.pattern.replace("{1000,}", "{3,}")))
    for n in (1, 2, 3, 7, 40):
        text = "start" + blank * n + tail + blank * 5 + "end" + blank * n
        assert lengths.count_tokens(enc, text) == len(enc.encode_ordinary(text)), (n, text)


def test_very_long_blank_runs(spark, enc):
    rows = [(i, "one" + c * 5_000_000 + "two") for i, c in enumerate(" \t\n")]
    got = lengths.token_lengths(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: lengths.count_tokens(enc, t) for i, t in rows}


def test_texts_are_encoded_once(spark, messy):
    plan = lengths.length_histogram(lengths.token_lengths(messy))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


@pytest.mark.parametrize("docs", [10**4, 10**10, 10**12])
def test_buckets_at_any_size(spark, docs):
    n = docs // mixing.DOCS_PER_BUCKET
    keys = [0, 1, 2**39, 2**40 - 1]
    got = [r["b"] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(
        mixing.bucket_of(F.col("k"), n).alias("b")).collect()]
    assert got == [(k >> 16) * n >> 24 for k in keys] and got == sorted(got) and got[-1] < n


def test_other_text_column(spark, messy, empty):
    named = messy.withColumnRenamed("text", "body")
    items = spark.createDataFrame([(1, "a line that repeats itself")], "item_id long, text string")
    assert decontam.drop_contaminated(named, items, text_col="body").count() == decontam.drop_contaminated(messy, items).count()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, mixing.mixed_documents(named, text_col="body").select(key).collect())) == sorted(
        map(str, mixing.mixed_documents(messy).select(key).collect()))


def test_order_of_turns(spark):
    rows = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (2, 0, "assistant"), (2, 1, "user"), (2, 2, "user"),
            (3, 0, "user"), (4, 0, None), (4, 1, "user"), (4, 2, "assistant")]
    turns = spark.createDataFrame([(c, t, r, "x") for c, t, r in rows], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["valid_order"], r["order_errors"]) for r in chat.format_chats(turns).collect()}
    assert got == {1: (True, []), 2: (False, [0, 2]), 3: (False, []), 4: (False, [0])}
