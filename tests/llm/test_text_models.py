"""Fitted operators: held-out accuracy, edge cases, and the segment search against all
segments."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from text_fixtures import ROWS, empty, messy  # noqa: F401

from tilth.llm import common, langid, queries, toxicity

SF01 = "/root/testdata/sf0.01"


def maximal_by_definition(scores):
    """Split at the best segment, then search both sides."""
    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (found is None or total > found[2] or (total == found[2] and b + 1 - a < found[1] - found[0])):
                    found = (a, b + 1, total)
        return found

    def walk(lo, hi):
        f = best(lo, hi)
        return [] if f is None else walk(lo, f[0]) + [f] + walk(f[1], hi)
    return walk(0, len(scores))


def test_maximal_segments_match_the_definition():
    rnd = random.Random(2)
    for _ in range(300):
        s = np.array([rnd.choice([-3.25, -2.5, -1.125, 0.75, 1.0625, 2.375, 4.5]) + rnd.random() / 7
                      for _ in range(rnd.randint(0, 18))], np.float32)
        got = [(a, b) for a, b, _ in toxicity.maximal_segments(s)]
        assert got == [(a, b) for a, b, _ in maximal_by_definition([float(x) for x in s])]


def test_maximal_segments_long_input_is_linear():
    s = np.tile(np.array([1.0, -0.5, 2.0, -9.0], np.float32), 100_000)
    found = toxicity.maximal_segments(s)
    assert len(found) == 100_000 and found[7][:2] == (28, 31)


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(4)
    calm, bad = [f"word{i}" for i in range(300)], ["vile", "wretch", "scoundrel", "vermin"]
    docs, labels = [], []
    for i in range(1500):
        w = [rnd.choice(calm) for _ in range(rnd.randint(20, 200))]
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        docs.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    labels += [(None, 1), (4, None), (6, 1), (10**9, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_finds_planted_passages(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    out = toxicity.score_toxicity(docs, model).where("doc_id % 2 = 1 or doc_id % 6 = 0").collect()
    truth = {r["doc_id"]: r["doc_id"] % 6 == 0 for r in out}
    assert sum(bool(r["predicted"]) == truth[r["doc_id"]] for r in out) > 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    texts = dict(map(tuple, docs.collect()))
    for r in out[:50]:
        for p in r["passages"]:
            assert 0 <= p["first"] < p["end"] <= len(texts[r["doc_id"]].split())


def test_toxicity_edge_cases(labelled, messy, empty):
    docs, labels = labelled
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.fit(docs.limit(0), labels) is None
    model = toxicity.fit(docs, labels)
    got = toxicity.score_toxicity(messy, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] < 0.5 for r in got if not r["n_tokens"])
    assert {r["score"] for r in toxicity.score_toxicity(messy, None).collect()} == {0.0}
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_language_backoff(spark, messy, empty):
    rnd = random.Random(6)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["zo", "ré", "shu", "wy"]}
    rows = [(i, " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 5))) for _ in range(60)), lang)
            for i, lang in enumerate(["aa", "bb"] * 150)]
    docs = spark.createDataFrame(rows + [(999, "nothing", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id < 200"), words=50)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    held = [r for r in rows if r[0] >= 200]
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in held) == len(held)
    # words seen by nobody are judged by their n-grams alone
    unseen = spark.createDataFrame([(1, "kalomitukalomitu lolomikaka"), (2, "zoréshuwyzoré 12"), (3, "123 ... !"), (4, None),
                                    (5, ""), (6, "語語")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(unseen, model).collect()}
    assert got[1][0] == "aa" and got[2][0] == "bb"
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[6] == ("aa", 0.5)
    assert langid.identify(messy, model).count() == len(ROWS)
    assert langid.identify(empty, model).count() == 0
    assert langid.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(messy, None).collect()} == {"und"}


def test_queries_on_held_out_rows(spark):
    """The registered queries on their whole tables: folds, held-out accuracy, coverage."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: r for r in docs.collect()}
    lang = queries.op4_language_id(spark, SF01).collect()
    assert {r["doc_id"] for r in lang} == set(truth)
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 4 == 2) for r in lang)
    held = [r for r in lang if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)

    tox = {r["doc_id"]: r for r in queries.op1_toxicity(spark, SF01).collect()}
    assert set(tox) == set(truth) and all(r["held_out"] == (brute.crc(i) % 5 == 0) for i, r in tox.items())
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    held = [r for r in labels if tox[r["doc_id"]]["held_out"]]
    assert sum(tox[r["doc_id"]]["predicted"] == r["toxic"] for r in held) >= 0.9 * len(held)

    found = {r["doc_id"]: r for r in queries.op9_secret_scan(spark, SF01).collect()}
    for i, r in truth.items():
        a, b, c, spans = brute.secrets(r["text"])
        f = found[i]
        assert (f["n_assign"], f["n_access"], f["n_hex"], f["base_sha256"]) == (a, b, c, brute.sha(spans))


def test_length_query_counts_every_document(spark):
    hist = queries.op6_token_counts(spark, SF01)
    row = hist.agg(F.sum("n_docs").alias("n"), F.max("docs_reaching").alias("all"), F.max("truncated_total").alias("t"),
                   F.max("tokens_within").alias("w")).first()
    assert row["n"] == row["all"] == spark.read.parquet(f"{SF01}/documents.parquet").count() and row["t"] == row["w"]


def test_rare_classes_have_their_share(spark):
    assert common.shares({"a": 10_000, "b": 3, "c": 500}, 100) == {"b": 3, "c": 48, "a": 49}
    rows = spark.range(10_001).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5000 == 7, "b").otherwise("a").alias("lang"))
    picked, counts, quota = common.class_sample(rows, 200, "lang")
    got = [tuple(r) for r in picked.collect()]
    assert counts == {"a": 9999, "b": 2} and quota == {"a": 198, "b": 2}
    assert sorted(got) == sorted(tuple(r) for r in common.class_sample(rows.repartition(7), 200, "lang")[0].collect())
    assert len(got) == len(set(got)) == 200 and sum(x[1] == "b" for x in got) == 2


def test_a_language_of_one_row_in_ten_thousand(spark):
    rnd = random.Random(9)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["zo", "ré", "shu", "wy"]}

    def text(lang, n):
        return " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))
    rows = [(i, text("aa", 9), "aa") for i in range(10_000)] + [(20_000, text("bb", 60), "bb")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=300)
    assert model.languages == ["aa", "bb"]
    new = [(i, text(lang, 30), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark.createDataFrame(new, "doc_id long, text string, x string"), model).collect()}
    assert all(got[i] == lang for i, _, lang in new)


def test_language_scores_match_plain_python(spark, messy):
    """Counts, word-first backoff and scores again, by dictionaries alone."""
    labelled = [r for r in messy.collect() if r["doc_id"] is not None and r["text"]]
    fitted = [(i, r["text"], ["x", "y", "z"][i % 3]) for i, r in enumerate(labelled)]
    model = langid.fit(spark.createDataFrame(fitted, "doc_id long, text string, lang string"), words=10**9, grams_kept=10**9)
    counts: dict = {}
    for _, text, lang in fitted:
        for w in langid.letter_words(text):
            if len(w) <= langid.WORD_BYTES:
                counts.setdefault((0, lang), {}).setdefault(w.decode(), []).append(1)
            for n in range(1, 6):
                padded = w.decode() if n == 1 else f" {w.decode()} "
                for i in range(len(padded) - n + 1):
                    counts.setdefault((n, lang), {}).setdefault(padded[i:i + n], []).append(1)
    langs = sorted({lang for _, lang in counts})

    def cost(n, part):
        out = []
        for lang in langs:
            table = counts.get((n, lang), {})
            total = sum(map(len, table.values())) + langid.SMOOTHING
            out.append(min(langid.PENALTY, -np.log10(len(table[part]) / total)) if part in table else langid.PENALTY)
        return np.array(out)

    def known(n, part):
        return any(part in counts.get((n, lang), {}) for lang in langs)

    def word(w):
        if known(0, w):
            return cost(0, w)
        for n in range(5, 0, -1):
            padded = w if n == 1 else f" {w} "
            hits = [padded[i:i + n] for i in range(len(padded) - n + 1) if known(n, padded[i:i + n])]
            if hits:
                return np.mean([cost(n, h) for h in hits], axis=0)
        return None
    texts = [r["text"] for r in labelled] + ["wörd unseen thething", "zzz qqq", "12 34", "a b c the"]
    for text in texts:
        if len(text) > 5000:
            continue
        found = [v for v in (word(w.decode()) for w in langid.letter_words(text)) if v is not None]
        got = model.score(text, {})
        if found:
            assert got == pytest.approx(np.mean(found, axis=0), abs=1e-4)
        else:
            assert got is None


def test_rare_toxic_rows_are_learnt_and_clean_ones_left_alone(spark):
    rnd = random.Random(5)
    calm, bad = [f"word{i}" for i in range(300)], ["vile", "wretch", "scoundrel", "vermin"]

    def text(toxic):
        w = [rnd.choice(calm) for _ in range(rnd.randint(20, 60))]
        for _ in range(4 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        return " ".join(w)
    rows = [(i, text(i % 200 == 3), int(i % 200 == 3)) for i in range(12_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"), sample=1000)
    new = [(i, text(i % 4 == 0)) for i in range(400)]
    got = toxicity.score_toxicity(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    hit = [r for r in got if r["doc_id"] % 4 == 0]
    assert sum(r["predicted"] for r in hit) >= 0.9 * len(hit)
    assert sum(r["predicted"] for r in got if r["doc_id"] % 4) <= 0.02 * 300


def test_documents_without_passages_are_graded(spark):
    scores = np.zeros(toxicity.BUCKETS, np.float32)
    model = toxicity.ToxicityModel(scores, 0.7, -1.0, 2.0, -3.0)
    graded = [model.probability(0.0, best, 40) for best in (0.0, 1.0, 2.0, 3.0)]
    assert graded == sorted(graded) and len(set(graded)) == 4
    assert graded[0] >= model.probability(0.0, -9e9, 40) and graded[-1] <= model.probability(1e-9, 3.0, 40)


def test_toxicity_scores_match_plain_python(labelled):
    """Evidence and score of whole texts from the definition of the segments."""
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    texts = {i: t for i, t in map(tuple, docs.collect()) if len(t.split()) <= 60}
    assert len(texts) > 100
    for r in toxicity.score_toxicity(docs, model).collect():
        if r["doc_id"] not in texts:
            continue
        values = []
        for w in texts[r["doc_id"]].encode().split():
            odds = [float(model.scores[b]) for b in toxicity.word_buckets(w)]
            values.append(float(np.float32(max(odds, key=abs) - toxicity.DRIFT)))
        parts = [model.decay * s - model.log_k - np.log(len(values)) for _, _, s in maximal_by_definition(values)]
        strong = [e for e in parts if e > 0]
        p = 1 / (1 + np.exp(-(model.slope * np.log1p(sum(strong)) + model.offset)))
        if not strong and p < 0.5:
            p *= (1 + np.exp(min(0.0, max(parts, default=-model.log_k - np.log(len(values)))))) / 2
        assert r["score"] == pytest.approx(p, abs=1e-4) and len(r["passages"]) == len(strong)
