"""Collocations and ranked search against plain Python versions, on messy and random rows."""

import random

import brute
import numpy as np
import pytest
from text_fixtures import ROWS, empty, messy  # noqa: F401

from tilth.llm import phrases, ranked

ITEMS = [(1, "a line that repeats itself"), (2, "one two three hello"), (2, "LINE text"), (3, None), (4, "zzz nowhere"),
         (None, "w1 w2 w3 itself"), (5, "école 日本語 x"), (6, "x x")]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def random_texts(n, seed, vocabulary=12):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "W1", "x-y", "0"]
    def text():
        out = ""
        for _ in range(rnd.randint(0, 60)):
            out += rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"])
        return out
    return [(i, text(), rnd.choice(["en", "de", None])) for i in range(n)]


def check_search(spark, docs, items, top=ranked.TOP):
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                        spark.createDataFrame(items, "item_id long, text string"), top)
    want = brute.search(docs, items, top)
    assert rows(got, "item_id", "rank", "doc_id", "score") == sorted(want, key=str)


def test_search_messy(spark, messy, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = [(r[0], r[1]) for r in ROWS]
    got = ranked.search(messy, items, 4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got, *got.columns) == sorted(brute.search(docs, ITEMS, 4), key=str)
    assert ranked.search(empty, items).count() == 0
    assert ranked.search(messy, items.limit(0)).count() == 0


def test_search_over_blocks_and_groups(spark, monkeypatch):
    """Many small blocks, short and long lists, ties, and several groups of items."""
    docs = [(i, t) for i, t, _ in random_texts(400, 3, 40)]
    items = [(i, t) for i, t, _ in random_texts(12, 4, 45)]
    check_search(spark, docs, items, 5)
    monkeypatch.setattr(ranked, "GROUP_TERMS", 60)
    check_search(spark, docs, items, 5)


def test_block_skips_and_agrees():
    rnd = np.random.default_rng(2)
    n = 3000
    block = ranked._Block(list(range(n)), np.full(n, 100), n, 100 * n)
    lists = {}
    for term, share in enumerate((0.9, 0.5, 0.3, 0.02, 0.01)):
        places = np.flatnonzero(rnd.random(n) < share).astype(np.int32)
        tf = rnd.integers(1, 9, len(places))
        lists[term] = (places, tf)
        block.add(term, places, tf, 100 * (term + 1))
    assert set(block.short) == {3, 4} and set(block.long) == {0, 1, 2}
    terms = [(0, 1), (1, 2), (2, 1), (3, 1), (4, 3)]
    want = np.zeros(n, np.int64)
    for t, times in terms:
        places, tf = lists[t]
        want[places] += times * 100 * (t + 1) * ((10**9 * tf) // (1000 * tf + 12 * block.m[places]))
    for least in (1, int(np.median(want)), int(np.sort(want)[-20]), int(want.max()) + 1):
        places, score = block.search(terms, least)
        assert sorted(places.tolist()) == np.flatnonzero(want >= least).tolist()
        assert (want[places] == score).all()


@pytest.mark.parametrize("spill", [False, True])
def test_collocations_random(spark, monkeypatch, spill):
    docs = random_texts(300, 5, 3)
    if spill:
        monkeypatch.setattr(phrases, "SPILL", 300)
        monkeypatch.setattr(phrases, "CHUNK", 64)
        monkeypatch.setattr(phrases, "BURST", 20)
        monkeypatch.setattr(phrases, "PART_BYTES", 2000)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    for low, top in ((5, 2000), (30, 7)):
        got = phrases.collocations(df, low, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = brute.collocations(docs, low, top)
        assert len(want) > 3
        assert rows(got, *got.columns) == sorted(want, key=str)


def test_collocations_messy(spark, messy, empty):
    docs = [(r[0], r[1], r[2]) for r in ROWS]
    got = phrases.collocations(messy, 2, 50)
    assert rows(got, *got.columns) == sorted(brute.collocations(docs, 2, 50), key=str)
    assert phrases.collocations(empty).count() == 0


def test_trie_bursts_and_counts():
    """Ranges of first words split, a heavy first word gets a level of its own, nothing is lost."""
    rnd = random.Random(8)
    trie = phrases.HatTrie(burst=16)
    ids = [trie.words[b"w%d" % (0 if rnd.random() < 0.4 else rnd.randint(1, 60))] if rnd.random() < 0.9 else 0
           for _ in range(5000)]
    for at in range(0, len(ids), 700):
        trie.add(np.array(ids[at:at + 703], np.int64), min(700, len(ids) - at))
    assert any(isinstance(k, phrases._Node) for k in trie.root.kids) and len(trie.root.kids) > 5
    pairs = list(trie.pairs)
    got = {}
    for leaf in trie._leaves(trie.root):
        for k, c in leaf.items():
            got[pairs[k >> 40] << 40 | k & (1 << 40) - 1] = c
    want = {}
    for i in range(len(ids)):
        w = (ids[i:] + [0] * 4)[:4]
        for j in range(1, 4):
            w[j] = w[j] if w[j - 1] else 0
        if w[0]:
            k = w[0] << 60 | w[1] << 40 | w[2] << 20 | w[3]
            want[k] = want.get(k, 0) + 1
    assert got == want and trie.size == len(want)


def test_arithmetic_is_exact(spark):
    """2000000 * a beyond 64 bits."""
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([("en", "", 0, big), ("en", "p q", 2, big - 7), ("en", "p", 1, big - 3), ("en", "q", 1, big)],
                               "lang string, phrase string, len int, f long")
    from unittest import mock
    with mock.patch.object(phrases, "phrase_counts", lambda *a: df):
        got = phrases.collocations(df).collect()
    assert [(r["score"], r["n"]) for r in got] == [(2_000_000 * (big - 7) // (2 * big - 3), big)]
