"""Repeated byte strings against a plain Python version."""

import hashlib
import random

import brute
import numpy as np
import pytest
from text_fixtures import ROWS, empty, messy  # noqa: F401

from tilth.llm import repeats


def spans(df):
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"])) for r in df.collect()), key=str)


def agree(df, docs, length):
    """Spans, digest and what is left, first copies removed or kept."""
    want = brute.repeats(docs, length, True)
    got = sorted((tuple(r) for r in repeats.remove_repeats(df, length).select("doc_id", "kept").collect()), key=str)
    assert [(d, bytes(k)) for d, k in got] == sorted(((d, k) for d, _, _, k in want), key=str)
    want = brute.repeats(docs, length)
    got = sorted((tuple(r) for r in repeats.digest(df, length).collect()), key=str)
    assert got == sorted(((d, n, n - len(k), len(s), hashlib.sha256(k).hexdigest()) for d, n, s, k in want), key=str)
    return sum(len(s) for _, _, s, _ in want)


def mixed(seed, n=60):
    """Passages in shifting surroundings, copies, cuts inside characters, self-overlaps."""
    rnd = random.Random(seed)
    letters = "abcdefghij éß日"
    noise = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passages = [noise(rnd.randint(20, 120)) for _ in range(5)]
    out = []
    for i in range(n):
        t = "".join(rnd.choice([noise(rnd.randint(0, 60)), rnd.choice(passages), rnd.choice(passages)[rnd.randint(0, 15):],
                                "ab" * rnd.randint(0, 60), "a" * rnd.randint(0, 90)]) for _ in range(rnd.randint(0, 5)))
        out.append((i, t))
    return out + [(100 + i, out[i * 3][1]) for i in range(10)] + [(None, out[4][1]), (None, out[5][1])]


@pytest.mark.parametrize("length", [40])
def test_mixed(spark, length):
    docs = mixed(length)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert agree(df, docs, length) > 20
    want = brute.repeats(docs, length, True)
    assert spans(repeats.find_repeats(df, length, True)) == sorted(((d, n, tuple(s)) for d, n, s, _ in want), key=str)


def test_classes_beyond_a_block(spark, monkeypatch):
    """With tiny blocks every class is divided, down to the windows themselves."""
    monkeypatch.setattr(repeats, "BLOCK_STARTS", 200)
    docs = mixed(7, 40)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert agree(df, docs, 40) > 20


def test_messy(messy, empty):
    docs = [(r[0], r[1]) for r in ROWS]
    assert agree(messy, docs, 40) > 4
    assert repeats.digest(empty).count() == 0 and repeats.remove_repeats(empty).columns == [*empty.columns[:6], *[
        c for c in empty.columns[6:] if c != "kept"], "kept"]


def test_long_texts_in_pieces(spark, monkeypatch):
    """A text cut into chunks, and stretches of one byte."""
    monkeypatch.setattr(repeats, "_CHUNK", 1000)
    monkeypatch.setattr(repeats, "_LONGEST_RUN", 64)
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(3500))
    docs = [(1, base), (2, "x" * 37 + base[300:3100] + "tail"), (3, "z" * 1500), (4, "yy" + "z" * 200 + "end")]
    assert agree(spark.createDataFrame(docs, "doc_id long, text string"), docs, 50) >= 4


def test_repeats_inside_one_text(spark):
    """A stretch of one byte or of a short period repeats by itself, wherever it is unique."""
    rnd = random.Random(9)
    noise = lambda k: "".join(rnd.choice("klmnopqrst uvw") for _ in range(k))
    docs = [(1, noise(90) + "ab" * 60 + noise(70)), (2, "c" * 41), (3, "d" * 40), (4, noise(200)), (5, "abcdefghij" * 9 + noise(50)),
            (6, (noise(45) + "#") * 2)]
    assert agree(spark.createDataFrame(docs, "doc_id long, text string"), docs, 40) >= 4


def test_a_line_over_and_over_in_many_texts(spark, monkeypatch):
    """Equal windows of a run are settled in the run: a class of texts that repeat one line counts a
    window once a text, fits a block, and what goes with a copy is spans, not windows."""
    monkeypatch.setattr(repeats, "BLOCK_STARTS", 1500)
    rnd = random.Random(11)
    noise = lambda k: "".join(rnd.choice("klmnopqrst uvw") for _ in range(k))
    line = noise(9) + "\n"
    docs = [(i, noise(rnd.randint(0, 20)) + line * rnd.randint(26, 34) + noise(rnd.randint(0, 20))) for i in range(12)]
    docs += [(100 + i, docs[0][1]) for i in range(3)]
    rows, real = [], repeats._divided
    monkeypatch.setattr(repeats, "_divided", lambda contents, *a: rows.append(contents.count()) or real(contents, *a))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert agree(df, docs, 40) == len(docs) and not rows
    scanned = repeats._scanned(repeats._identified(df, "text"), 40, 13)
    assert max(sum(x["hi"] - x["lo"] + 1 for x in r["runs"]) for r in scanned.collect()) < 110


def test_spans_of_windows_are_joined(spark, monkeypatch):
    """Classes divided down to the windows give back stretches, not one span a window."""
    monkeypatch.setattr(repeats, "BLOCK_STARTS", 200)
    docs = mixed(7, 30)
    found, real = [], repeats._divided
    monkeypatch.setattr(repeats, "_divided", lambda *a: found.append(real(*a)) or found[-1])
    repeats.find_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 40)
    spans = [r["later"] for df in found for r in df.collect()]
    assert spans and all(x["b"] + 1 < y["a"] for s in spans for x, y in zip(s, s[1:], strict=False))


@pytest.mark.parametrize("seed", range(4))
def test_factors(seed):
    """Longest previous and next factors of all suffixes of a text against their definition."""
    rnd = np.random.default_rng(seed)
    text = rnd.integers(97, 99 + seed, 300).astype(np.uint8)
    text[200:260] = text[20:80]
    length, raw = 9, text.tobytes()
    starts = np.arange(len(text) - length + 1)
    previous, following = repeats.factors(raw, starts, length)

    def match(i, j):
        n = 0
        while max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
            n += 1
        return n
    for p in starts:
        before = max((match(p, j) for j in range(p)), default=0)
        after = max((match(p, j) for j in range(p + 1, len(starts))), default=0)
        for got, want in ((previous[p], before), (following[p], after)):
            assert got == (length if want >= length else 0)


def test_hashes_and_minima():
    data = np.frombuffer(b"the same words here, and the same words there", np.uint8)
    h = repeats.gram_hashes(data, 8)
    assert len(h) == len(data) - 7 and h[0] == h[25] and len(set(h.tolist())) >= 30
    x = np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)
    assert repeats.sliding_least(x, 7).tolist() == [min(x[i:i + 7]) for i in range(94)]
