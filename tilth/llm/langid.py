"""Language identification with word-first backoff.

A known word scores each language by minus the log of its relative frequency there (a
fixed penalty where the language lacks it).  An unseen word falls back to its character
n-grams, longest first: the first length at which some n-gram is known scores the word
by the mean over those n-grams.  A text scores by the mean over its words.

The model is fitted on a bounded sample of labelled documents, in which every language has
its share, and keeps a bounded number of words and n-grams, the same for each language, so
it may be broadcast.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import class_sample, materialize

SAMPLE = 4_000          # labelled documents, at most, divided among the languages
WORDS = 20_000          # words kept, at most: the most frequent of each language
GRAMS = 20_000          # n-grams kept of each length, at most, in the same way
SMOOTHING = 1_000       # added to a language's total, so that a handful of texts is not firm evidence
LONGEST = 5
WORD_BYTES = 60         # longer strings are never words of the model; their n-grams score
PENALTY = 7.0           # minus log10 frequency of what a language lacks
_CACHE = 200_000


_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def letter_words(text: str) -> list[bytes]:
    """Lower-cased runs of letters; only characters inside ASCII separate words."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(unicodedata.category(c)[0] == "L" for c in text)


def grams(word: bytes, n: int) -> list[str]:
    bare = word.decode("utf-8", "surrogatepass")
    padded = f" {bare} " if n > 1 else bare
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    words: dict[bytes, int]         # to rows of ``table``
    grams: list[dict[str, int]]     # by length, 1 first
    table: np.ndarray               # float32[rows, languages]: minus log10 of relative frequency

    def back_off(self, word: bytes) -> list[int]:
        """The rows of the longest n-grams of which some are known."""
        for n in range(len(self.grams), 0, -1):
            known = self.grams[n - 1]
            rows = [known[g] for g in grams(word, n) if g in known]
            if rows:
                return rows
        return []

    def score(self, text: str, cache: dict[bytes, list[int]]) -> np.ndarray | None:
        """The mean score of each language (lower is likelier); None without known parts.

        Every word weighs the same: a known one by its own row, an unseen one by the mean
        of its n-grams' rows."""
        ws = letter_words(text)
        found = list(map(self.words.get, ws))
        rows = [r for r in found if r is not None]
        total, n = self.table[rows].sum(axis=0, dtype=np.float64), len(rows)
        if n < len(ws):
            parts: list[int] = []
            shares: list[float] = []
            for w, r in zip(ws, found, strict=True):
                if r is None:
                    at = cache.get(w)
                    if at is None:
                        at = self.back_off(w)
                        if len(cache) >= _CACHE:
                            cache.clear()
                        if len(w) <= WORD_BYTES:
                            cache[w] = at
                    if at:
                        parts += at
                        shares += [1.0 / len(at)] * len(at)
                        n += 1
            if parts:
                total = total + np.array(shares) @ self.table[parts]
        return total / n if n else None


def _counts(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                seen.setdefault(lang, Counter()).update(letter_words(text.as_py() or ""))
            rows: list[tuple[int, str, str, int]] = []
            for lang, counted in seen.items():
                parts: list[Counter] = [Counter() for _ in range(LONGEST + 1)]
                for w, c in counted.items():
                    if len(w) <= WORD_BYTES:
                        parts[0][w.decode("utf-8", "surrogatepass")] += c
                    for n in range(1, LONGEST + 1):
                        for g in grams(w, n):
                            parts[n][g] += c
                rows += [(n, lang, k, c) for n, p in enumerate(parts) for k, c in p.items()]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
    return run


def fit(docs: DataFrame, sample: int = SAMPLE, words: int = WORDS, grams_kept: int = GRAMS,
        text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Fit on at most ``sample`` of the given labelled rows (those with a lang), divided among
    the languages and chosen by id hash; ids alone are broadcast.  None if there is none.

    Reaching the driver: at most ``words`` + 5 * ``grams_kept`` strings with their counts."""
    own = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        "doc_id", F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    ids = own.where(F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct()
    picked = F.broadcast(class_sample(ids, sample, "lang")[0])
    schema = pa.schema([("n", pa.int32()), ("lang", pa.string()), ("part", pa.string()), ("cnt", pa.int64())])
    counted = materialize(own.join(picked, ["doc_id", "lang"], "left_semi").select("lang", "text").mapInArrow(
        _counts(schema), "n int, lang string, part string, cnt long").groupBy("n", "lang", "part").agg(F.sum("cnt").alias("cnt")))
    totals = {(r["n"], r["lang"]): r["cnt"] for r in counted.groupBy("n", "lang").agg(F.sum("cnt").alias("cnt")).collect()}
    if not totals:
        return None
    n_languages = len({lang for _, lang in totals})
    place = F.row_number().over(Window.partitionBy("n", "lang").orderBy(F.desc("cnt"), "part"))
    room = F.when(F.col("n") == 0, max(1, words // n_languages)).otherwise(max(1, grams_kept // n_languages))
    kept = counted.withColumn("place", place).where(F.col("place") <= room).select("n", "part").distinct()
    table = counted.join(F.broadcast(kept), ["n", "part"]).select("n", "lang", "part", "cnt").toArrow()
    rows = list(zip(*[table.column(c).to_pylist() for c in ("n", "lang", "part", "cnt")], strict=True))

    languages = sorted({lang for _, lang in totals})
    column = {lang: i for i, lang in enumerate(languages)}
    index: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for n, _, part, _ in rows:
        index[n].setdefault(part, sum(map(len, index)))
    costs = np.full((sum(map(len, index)), len(languages)), PENALTY, np.float32)
    for n, lang, part, cnt in rows:
        costs[index[n][part], column[lang]] = min(PENALTY, -math.log10(cnt / (totals[n, lang] + SMOOTHING)))
    named = {w.encode("utf-8", "surrogatepass"): r for w, r in index[0].items()}
    return LanguageModel(languages, named, index[1:], costs)


def _predict(model, schema: pa.Schema):
    def run(batches):
        m: LanguageModel = model.value
        cache: dict[bytes, list[int]] = {}
        for batch in batches:
            pred, score = [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                v = m.score(text, cache) if has_letter(text) else None
                if v is None:
                    # a letter but nothing known: any language, none with confidence
                    pred.append(m.languages[0] if has_letter(text) else "und")
                    score.append(1.0 / len(m.languages) if has_letter(text) else 0.0)
                    continue
                p = 10.0 ** (v.min() - v)
                pred.append(m.languages[int(v.argmin())])
                score.append(float(p.max() / p.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema=schema)
    return run


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``lang_pred``, ``score`` (share of the best language).

    Defined results: null text or text without a letter is ``und`` with score 0; equal
    languages: the first by name; without a model everything is ``und``; repeated rows
    score alike; an empty table gives an empty table; other columns are ignored."""
    own = docs.select("doc_id", F.col(text_col).alias("text"))
    if model is None:
        return own.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return own.mapInArrow(_predict(shipped, to_arrow_schema(out)), out)
