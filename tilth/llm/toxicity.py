"""Toxicity by maximum-scoring segments of token log-odds.

Fit (on a bounded sample of labelled documents): a token's score is the log-odds ratio of
toxic against clean documents under a Dirichlet prior in proportion to its overall
frequency, moved towards zero by two standard errors, less a drift that makes an average
clean token negative.  Tokens are hashed into ``BUCKETS`` places, so the model is one
array of fixed size.

Score: one linear pass finds every maximal scoring segment of a text (all disjoint
passages whose score cannot be raised by growing or shrinking them).  Segment scores
follow an extreme-value law: the number of segments of score S or more that chance
gives in n tokens is K n exp(-lambda S), with lambda from the clean scores and K from the
clean documents' best segments.  A document's evidence is the sum over its significant
segments of -ln of that number, and a logistic curve fitted on sample documents that
the token scores have not seen turns it into a probability (classes weigh as they do among
all labels, whatever their share of the sample).  Documents without a significant segment
stand below the curve's start, in the order of their best segment's number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import class_sample, folded_words, materialize

BUCKETS = 1 << 18
SAMPLE = 20_000        # labelled documents the model is fitted on, at most, divided among the labels
PRIOR_MASS = 500.0
DRIFT = 0.25
SIGNIFICANT = 1.0      # a segment counts if chance gives fewer than this many a document
FIT_SHARE = 70         # percent of the sample for token scores; the rest calibrates
PREFIX_BYTES = (4, 5, 6, 7, 8, 9)
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class ToxicityModel:
    scores: np.ndarray        # float32[BUCKETS]: log-odds, two standard errors nearer to zero
    decay: float              # lambda of the extreme-value law
    log_k: float
    slope: float
    offset: float
    significant: float = SIGNIFICANT

    def segments(self, scores: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """Best raw score and the significant segments (first token, end, evidence)."""
        found = maximal_segments(scores)
        base = self.log_k + math.log(max(1, len(scores)))
        strong = [(a, b, self.decay * s - base) for a, b, s in found]
        return max((x[2] for x in found), default=0.0), [x for x in strong if x[2] > -math.log(self.significant)]

    def probability(self, evidence: float, best: float, n_tokens: int) -> float:
        """From the evidence of significant segments; without any, a clean verdict is lowered
        by the number of segments like the best one that chance gives (to a half at most)."""
        p = 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * math.log1p(evidence) + self.offset))))
        if evidence > 0 or p >= 0.5:
            return p
        number = self.log_k + math.log(max(1, n_tokens)) - self.decay * best
        return p * (1.0 + math.exp(-max(0.0, number))) / 2


def word_buckets(word: bytes) -> list[int]:
    """The places of a word and of its beginnings: inflected and compound forms of a rare
    word share these, and are judged by them while they are rare themselves."""
    parts = [word] + [b"^" + word[:n] for n in PREFIX_BYTES if n < len(word)]
    return [xxhash.xxh3_64_intdigest(p) & (BUCKETS - 1) for p in parts]


class WordScores(dict):
    """A word's score, looked up once for each worker and word while the cache has room: the
    firmest (largest) log-odds among its places, less the drift."""

    def __init__(self, scores: np.ndarray):
        super().__init__()
        self.scores = scores

    def __missing__(self, word: bytes) -> float:
        odds = self.scores[word_buckets(word)]
        value = float(odds[np.abs(odds).argmax()]) - DRIFT
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        ws = folded_words(text)
        return np.fromiter(map(self.__getitem__, ws), np.float32, len(ws))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in linear time.

    Neighbours of one sign are first summed to runs, for a maximal segment never cuts
    one.  Then each positive run joins a list of candidates with the running totals at
    its two ends; it swallows earlier candidates while one with a smaller left total and
    a smaller right total exists, and each candidate is looked at a constant number of
    times."""
    if not len(scores) or scores.max() <= 0:
        return []
    positive = scores > 0
    edges = np.flatnonzero(np.diff(positive)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(scores)]])
    totals = np.cumsum(scores, dtype=np.float64)
    held: list[list] = []      # first, end, left total, right total, earlier one with a smaller left total
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if not positive[a]:
            continue
        left = float(totals[a - 1]) if a else 0.0
        new = [a, b, left, float(totals[b - 1]), -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(x[0], x[1], x[3] - x[2]) for x in held]


def _count(schema: pa.Schema):
    def run(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                places = {b for w in set(folded_words(text.as_py())) for b in word_buckets(w)}
                seen[toxic, np.fromiter(places, np.int64, len(places))] += 1
                docs[toxic] += 1
        for label in (0, 1):
            at = np.flatnonzero(seen[label])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([at, [-1]]), pa.int64()), pa.array(np.full(len(at) + 1, label), pa.int64()),
                pa.array(np.concatenate([seen[label][at], [docs[label]]]), pa.int64())], schema=schema)
    return run


def token_scores(counts: np.ndarray) -> np.ndarray:
    """Log-odds with a Dirichlet prior, two standard errors nearer to zero.
    ``counts`` [clean, toxic] x buckets: documents of the sample that hold the token."""
    total = counts.sum()
    prior = PRIOR_MASS * (counts.sum(axis=0) + 0.01) / (total + 0.01 * counts.shape[1])
    mass = counts.sum(axis=1, keepdims=True) + PRIOR_MASS
    y = counts + prior
    odds = np.log(y) - np.log(mass - y)
    delta = odds[1] - odds[0]
    error = np.sqrt(1 / y[0] + 1 / y[1])
    firm = np.sign(delta) * np.maximum(0, np.abs(delta) - 2 * error)
    return firm.astype(np.float32)


def _decay(scores: np.ndarray, weight: np.ndarray) -> float:
    """The lambda > 0 at which the mean of exp(lambda * score) over clean tokens is 1."""
    p = weight / weight.sum()
    if not (scores[p > 0] > 0).any():
        return 1.0
    lo, hi = 1e-6, 1.0
    mean = lambda x: float((p * np.exp(np.minimum(x * scores, 700))).sum())
    while mean(hi) < 1 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return hi


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve by Newton steps; a small penalty keeps
    them finite where the classes separate."""
    beta, design = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    penalty = np.diag([1e-2, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - penalty @ beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _evidence(model, schema: pa.Schema, keep: list[str], full: bool):
    """Batches to: kept columns, tokens, evidence and best raw score (or the score rows)."""
    def run(batches):
        m: ToxicityModel = model.value
        words = WordScores(m.scores)
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema if f.name not in keep}
            for text in batch.column("text"):
                scores = words.of(text.as_py())
                best, strong = m.segments(scores)
                evidence = sum(x[2] for x in strong)
                out["n_tokens"].append(len(scores))
                if full:
                    p = m.probability(evidence, best, len(scores))
                    out["score"].append(p)
                    out["predicted"].append(int(p >= 0.5))
                    out["passages"].append([{"first": a, "end": b, "evidence": e} for a, b, e in strong])
                else:
                    out["evidence"].append(evidence)
                    out["best"].append(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(out[f.name], f.type) for f in schema if f.name not in keep],
                schema=schema)
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> ToxicityModel | None:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id, toxic), chosen by id hash; a rare
    label's rows are taken up to half of the sample.

    Only ids and labels of the sample are broadcast (their number is bounded); texts stay
    where they are read.  The driver receives bucket counts (a fixed number) and two
    numbers for each calibration document.  None if the sample lacks one of the classes."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("long").alias("toxic"))
    picked, labelled, taken = class_sample(known, sample, "toxic")
    texts = docs.select("doc_id", F.col(text_col).alias("text")).join(F.broadcast(picked), "doc_id")
    texts = materialize(texts.withColumn(
        "fits", F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id").cast("string")), F.lit(100)) < FIT_SHARE))

    schema = pa.schema([("bucket", pa.int64()), ("toxic", pa.int64()), ("n", pa.int64())])
    counted = texts.where("fits").select("toxic", "text").mapInArrow(
        _count(schema), "bucket long, toxic long, n long").groupBy("bucket", "toxic").agg(F.sum("n").alias("n"))
    counts, n_docs = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in counted.collect():
        if r["bucket"] < 0:
            n_docs[r["toxic"]] += r["n"]
        else:
            counts[r["toxic"], r["bucket"]] = r["n"]
    if not n_docs.all():
        return None
    scores = token_scores(counts)
    decay = _decay(scores.astype(np.float64) - DRIFT, counts[0])

    def measured(model: ToxicityModel) -> list:
        keep = T.StructType([T.StructField("toxic", T.LongType()), T.StructField("n_tokens", T.LongType()),
                             T.StructField("evidence", T.DoubleType()), T.StructField("best", T.DoubleType())])
        run = _evidence(spark.sparkContext.broadcast(model), to_arrow_schema(keep), ["toxic"], False)
        return texts.where("not fits").select("toxic", "text").mapInArrow(run, keep).collect()

    # K: clean documents' best segments against their length (mean of a Gumbel variable)
    rows = [r for r in measured(ToxicityModel(scores, decay, 0.0, 1.0, 0.0)) if r["n_tokens"]]
    clean = [decay * r["best"] - math.log(r["n_tokens"]) for r in rows if not r["toxic"]]
    log_k = float(np.mean(clean)) - 0.5772156649 if clean else 0.0
    rows = [r for r in measured(ToxicityModel(scores, decay, log_k, 1.0, 0.0)) if r["n_tokens"]]
    x, y = np.log1p([r["evidence"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    if not len(y) or y.min() == y.max():
        return ToxicityModel(scores, decay, log_k, 1.0, -1.0)
    each = {c: labelled[c] / taken[c] for c in labelled if taken[c]}
    weight = np.array([each[int(c)] for c in y])
    return ToxicityModel(scores, decay, log_k, *_logistic(x, y, weight / weight.mean()))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``score`` (probability of label 1), ``predicted``,
    ``n_tokens``, ``passages`` array<struct<first, end, evidence>> in token places.

    Defined results: null or empty texts have no passages and the score of a text without
    evidence; without a model (no labelled document of one class) every score is 0;
    repeated rows score alike; an empty table gives an empty table; other columns are
    ignored."""
    passage = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()),
                            T.StructField("evidence", T.DoubleType())])
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()),
                        T.StructField("predicted", T.IntegerType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("passages", T.ArrayType(passage))])
    own = docs.select("doc_id", F.col(text_col).alias("text"))
    if model is None:
        return own.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("n_tokens"),
                          F.array().cast(T.ArrayType(passage)).alias("passages"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return own.mapInArrow(_evidence(shipped, to_arrow_schema(out), ["doc_id"], True), out)
