"""Ranked lexical search by hybrid term-at-a-time / document-at-a-time evaluation.

1. The documents are scanned once.  Each task cuts its rows into blocks of at most
   ``BLOCK_DOCS`` documents and writes an inverted index of the block: one row for each
   query term found, with the places of its documents and their term frequencies, and one
   row with the block's ids and lengths.  Nothing is shuffled; the index is stored.
2. Document frequencies, the number of documents and their length are sums over index rows.
3. Each block is searched for every item.  Terms with short lists are evaluated term at a
   time into one array of summed accumulators; that array then counts as a single iterator
   with a bound of its own (its greatest sum in a range of documents) and is merged, document
   at a time, with the long lists: a range whose bounds cannot reach the score of the
   item's present k-th document is skipped, and inside a range a document is dropped as soon
   as what it has and what the lists left can add fall below it.  Places that one numpy
   operation can treat alike are treated together.
4. A task gives its k best documents for each item; a window over those picks the k best.

The items are dealt into groups of a bounded number of terms; a group is broadcast and
searched in a pass of its own, so the benchmark may be of any size.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import folded_words, materialize

TOP = 20
BLOCK_DOCS = 4096
BLOCK_WORDS = 1 << 23
RANGE = 256               # documents under one bound
SHORT_SHARE = 16          # a list of at most 1/16 of a block's documents is short
GROUP_TERMS = 200_000     # item terms that one pass broadcasts
_HEAD = -1


def _item_terms(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                terms, times = np.unique(np.array(folded_words(text.as_py()), object), return_counts=True)
                rows += [(item, t.decode("utf-8", "surrogatepass"), int(n)) for t, n in zip(terms, times, strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    return run


def _index(shipped, schema: pa.Schema):
    """Rows to the inverted index of their blocks, restricted to the shipped terms."""
    def flush(ids: list, sizes: list[int], found: list[np.ndarray]):
        n = len(ids)
        keys = np.concatenate(found) if found else np.empty(0, np.int64)
        keys, tf = np.unique(keys, return_counts=True)        # term * 2**32 + place, in order
        term, place = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32)
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        ends = np.append(starts, len(term))[1:]
        rows = [(_HEAD, n, ids, np.array(sizes, np.int64).tobytes(), None)]
        rows += [(int(term[a]), int(b - a), None, place[a:b].tobytes(), tf[a:b].astype(np.int32).tobytes())
                 for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        number = shipped.value
        ids, sizes, found, words = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ws = folded_words(text.as_py())
                t = np.fromiter((x for x in map(number.get, ws) if x is not None), np.int64)
                found.append(t << 32 | len(ids))
                ids.append(doc_id)
                sizes.append(len(ws))
                words += len(ws)
                if len(ids) >= BLOCK_DOCS or words >= BLOCK_WORDS:
                    yield flush(ids, sizes, found)
                    ids, sizes, found, words = [], [], [], 0
        if ids:
            yield flush(ids, sizes, found)
    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Block:
    """The posting lists of one block with their scores and range bounds."""

    def __init__(self, ids: list, sizes: np.ndarray, n_docs: int, n_words: int):
        self.ids, self.n = ids, len(ids)
        self.m = 75 + (25 * sizes * n_docs) // max(1, n_words)
        self.edges = np.arange(0, self.n, RANGE)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.long: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.acc = np.zeros(self.n, np.int64)

    def add(self, term: int, places: np.ndarray, tf: np.ndarray, weight: int) -> None:
        tf = tf.astype(np.int64)
        score = weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * self.m[places]))
        if len(places) * SHORT_SHARE <= self.n:
            self.short[term] = (places, score)
        else:
            whole = np.zeros(self.n, np.int64)
            whole[places] = score
            self.long[term] = (whole, np.maximum.reduceat(whole, self.edges))

    def search(self, terms: list[tuple[int, int]], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents of the block that score ``least`` or more."""
        acc = self.acc
        acc[:] = 0
        for t, times in terms:                       # term at a time: the short lists
            if t in self.short:
                places, score = self.short[t]
                acc[places] += times * score
        lists = [(times * self.long[t][1], times, self.long[t][0]) for t, times in terms if t in self.long]
        bound = reduce(np.add, [b for b, _, _ in lists], np.maximum.reduceat(acc, self.edges))
        live = np.flatnonzero(bound >= least)
        if not len(live):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # document at a time over the accumulators and the long lists, in the ranges not skipped
        places = (live[:, None] * RANGE + np.arange(RANGE)).ravel()
        places = places[places < self.n]
        have = acc[places]
        lists.sort(key=lambda x: -int(x[0].max()))
        left = reduce(np.add, [b for b, _, _ in lists], np.zeros(len(self.edges), np.int64))
        for top, times, whole in lists:
            keep = have + left[places // RANGE] >= least
            places, have = places[keep], have[keep]
            have = have + times * whole[places]
            left = left - top
        keep = have >= least
        return places[keep], have[keep]


def _order(row: tuple) -> tuple:
    return -row[0], row[1] is None, 0 if row[1] is None else row[1]


def _search(shipped, n_docs: int, n_words: int, top: int, schema: pa.Schema):
    """Index rows of a partition (a block's rows stand together, its ids first) to the
    ``top`` best documents of each item."""
    def run(batches):
        weights, items = shipped.value
        best: list[list[tuple]] = [[] for _ in items]
        block = None

        def finish():
            for best_of, (_, terms) in zip(best, items, strict=True):
                least = best_of[-1][0] if len(best_of) >= top else 1
                places, score = block.search(terms, least)
                if not len(places):
                    continue
                if len(places) > top:                # ties with the last one stay in for now
                    keep = score >= np.partition(score, len(score) - top)[len(score) - top]
                    places, score = places[keep], score[keep]
                best_of += [(int(s), block.ids[p]) for p, s in zip(places.tolist(), score.tolist(), strict=True)]
                best_of.sort(key=_order)
                del best_of[top:]

        for batch in batches:
            for term, ids, a, b in zip(batch.column("term").to_pylist(), batch.column("ids"), batch.column("a"),
                                       batch.column("b"), strict=True):
                if term == _HEAD:
                    if block is not None:
                        finish()
                    block = _Block(ids.as_py(), np.frombuffer(a.as_py(), np.int64), n_docs, n_words)
                else:
                    block.add(term, np.frombuffer(a.as_py(), np.int32), np.frombuffer(b.as_py(), np.int32), weights[term])
        if block is not None:
            finish()
        rows = [(item, doc, s) for found, (item, _) in zip(best, items, strict=True) for s, doc in found]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    return run


def build_index(docs: DataFrame, number: dict[bytes, int], text_col: str = "text") -> DataFrame:
    """The stored block index: ``term`` (-1: the block's head), ``n``, ``ids``, ``a``, ``b``
    (places and frequencies as arrays of bytes; in a head the documents' lengths)."""
    out = T.StructType([
        T.StructField("term", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    shipped = docs.sparkSession.sparkContext.broadcast(number)
    return materialize(docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(
        _index(shipped, to_arrow_schema(out)), out))


def _ranked(docs: DataFrame, terms: DataFrame, item_type: T.DataType, top: int, text_col: str) -> DataFrame:
    """(item_id, doc_id, score): the tasks' best documents for one bounded group of items."""
    spark = docs.sparkSession
    grouped = terms.groupBy("item_id").agg(F.collect_list(F.struct("term", "times")).alias("terms")).collect()
    number: dict[bytes, int] = {}
    items = []
    for r in grouped:
        items.append((r["item_id"], [(number.setdefault(t["term"].encode("utf-8", "surrogatepass"), len(number)), t["times"])
                                     for t in r["terms"]]))
    index = build_index(docs, number, text_col)
    df = {r["term"]: r["df"] for r in index.where(F.col("term") != _HEAD).groupBy("term").agg(F.sum("n").alias("df")).collect()}
    n_docs, n_words = _totals(index)
    weights = {t: term_weight(n_docs, n) for t, n in df.items()}
    out = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                        T.StructField("score", T.LongType())])
    shipped = spark.sparkContext.broadcast((weights, items))
    return index.mapInArrow(_search(shipped, n_docs, n_words, top, to_arrow_schema(out)), out)


def _totals(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms of all documents, from the blocks' heads."""
    def run(batches):
        for batch in batches:
            sizes = [np.frombuffer(a.as_py(), np.int64) for a in batch.column("a")]
            yield pa.RecordBatch.from_arrays([pa.array([int((s > 0).sum()) for s in sizes], pa.int64()),
                                              pa.array([int(s.sum()) for s in sizes], pa.int64())], names=["d", "w"])
    row = index.where(F.col("term") == _HEAD).select("a").mapInArrow(run, "d long, w long").agg(
        F.sum("d").alias("d"), F.sum("w").alias("w")).first()
    return row["d"] or 0, row["w"] or 0


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text_col: str = "text",
           id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``top`` best documents of each item: item_id, ``rank`` (int, from 1), doc_id,
    ``score`` (long, above 0); equal scores by ascending doc_id.

    Terms are runs of ``[0-9A-Za-z]`` and everything outside ASCII, A-Z lower-cased.  With N
    documents that have a term, L terms in all, a document's n terms and a term's tf in it,
    m = 75 + 25 n N div L, and the document scores the sum of
    w * (10**9 tf div (1000 tf + 12 m)) over the item's terms with repeats, where
    w = floor(1000 ln((2 N + 2) / (2 df + 1))).

    Defined results: null and empty texts have no terms, so they are found by nothing and
    count nowhere; an item without terms, or none of whose terms occur, has no rows; rows
    of one item_id (null included) are one item; rows of one doc_id are separate documents,
    ranked each; a null doc_id stands behind the others of its score; empty tables give an
    empty table; other columns are ignored."""
    item_type = items.schema[id_col].dataType
    terms_type = T.StructType([T.StructField("item_id", item_type), T.StructField("term", T.StringType()),
                               T.StructField("times", T.LongType())])
    terms = items.select(F.col(id_col).alias("item"), F.col(item_text_col).alias("text")).mapInArrow(
        _item_terms(to_arrow_schema(terms_type)), terms_type)
    terms = materialize(terms.groupBy("item_id", "term").agg(F.sum("times").alias("times")))
    groups = max(1, math.ceil(terms.count() / GROUP_TERMS))
    slot = F.pmod(F.xxhash64(F.col("item_id")), F.lit(groups))
    found = reduce(DataFrame.union, [
        _ranked(docs, terms.where(slot == g) if groups > 1 else terms, item_type, top, text_col) for g in range(groups)])
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")
