"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of ten words, a window into shingles of four.  A
document can only hold a window if it holds all its shingles, so it is enough to join the
rarest one (rarity: how often the corpus has it); the place of that shingle in the window
then gives the window's place in the document, bounded by the document's length, and the
words there are compared one by one.

The scan over the documents marks the places where any benchmark shingle may stand.  It
asks a bit table of fixed size (``FILTER_BITS``, 4 MB however large the benchmark grows),
the only thing that is broadcast; what passes is joined on the shingle itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import folded_words, materialize, sha256_hex

WINDOW = 10
SHINGLE = 4
FILTER_BITS = 25
_FACTORS = np.random.default_rng(23).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def _tokens(h: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit token for each run of ``width`` words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out += h[j:j + n] * _FACTORS[j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def _cut(window: int, shingle: int, schema: pa.Schema):
    """Benchmark rows to (item, window text, its length, place and token of a shingle)."""
    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                ws = folded_words(text.as_py())
                size = min(window, len(ws))
                width = min(shingle, size)
                if not size:
                    continue
                tokens = _tokens(_hashes(ws), width).view(np.int64)
                for at in range(len(ws) - size + 1):
                    words = b" ".join(ws[at:at + size]).decode("utf-8", "surrogatepass")
                    for j in range(size - width + 1):
                        rows.append((item, words, size, width, j, int(tokens[at + j])))
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    return run


def _scan(bits, widths: tuple[int, ...], window: int, schema: pa.Schema):
    """Documents to their word count and the places where a benchmark shingle may stand,
    with the words around (``window`` - 1 before at most, as many after)."""
    def run(batches):
        table = np.frombuffer(bits.value, np.uint8)
        mask = np.uint64(len(table) * 8 - 1)
        for batch in batches:
            n_words, hits = [], []
            for text in batch.column("text"):
                ws = folded_words(text.as_py())
                n_words.append(len(ws))
                found = []
                if ws:
                    h = _hashes(ws)
                    for width in widths:
                        tokens = _tokens(h, width)
                        x = (tokens & mask).astype(np.int64)
                        at = np.nonzero((table[x >> 3] >> (x & 7).astype(np.uint8)) & 1)[0]
                        for p in at.tolist():
                            lo = max(0, p + width - window)
                            around = b" ".join(ws[lo:p + window]).decode("utf-8", "surrogatepass")
                            found.append({"pos": p, "lead": p - lo, "token": int(tokens[p].view(np.int64)), "around": around})
                hits.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n_words, pa.int64()),
                 pa.array(hits, schema.field("hits").type)], schema=schema)
    return run


def benchmark_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                      id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words, size, width, place, token): every window with its shingles."""
    schema = pa.schema([("item", pa.string()), ("words", pa.string()), ("size", pa.int32()), ("width", pa.int32()),
                        ("place", pa.int32()), ("token", pa.int64())])
    return items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                        F.col(text_col).alias("text")).mapInArrow(
        _cut(window, shingle, schema), "item string, words string, size int, width int, place int, token long")


def token_filter(tokens: DataFrame, n_bits: int = FILTER_BITS) -> bytes:
    """A bit table of 2**n_bits bits, bit ``token mod 2**n_bits`` set for each token.  Spark
    builds it in pieces of 4 KB; at most 2**n_bits / 8 bytes reach the driver."""
    slot = F.col("token").bitwiseAND(F.lit((1 << n_bits) - 1))
    pieces = tokens.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("piece")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits"))
    table = bytearray((1 << n_bits) // 8)
    for row in pieces.collect():
        table[row["piece"] * 4096:row["piece"] * 4096 + 4096] = row["bits"]
    return bytes(table)


def _union_size(spans: Column) -> Column:
    """How many places the spans (start, size), in order of start, cover together."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["start"] + s["size"])
        return F.struct((acc["n"] + end - F.greatest(acc["end"], s["start"])).alias("n"), end.alias("end"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``n_words``, ``n_hit``, ``item_ids`` (sorted strings),
    ``contaminated``; ``__row`` (a hash of the text) tells rows of one doc_id apart.

    Words are ``[0-9a-z]`` and everything outside ASCII, A-Z lower-cased.  An item's
    windows are ``window`` consecutive words, or all of them if fewer; a document word
    inside an occurrence of a window is hit.

    Defined results: null or empty text has no words and no hits; an item without words
    occurs nowhere; an item without id reports as ``null``; rows of one item_id add up;
    repeated documents get equal rows; empty tables give no rows or no hits; other
    columns are ignored."""
    spark = docs.sparkSession
    shingles = materialize(benchmark_windows(items, window, shingle))
    widths = tuple(sorted(r[0] for r in shingles.select("width").distinct().collect()))
    bits = spark.sparkContext.broadcast(token_filter(shingles))

    id_type = docs.schema["doc_id"].dataType
    own = docs.select("doc_id", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), F.col(text_col).alias("text"))
    hit = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("lead", T.IntegerType()),
                        T.StructField("token", T.LongType()), T.StructField("around", T.StringType())])
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("row", T.LongType()),
                        T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(hit))])
    scanned = materialize(own.mapInArrow(_scan(bits, widths, window, to_arrow_schema(out)), out))

    places = scanned.where(F.size("hits") > 0).select("doc_id", "row", F.explode("hits").alias("h")).select(
        "doc_id", "row", "h.*")
    # rarest shingle of each window; a window with a shingle the corpus lacks occurs nowhere
    seen = places.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    windows = shingles.select("words", "size", "width", "place", "token").distinct()
    ranked = windows.join(seen, "token").groupBy("words", "size", "width").agg(
        F.count(F.lit(1)).alias("present"), F.min(F.struct("cnt", "place", "token")).alias("rarest"))
    prefix = ranked.where(F.col("present") == F.col("size") - F.col("width") + 1).select(
        "words", "size", F.col("rarest.place").alias("place"), F.col("rarest.token").alias("token"))

    met = places.join(prefix, "token").where(F.col("lead") >= F.col("place"))
    there = F.slice(F.split("around", " "), F.col("lead") - F.col("place") + 1, F.col("size"))
    found = met.where(F.array_join(there, " ") == F.col("words")).select(
        "doc_id", "row", (F.col("pos") - F.col("place")).alias("start"), "size", "words")
    found = materialize(found)

    spans = found.groupBy("doc_id", "row").agg(
        _union_size(F.sort_array(F.collect_set(F.struct("start", "size")))).alias("n_hit"))
    owners = shingles.select("words", "item").distinct()
    named = found.select("doc_id", "row", "words").distinct().join(owners, "words").groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"))
    dirty = spans.withColumnRenamed("doc_id", "__id").withColumnRenamed("row", "__of").join(
        named.withColumnRenamed("doc_id", "__id2").withColumnRenamed("row", "__of2"),
        F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__of") == F.col("__of2")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__of"))
    return scanned.select("doc_id", "row", "n_words").join(dirty, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"), F.col("row").alias("__row"))


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the contract: item lists as a count and a digest."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        sha256_hex(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark window, with their own columns."""
    found = find_contamination(docs, items, **options).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("__row").alias("__of")).distinct()
    own = docs.withColumn("__row", F.xxhash64(F.coalesce(F.col(options.get("text_col", "text")), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__of"))
    return own.join(found, same, "left_anti").select(*docs.columns)
