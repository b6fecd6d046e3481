"""MinHash near-dedup as an inverted join on signature coordinates.

1. Each text becomes the set of its distinct word shingles (64-bit hashes) and a
   signature of ``coordinates`` MinHash values.  Equal sets form one class; only its
   smallest doc_id goes on, so copies are never paired.
2. Classes are posted under their coordinate-value pairs.  Two classes that match in at
   least ``matches`` of K coordinates must meet in one of the K - matches + 1 rarest
   of each (prefix); the frequent rest, the long posting lists, is skipped.  A class
   whose values are mostly its own has an empty prefix and goes no further.
3. Classes that meet form families (components of the postings, without any pairs).
   A family is cut into blocks by hash; each pair of blocks is one bounded task that
   compares all its members on the full sets (a matrix product; collisions only led to
   the family and decide nothing here) and returns a star for each connected group
   found, never all its pairs.
4. Components over the stars give every document its group.

No step gathers a whole group: blocks are bounded in members and in shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.llm.common import materialize, word_list
from tilth.llm.components import components

COORDINATES = 32
MATCHES = 16          # a pair at similarity 0.8 falls below with a chance of 3.3 in 100,000 (binomial)
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1 << 18
_SALTS = 64
_ROWS = 2048          # shingles hashed at a time, whatever the text's length
_COLUMNS = 4096       # columns of the overlap product at a time


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; fewer words: all as one."""
    ws = word_list(text)
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    factors = _constants(width, 11)
    n = max(1, len(ws) - width + 1)
    s = np.zeros(n, np.uint64)
    for j in range(min(width, len(ws))):
        s += h[j:j + n] * factors[j]
    s ^= s >> np.uint64(29)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def signature(s: np.ndarray, k: int) -> np.ndarray:
    masks, factors = _constants(k, 13), _constants(k, 17)
    best = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), _ROWS):
        np.minimum(best, ((s[at:at + _ROWS, None] ^ masks) * factors).min(axis=0), out=best)
    return best


def _sign(width: int, k: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            out = {"n": [], "h1": [], "h2": [], "sig": []}
            for t in texts:
                s = shingle_set(t.as_py(), width)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                out["n"].append(len(s))
                out["h1"].append((d >> 64) - (1 << 63))
                out["h2"].append((d & (2**64 - 1)) - (1 << 63))
                out["sig"].append(signature(s, k).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([ids, *[
                pa.array(out[c], schema.field(c).type) for c in out]], schema=schema)
    return run


def _sets(width: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("family"), batch.column("m"), pa.array(sets, pa.list_(pa.int64()))],
                schema=schema)
    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets in a bounded block, by a 0/1 matrix product over the
    shingles that at least two of them share, some columns at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    keep = count[place] > 1
    owner, column = owner[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + _COLUMNS])
        m = np.zeros((n, min(_COLUMNS, int(column[hi - 1]) - at + 1)), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        total += m @ m.T
    return total


def _links(percent: int, schema: pa.Schema):
    """A star for each connected group among the sets of one pair of blocks."""
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sets = [np.unique(np.asarray(s.values.to_numpy(zero_copy_only=False), np.int64)) if len(s) else np.empty(0, np.int64)
                for s in table.column("set")]
        sizes = np.array([len(s) for s in sets], np.int64)
        n = len(sets)
        both = _overlaps(sets).astype(np.int64) if n > 1 else np.zeros((n, n), np.int64)
        linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        linked |= nodes[:, None] == nodes[None, :]
        label = nodes.copy()
        while True:
            low = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
            low = np.minimum(label, low)
            if (low == label).all():
                break
            label = low
        off = label != nodes
        return pa.Table.from_arrays([pa.array(label[off]), pa.array(nodes[off])], schema=schema)
    return run


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80, coordinates: int = COORDINATES,
                    matches: int = MATCHES, text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``n_shingles``, ``component_id``, ``kept``.

    Documents with 100 * intersection >= percent * union of their shingle sets are
    linked; ``component_id`` is the smallest doc_id reachable and ``kept`` marks it.
    doc_id must be integral.

    Defined results: null text or no words: empty set, linked with nothing, its own
    component; a null doc_id takes part in nothing, has a null component and is kept;
    rows with one doc_id are one node (their texts' links add up) and share its
    component; an empty table gives an empty table; other columns are ignored."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("h1", T.LongType()),
              T.StructField("h2", T.LongType()), T.StructField("sig", T.ArrayType(T.LongType()))]
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                       ("sig", pa.list_(pa.int64()))])
    signed = materialize(own.mapInArrow(_sign(width, coordinates, arrow), T.StructType(fields)))
    full = signed.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # only classes with copies need their representative looked up
    placed = full.join(classes.where(F.col("copies") > 1).select("h1", "h2", "rep"), ["h1", "h2"], "left").withColumn(
        "rep", F.coalesce("rep", "doc_id"))
    reps = placed.where(F.col("rep") == F.col("doc_id"))
    families = _dealt(_families(reps, matches), reps)
    stars = _confirmed(own, families, width, percent)
    # a doc_id that repeats with different texts is one node in several classes
    several = full.groupBy("doc_id").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x != y").select("doc_id")
    bridges = placed.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = components(stars.union(bridges))
    linked = placed.select("doc_id", "n", "rep").join(groups, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n", F.coalesce("component", "rep").alias("component"))
    alone = signed.where(F.col("doc_id").isNull() | (F.col("n") == 0)).select(
        "doc_id", "n", F.col("doc_id").alias("component"))
    return linked.union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def _families(reps: DataFrame, matches: int) -> DataFrame:
    """(node, family) of the class representatives that meet another one under a prefix
    posting; families are components of the postings."""
    posted = reps.select(F.col("doc_id").alias("node"), F.posexplode("sig").alias("at", "value")).select(
        "node", F.xxhash64("at", "value").alias("token"))
    # stored, so that the join deals both sides anew and a very common value can be split
    common = materialize(posted.groupBy("token").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1))
    shared = posted.join(common, "token").groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct("cnt", "token"))).alias("tokens")).where(F.size("tokens") >= matches)
    # values of its own count towards the prefix but meet nothing, so K - matches + 1
    # coordinates come down to the rarest (shared - matches + 1) shared ones
    prefix = materialize(shared.select(
        "node", F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))).alias("t")).select(
        "node", F.col("t.token").alias("token")))
    first = prefix.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("last"))
    first = first.where(F.col("b") != F.col("last")).select("token", "b")
    met = prefix.join(first, "token").select(F.col("node").alias("a"), "b")
    return components(met).select("node", F.col("component").alias("family"))


def _dealt(families: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, family, m): with the number of blocks of the family, from its members' count
    and set sizes.  Few families need more than one block; those rows are copied for
    ``_SALTS`` salts, so that the members of one large family meet them in as many tasks."""
    sized = families.join(reps.select(F.col("doc_id").alias("node"), "n"), "node")
    large = sized.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("m")).where("m > 1")
    salted = large.select("family", "m", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("node"), F.lit(_SALTS)).cast("int")
    return families.withColumn("salt", salt).join(salted, ["family", "salt"], "left").select(
        "node", "family", F.coalesce("m", F.lit(1)).alias("m"))


def _confirmed(own: DataFrame, families: DataFrame, width: int, percent: int) -> DataFrame:
    """Stars (a, b) of the groups linked on full sets, from tasks of two blocks each."""
    texts = own.where(F.col("doc_id").isNotNull()).withColumn("h", F.xxhash64("text"))
    per = families.join(texts, F.col("node") == F.col("doc_id")).select("node", "family", "m", "h", "text")
    per = per.dropDuplicates(["node", "h"]).select("node", "family", "m", "text")
    schema = pa.schema([("node", pa.int64()), ("family", pa.int64()), ("m", pa.int64()), ("set", pa.list_(pa.int64()))])
    sets = per.mapInArrow(_sets(width, schema), "node long, family long, m long, set array<bigint>")
    # a family of m blocks: block i meets every block j, so each member goes to m tasks
    tasks = sets.withColumn("i", F.pmod(F.xxhash64("node"), F.col("m"))).select("node", "family", "set", "i",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("j"))
    tasks = tasks.select("node", "family", "set", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return tasks.groupBy("family", "lo", "hi").applyInArrow(_links(percent, out), "a long, b long")
