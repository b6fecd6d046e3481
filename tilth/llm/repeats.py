"""Repeated byte strings by longest-previous-factor arrays.

A string of ``length`` bytes repeats if it starts at two places, in one document or in
several.  Over the corpus this is decided in three steps.

1. *Classes.*  Every start of a ``length``-byte window gets a key: the least hash among the
   window's ``gram``-byte substrings.  Equal windows have equal keys, so only starts of one
   key need to be compared.  Neighbouring starts mostly share their key; a document becomes
   a few *runs* of starts (one for about (length - gram) / 2 bytes).  Keys found in one run
   only drop out; that is nearly all of a text without repeats.  In a run whose key stands
   twice (a stretch of one byte, a line over and over) equal windows are found at once, and
   only the first of each goes on.
2. *Contents.*  Runs with the same bytes (start to last window's end) are one content: all
   windows of a content that occurs twice repeat, and only one occurrence of each content,
   the first by (doc_id, place), goes on.
3. *Longest previous factors.*  The contents of some classes meet in one bounded block.  There
   the suffixes are sorted by their first ``length`` bytes (more is not asked), and for each one
   the previous and next *smaller* positions in suffix order give the longest match that
   starts earlier in the text; the same with *greater* positions gives the longest match
   that starts later.

A class whose contents do not fit a block (a passage between very many different
surroundings) is divided again by the same rule with longer substrings, at last with the
windows themselves, where a class has one content.  So no block grows with the data, and
what is shuffled of a copied passage is hashes, not its text.
"""

from __future__ import annotations

import hashlib
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import materialize

LENGTH = 400
GRAMS = (0.32, 0.95, 1.0)      # substring lengths of the classes, as shares of the window
BLOCK_STARTS = 1 << 17         # suffixes sorted together
_CHUNK = 1 << 20               # starts of one text treated at a time
_LONGEST_RUN = 1 << 12

_BYTE = np.random.default_rng(31).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        _powers[base] = np.cumprod(np.full(max(n, 1 << 17), base, np.uint64))
    return _powers[base][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram``-byte substring, from one running sum."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n), out=total[1:])
    h = (total[gram:] - total[:-gram]) * _power(_BACK, n)[:n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours (minima from both ends of blocks of that width)."""
    if width == 1:
        return x
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _tied(h: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> np.ndarray:
    """Whether the key of a run stands at more than one place of its windows."""
    out, ahead = np.empty(len(key), bool), np.arange(width)
    for i in range(0, len(key), 2048):
        k, a, b = key[i:i + 2048, None], lo[i:i + 2048], hi[i:i + 2048] + width - 1
        first = a + (h[a[:, None] + ahead] == k).argmax(axis=1)
        out[i:i + 2048] = first != b - (h[b[:, None] - ahead] == k).argmax(axis=1)
    return out


def runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, last start, tied) of the runs of window starts with one key.

    Windows of a run whose key stands at one place only all differ: they hold that place at
    different distances.  In a ``tied`` run (a stretch of one byte, a short period) equal
    windows are possible."""
    keys, first, last, tied = [], [], [], []
    n = len(data) - length + 1
    for at in range(0, max(n, 0), _CHUNK):
        here = min(_CHUNK, n - at)
        h = gram_hashes(data[at:at + here + length - 1], gram)
        key = sliding_least(h, length - gram + 1)
        cut = np.ones(here, bool)
        cut[1:] = key[1:] != key[:-1]
        lo = np.flatnonzero(cut)
        if here > _LONGEST_RUN and (np.diff(lo, append=here) > _LONGEST_RUN).any():
            lo = np.union1d(lo, np.arange(0, here, _LONGEST_RUN))
        hi = np.append(lo[1:], here) - 1
        tied.append(_tied(h, key[lo], lo, hi, length - gram + 1))
        keys.append(key[lo].view(np.int64))
        first.append(lo + at)
        last.append(hi + at)
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(keys), np.concatenate(first), np.concatenate(last), np.concatenate(tied)


def first_starts(raw: bytes, lo: int, hi: int, length: int) -> np.ndarray:
    """For each window of a run the place in the run of the first window equal to it."""
    first: dict[bytes, int] = {}
    return np.array([first.setdefault(raw[p:p + length], p - lo) for p in range(lo, hi + 1)], np.int64)


# ---- inside a block: suffix order and longest previous factors ---------------------

def suffix_order(text: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` sorted by their first ``length`` bytes (places in ``starts``; equal
    ones by position), and the number of their class of equal prefixes, in that order."""
    heads = [text[p:p + length] for p in starts.tolist()]
    order = sorted(range(len(heads)), key=heads.__getitem__)
    new = np.fromiter(map(ne, map(heads.__getitem__, order[1:]), map(heads.__getitem__, order[:-1])), bool, max(0, len(order) - 1))
    return np.array(order, np.int64), np.concatenate([[0], np.cumsum(new)])[:len(order)]


def _nearest_smaller(place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each element in suffix order the nearest one before it in its group with a smaller
    position (-1: none), by pointer jumping."""
    n = len(place)
    at = np.arange(-1, n - 1)
    at[np.flatnonzero(np.diff(group, prepend=-1))] = -1
    while True:
        bad = np.flatnonzero(at >= 0)
        bad = bad[place[at[bad]] > place[bad]]
        if not len(bad):
            return at
        at[bad] = at[at[bad]]


def _has_smaller(place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether the previous or the next smaller position in suffix order shares the prefix."""
    before = _nearest_smaller(place, group)
    after = _nearest_smaller(place[::-1], group[::-1].max(initial=0) - group[::-1])[::-1]
    return (before >= 0) | (after >= 0)


def factors(text: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous factor, longest next factor) at the given starts (ascending): the
    longest match with an earlier, with a later one of them, counted up to ``length``;
    shorter matches count as 0.  The longest match of a suffix with an earlier one is the one
    with its previous or its next smaller position in suffix order."""
    order, group = suffix_order(text, starts, length)
    live = np.bincount(group, minlength=1)[group] > 1  # a neighbour in suffix order shares the prefix
    order, group = order[live], group[live]
    previous, following = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    previous[order] = length * _has_smaller(order, group)
    following[order] = length * _has_smaller(-order, group)
    return previous, following


def _spans(flags: np.ndarray, at: int = 0) -> list[dict]:
    """Stretches of set flags as [from, to] places, counted from ``at``."""
    edges = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return [{"a": a, "b": b} for a, b in zip((np.flatnonzero(edges > 0) + at).tolist(), (np.flatnonzero(edges < 0) - 1 + at).tolist(), strict=True)]


def _block(length: int, schema: pa.Schema):
    """The contents of a block, in order of place, to their windows that repeat in it."""
    def run(table: pa.Table) -> pa.Table:
        # rows that repeat id and text bring a content twice
        once = {(r["key"], r["content"]): r for r in sorted(table.to_pylist(), key=lambda r: -r["place"])}
        rows = sorted(((r["place"], *k, r["data"]) for k, r in once.items()), key=lambda r: r[0])
        sizes = np.array([len(r[3]) for r in rows], np.int64)
        offset = np.concatenate([[0], np.cumsum(sizes)])
        text = b"".join(r[3] for r in rows)
        starts = np.concatenate([np.arange(o, o + s - length + 1) for o, s in zip(offset.tolist(), sizes.tolist(), strict=False)])
        previous, following = factors(text, starts, length)
        bounds = np.concatenate([[0], np.cumsum(sizes - length + 1)])
        out = []
        for i, r in enumerate(rows):
            lo, hi = bounds[i], bounds[i + 1]
            out.append((r[1], r[2], _spans(previous[lo:hi] >= length), _spans(following[lo:hi] >= length)))
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return run


# ---- over the corpus ------------------------------------------------------------------

_SPAN = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
_FOUND = T.StructType([T.StructField("key", T.LongType()), T.StructField("content", T.LongType()),
                       T.StructField("earlier", _SPAN), T.StructField("later", _SPAN)])


def _scan(length: int, gram: int, schema: pa.Schema):
    """Rows (rid, ord, data) to their runs, what is known of the whole text, and the window starts
    with an earlier, with any match in their own run.  Of windows that are equal in a run
    the first stands for all: the others have their matches, and are left out of the run."""
    def run(batches):
        for batch in batches:
            out = {"n_bytes": [], "sha": [], "runs": [], "earlier": [], "any": []}
            for value in batch.column("data"):
                raw = value.as_py() or b""
                data = np.frombuffer(raw, np.uint8)
                key, lo, hi, tied = runs(data, length, gram)
                out["n_bytes"].append(len(raw))
                out["sha"].append(hashlib.sha256(raw).hexdigest())
                pieces, earlier, both = [], [], []
                for k, a, b, t in zip(key.tolist(), lo.tolist(), hi.tolist(), tied.tolist(), strict=True):
                    if not t:
                        pieces.append((k, a, b))
                        continue
                    first = first_starts(raw, a, b, length)
                    again = first != np.arange(len(first))
                    pieces += [(k, s["a"], s["b"]) for s in _spans(~again, a)]
                    earlier += _spans(again, a)
                    again[first[again]] = True
                    both += _spans(again, a)
                out["runs"].append([{"key": k, "content": xxhash.xxh3_64_intdigest(raw[a:b + length]) - (1 << 63), "lo": a, "hi": b}
                                    for k, a, b in pieces])
                out["earlier"].append(earlier)
                out["any"].append(both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("ord"), *[pa.array(out[c], schema.field(c).type) for c in out]], schema=schema)
    return run


def _slice(length: int, schema: pa.Schema):
    """Texts with the contents asked of them to the contents' bytes."""
    def run(batches):
        for batch in batches:
            rows = []
            for value, asked in zip(batch.column("data"), batch.column("asked").to_pylist(), strict=True):
                raw = value.as_py() or b""
                rows += [(r["key"], r["content"], raw[r["lo"]:r["hi"] + length], r["starts"], r["first"]) for r in asked]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    return run


def _scanned(rows: DataFrame, length: int, gram: int) -> DataFrame:
    schema = T.StructType([
        T.StructField("rid", T.BinaryType()), rows.schema["ord"], T.StructField("n_bytes", T.LongType()),
        T.StructField("sha", T.StringType()),
        T.StructField("runs", T.ArrayType(T.StructType([
            T.StructField(c, T.LongType()) for c in ("key", "content", "lo", "hi")]))),
        T.StructField("earlier", _SPAN), T.StructField("any", _SPAN)])
    return materialize(rows.select("rid", "ord", "data").mapInArrow(_scan(length, gram, to_arrow_schema(schema)), schema))


def _repeats(rows: DataFrame, scanned: DataFrame, length: int, grams: list[int]) -> DataFrame:
    """(rid, spans of window starts with an earlier match, with any match) of the rows with
    repeats; ``grams`` are the substring lengths of this level and those below."""
    each = scanned.select("rid", "ord", F.explode("runs").alias("r")).select("rid", "ord", "r.*")
    # stored, so that the join deals both sides anew and a very common key can be split
    common = materialize(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    live = materialize(each.join(common, "key"))
    first = F.struct("ord", "rid", "lo")
    contents = live.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(first).alias("first"), F.max(F.col("hi") - F.col("lo") + 1).alias("size"))
    contents = materialize(contents.select("key", "content", "n", "first", "size", (F.col("first.lo") + F.col("size") - 1).alias("hi")))
    classes = materialize(contents.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("starts")).where("m > 1"))
    last_level = len(grams) == 1
    wanted = contents.join(classes.select("key", "starts"), "key").select(
        F.col("first.rid").alias("rid"), "key", "content", F.col("first.lo").alias("lo"), "hi", "first", "starts")
    asked = wanted.groupBy("rid").agg(F.collect_list(F.struct("key", "content", "lo", "hi", "starts", "first")).alias("asked"))
    sliced = T.StructType([T.StructField("key", T.LongType()), T.StructField("content", T.LongType()), T.StructField("data", T.BinaryType()),
                           T.StructField("starts", T.LongType()), T.StructField("ord", contents.schema["first"].dataType)])
    # stored: both the blocks and the classes to divide read it, and the texts are shuffled once
    placed = materialize(rows.select("rid", "data").join(asked, "rid").mapInArrow(_slice(length, to_arrow_schema(sliced)), sliced))
    small = placed if last_level else placed.where(F.col("starts") <= BLOCK_STARTS)
    total = classes.where(F.col("starts") <= BLOCK_STARTS).agg(F.sum("starts")).first()[0] or 0
    block = F.pmod(F.xxhash64("key"), F.lit(max(1, 2 * total // BLOCK_STARTS)))
    placed_small = small.withColumn("block", block).withColumn(
        "place", F.row_number().over(Window.partitionBy("block").orderBy("ord")))
    found = placed_small.select("block", "place", "key", "content", "data").groupBy("block").applyInArrow(
        _block(length, to_arrow_schema(_FOUND)), _FOUND)
    if not last_level and classes.where(F.col("starts") > BLOCK_STARTS).limit(1).count():
        found = found.union(_divided(placed.where(F.col("starts") > BLOCK_STARTS), length, grams[1:]))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("hi") - F.col("lo")).alias("b")))
    none = F.array().cast(_SPAN)
    known = materialize(contents.select("key", "content", "n", "first").join(found, ["key", "content"], "left").where(
        (F.col("n") > 1) | (F.size("earlier") > 0) | (F.size("later") > 0)))
    mine = F.col("ord").eqNullSafe(F.col("first.ord")) & (F.col("rid") == F.col("first.rid")) & (F.col("lo") == F.col("first.lo"))
    own = live.join(known, ["key", "content"])

    def moved(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["a"] + F.col("lo")).alias("a"), (s["b"] + F.col("lo")).alias("b")))

    per_run = own.select(
        "rid",
        moved(F.when(~mine, whole).otherwise(F.coalesce("earlier", none))).alias("earlier"),
        moved(F.when(F.col("n") > 1, whole).otherwise(F.concat(F.coalesce("earlier", none), F.coalesce("later", none)))).alias("any"))
    inside = scanned.where(F.size("any") > 0).select("rid", "earlier", "any")
    # neighbouring starts are joined: spans found window by window would go with every copy one by one
    return per_run.union(inside).groupBy("rid").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("earlier", "any")]).select(
        "rid", *[F.transform(_merged(F.col(c), 1), lambda s: F.struct(s["start"].alias("a"), (s["end"] - 1).alias("b"))).alias(c)
                 for c in ("earlier", "any")])


def _divided(contents: DataFrame, length: int, grams: list[int]) -> DataFrame:
    """The contents of classes too large for a block, as rows of the next level; back come their
    windows that another content has."""
    rid = F.unhex(F.concat(F.lpad(F.hex("key"), 16, "0"), F.lpad(F.hex("content"), 16, "0")))
    rows = materialize(contents.select(rid.alias("rid"), "ord", "data", "key", "content").dropDuplicates(["rid"]))
    spans = _repeats(rows, _scanned(rows, length, grams[0]), length, grams)
    return rows.select("rid", "key", "content").join(spans, "rid").select(
        "key", "content", "earlier", F.col("any").alias("later"))


def _merged(spans: Column, length: int) -> Column:
    """Spans of window starts as sorted, disjoint spans of bytes [start, end)."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        end = s["b"] + length
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))))
        fresh = F.concat(acc, F.array(F.struct(s["a"].alias("start"), end.alias("end"))))
        return F.when((F.size(acc) > 0) & (last["end"] >= s["a"]), grown).otherwise(fresh).cast(kind)

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), step)


def _identified(docs: DataFrame, text_col: str) -> DataFrame:
    """(rid, ord, data, doc_id): ``rid`` tells rows by id and text, ``ord`` orders them by id."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(_rid_of(text_col).alias("rid"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")).alias("ord"),
                       data.alias("data"), "doc_id")


def find_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``n_bytes``, ``sha`` (hex digest of its text), ``spans``
    array<struct<start, end>> of bytes, sorted and disjoint, and ``__rid``, which tells rows
    by id and text.

    The spans are the bytes inside ``length``-byte strings that also start elsewhere; with
    ``keep_first`` inside those that start earlier (by doc_id, then place), so that the first
    copy of a passage has none.

    Defined results: a null text is empty; a text below ``length`` bytes has no spans;
    rows that repeat a text are copies of each other, also under one doc_id (rows equal in
    both are treated alike, so with ``keep_first`` they count as one place); rows without
    doc_id stand behind all others; an empty table gives an empty table; other columns are
    ignored."""
    if length < 8:
        raise ValueError("a repeated string has at least 8 bytes here")
    grams = sorted({max(1, min(length, round(length * g))) for g in GRAMS})
    rows = _identified(docs, text_col)
    scanned = _scanned(rows, length, grams[0])
    spans = _repeats(rows, scanned, length, grams)
    chosen = spans.select("rid", _merged(F.col("earlier" if keep_first else "any"), length).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return scanned.join(chosen, "rid", "left").select(
        F.col("ord.id").alias("doc_id"), "n_bytes", "sha", F.coalesce("spans", none).alias("spans"), F.col("rid").alias("__rid"))


def _cut(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            kept = []
            for value, spans in zip(batch.column("data"), batch.column("spans").to_pylist(), strict=True):
                raw, at, parts = value.as_py() or b"", 0, []
                for s in spans:
                    parts.append(raw[at:s["start"]])
                    at = s["end"]
                kept.append(b"".join([*parts, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(kept, pa.binary())], schema=schema)
    return run


def kept_bytes(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(__rid, kept) of the documents with spans: what is left of their bytes.  A cut may fall
    inside a character, so the result is binary.  Documents removed whole need no text and are
    left out; rows equal in id and text come out once each."""
    part = found.where((F.size("spans") > 0) & ~_all_gone()).select(
        F.col("__rid").alias("rid"), "spans").dropDuplicates(["rid"])
    schema = T.StructType([T.StructField("rid", T.BinaryType()), T.StructField("kept", T.BinaryType())])
    cut = _identified(docs, text_col).select("rid", "data").join(part, "rid").mapInArrow(_cut(to_arrow_schema(schema)), schema)
    return cut.select(F.col("rid").alias("__rid"), "kept")


def _all_gone() -> Column:
    whole = F.element_at("spans", 1)
    return (F.size("spans") == 1) & (whole["start"] == 0) & (whole["end"] == F.col("n_bytes"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = True, text_col: str = "text") -> DataFrame:
    """The documents with what is left of their texts, as ``kept`` (binary) beside their own
    columns (an own column of that name is replaced)."""
    found = materialize(find_repeats(docs, length, keep_first, text_col))
    cut = kept_bytes(docs, found, text_col)
    gone = found.where(_all_gone()).select("__rid", F.lit(b"").alias("kept")).dropDuplicates(["__rid"])
    own = docs.drop("kept", "__rid")
    marked = own.withColumn("__rid", _rid_of(text_col))
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return marked.join(cut.union(gone).dropDuplicates(["__rid"]), "__rid", "left").select(*own.columns, F.coalesce("kept", data).alias("kept"))


def _rid_of(text_col: str) -> Column:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    named = F.when(F.col("doc_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("doc_id").cast("string")))
    return F.unhex(F.md5(F.concat(named.cast("binary"), F.lit("\0").cast("binary"), data)))


def digest(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """doc_id, ``n_bytes``, ``n_removed``, ``n_spans`` (long), ``kept_sha256`` of every document
    when all bytes of repeated strings are removed, the first copies included."""
    found = materialize(find_repeats(docs, length, False, text_col))
    cut = kept_bytes(docs, found, text_col).select("__rid", F.sha2("kept", 256).alias("__sha")).distinct()
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    sha = F.when(F.size("spans") == 0, F.col("sha")).when(_all_gone(), F.sha2(F.lit(b""), 256)).otherwise(F.col("__sha"))
    return found.join(cut, "__rid", "left").select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        sha.alias("kept_sha256"))
