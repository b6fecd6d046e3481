"""Phrase collocation mining on counts from a HAT-trie.

Counting: a task reads its documents once and inserts every window of four words (shorter
at the end of a piece) into a trie.  The trie is shallow: its levels are a language, a
range of first word ids, and below a first word with very many windows a range of second
word ids; its leaves are hash containers.  A container that grows past ``BURST`` windows
bursts: into two at the middle of its word range, or, once it holds a single first word,
into a node over second words.  When a task's windows pass ``SPILL``, the largest language's
whole subtree is written out and freed.

Spilled runs are sorted by the words themselves and cut by prefix partition, a hash of the
first two words.  All runs of a partition meet in one task, where their word lists are merged
(each run stays sorted under the merged numbering) and the runs are merged into counts; a
window's count adds to all its prefixes, so a partition knows every phrase of two to four
words that begins with its pairs, and its share of the single words.

The number of partitions grows with the text.  Pairs that are frequent in a bounded sample are
cut by three words instead, and their own counts are summed over the partitions; the sample
only spreads the work.

Scoring is DataFrame work on the phrases above the threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import bounded_ids, materialize

MIN_COUNT = 30
TOP = 2000
WORDS = 4
BURST = 1 << 15
SPILL = 500_000             # windows in a task's trie before a subtree is spilled
CHUNK = 1 << 17             # words inserted at a time
PART_BYTES = 12 << 20       # text behind one prefix partition
SAMPLE_DOCS = 2000          # bound on the documents read to find frequent pairs
HOT_PAIRS = 4096            # bound on the pairs cut one word deeper
_BITS = 20                  # of a word id inside a trie
_LOW = (1 << _BITS) - 1
_SALTS = 64

# lower-cases A-Z and maps every mark that ends a piece to a full stop
_FOLD = bytes(0x2E if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

RUN = T.StructType([T.StructField("part", T.LongType()), T.StructField("lang", T.StringType()),
                    *[T.StructField(c, T.BinaryType()) for c in ("words", "heads", "tails", "counts")]])
COUNTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()),
                        T.StructField("len", T.IntegerType()), T.StructField("f", T.LongType())])


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, with ``b'.'`` where a piece ends.  A full stop cannot be part of a
    word, and after the mapping only blanks and tabs are left of what ``split`` separates at."""
    return (text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(b".", b" . ") + b" .").split() if text else []


class _Numbers(dict):
    """Numbers new keys in order of arrival."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class _Node:
    """Children over ranges of the word id at ``depth``; ``starts[i]`` begins child i."""
    __slots__ = ("depth", "starts", "kids")

    def __init__(self, depth: int, kid: dict):
        self.depth, self.starts, self.kids = depth, [0], [kid]


class HatTrie:
    """Counts of the four-word windows of one language.

    A window is held as pair number << 40 | third << 20 | fourth, with word number 0 behind
    the end of a piece."""

    def __init__(self, burst: int = BURST):
        self.words = _Numbers({b".": 0})
        self.pairs = _Numbers()
        self.heads = np.zeros(64, np.int64)      # pair number -> first << 20 | second
        self.root, self.burst, self.size = _Node(0, {}), burst, 0

    def add(self, ids: np.ndarray, n: int | None = None) -> None:
        """Insert the windows that begin at the first ``n`` places (all, if not given)."""
        n = len(ids) if n is None else n
        w = [np.concatenate([ids[i:], np.zeros(i, np.int64)])[:n] for i in range(WORDS)]
        for i in range(2, WORDS):
            w[i][w[i - 1] == 0] = 0
        begins = w[0] > 0
        head = (w[0] << _BITS | w[1])[begins]
        if not n or not len(head):
            return
        heads, of = np.unique(head, return_inverse=True)
        keys, counts = np.unique(of.astype(np.int64) << 2 * _BITS | (w[2] << _BITS | w[3])[begins], return_counts=True)
        number = np.fromiter(map(self.pairs.__getitem__, heads.tolist()), np.int64, len(heads))
        if len(self.pairs) > len(self.heads):
            self.heads = np.concatenate([self.heads, np.zeros(max(len(self.pairs), len(self.heads)), np.int64)])
        self.heads[number] = heads
        place = keys >> 2 * _BITS
        packed = number[place] << 2 * _BITS | keys & (1 << 2 * _BITS) - 1
        self._insert(self.root, (heads[place] >> _BITS, heads[place] & _LOW), packed, counts, 0, len(packed))

    def _insert(self, node: _Node, digits: tuple, keys: np.ndarray, counts: np.ndarray, lo: int, hi: int) -> None:
        cuts = (lo + np.searchsorted(digits[node.depth][lo:hi], node.starts[1:])).tolist()
        bounds = [lo, *cuts, hi]
        for i in range(len(node.kids) - 1, -1, -1):   # from the end: a burst shifts later children only
            a, b = bounds[i], bounds[i + 1]
            if a == b:
                continue
            kid = node.kids[i]
            if isinstance(kid, _Node):
                self._insert(kid, digits, keys, counts, a, b)
                continue
            before, get = len(kid), kid.get
            for k, c in zip(keys[a:b].tolist(), counts[a:b].tolist(), strict=True):
                kid[k] = get(k, 0) + c
            self.size += len(kid) - before
            if len(kid) > self.burst:
                self._burst(node, i)

    def _burst(self, node: _Node, i: int) -> None:
        kid = node.kids[i]
        keys = np.fromiter(kid, np.int64, len(kid))
        head = self.heads[keys >> 2 * _BITS]
        word = head >> _BITS if node.depth == 0 else head & _LOW
        low, high = int(word.min()), int(word.max())
        if low == high:
            if node.depth == 0:
                node.kids[i] = _Node(1, kid)
                self._burst(node.kids[i], 0)
            return                                    # one pair: the container stays as large as it is
        middle = min(max(int(np.median(word)), low + 1), high)
        below, above = {}, {}
        for k, c, x in zip(keys.tolist(), kid.values(), (word >= middle).tolist(), strict=True):
            (above if x else below)[k] = c
        node.kids[i:i + 1] = [below, above]
        node.starts.insert(i + 1, middle)
        for j, part in ((i + 1, above), (i, below)):
            if len(part) > self.burst and len(part) < len(kid):
                self._burst(node, j)

    def _leaves(self, node: _Node):
        for kid in node.kids:
            if isinstance(kid, _Node):
                yield from self._leaves(kid)
            else:
                yield kid

    def runs(self, lang: str, n_parts: int, hot: frozenset):
        """The whole subtree as sorted runs, one for each prefix partition."""
        if not self.size:
            return
        keys = np.concatenate([np.fromiter(d, np.int64, len(d)) for d in self._leaves(self.root)])
        counts = np.concatenate([np.fromiter(d.values(), np.int64, len(d)) for d in self._leaves(self.root)])
        head = self.heads[keys >> 2 * _BITS]
        w = [head >> _BITS, head & _LOW, keys >> _BITS & _LOW, keys & _LOW]
        del keys
        names = list(self.words)
        order = np.array(sorted(range(1, len(names)), key=names.__getitem__), np.int64)
        rank = np.zeros(len(names), np.int64)
        rank[order] = np.arange(1, len(names))
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        code = np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in names), np.uint64, len(names))
        place = code[w[0]] * _MIX[0] + code[w[1]] * _MIX[1]
        numbers = {n: i for i, n in enumerate(names)}
        deep = [numbers[a] << _BITS | numbers[b] for (x, a, b) in hot if x == lang and a in numbers and b in numbers]
        if deep:
            place += np.where(np.isin(head, deep), code[w[2]] * _MIX[2], np.uint64(0))
        place ^= place >> np.uint64(32)
        part = ((place * _MIX[0]) >> np.uint64(16)) % np.uint64(n_parts)
        heads, tails = rank[w[0]] << 32 | rank[w[1]], rank[w[2]] << 32 | rank[w[3]]
        by = np.lexsort((tails, heads, part))
        part, heads, tails, counts = part[by], heads[by], tails[by], counts[by]
        edges = np.append(np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1))), len(part)).tolist()
        ordered = [b"", *[names[i] for i in order]]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(part[a]), lang, *_pack_run(ordered, heads[a:b], tails[a:b], counts[a:b])


def _planes(x: np.ndarray) -> bytes:
    """An array's bytes by significance, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unplanes(raw: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def _pack_run(ordered: list[bytes], heads, tails, counts) -> tuple[bytes, bytes, bytes, bytes]:
    """A run with only the words it uses, renumbered in order (0 stays the end)."""
    digits = [heads >> 32, heads & 0xFFFFFFFF, tails >> 32, tails & 0xFFFFFFFF]
    if 8 * len(heads) < len(ordered):
        used = np.unique(np.concatenate([*digits, [0]]))
        digits = [np.searchsorted(used, d) for d in digits]
    else:
        seen = np.zeros(len(ordered), bool)
        for d in (*digits, 0):
            seen[d] = True
        used, new = np.flatnonzero(seen), np.cumsum(seen) - 1
        digits = [new[d] for d in digits]
    heads, tails = digits[0] << 32 | digits[1], digits[2] << 32 | digits[3]
    words = zstandard.ZstdCompressor(level=1).compress(b" ".join(ordered[i] for i in used[1:].tolist()))
    return words, _planes(np.diff(heads, prepend=0)), _planes(tails), _planes(counts)


def _spill(shipped, schema: pa.Schema):
    def run(batches):
        n_parts, hot = shipped.value
        tries: dict[str, HatTrie] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        lengths: dict[str, int] = {}

        def batch_of(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        def insert(lang):
            tries[lang].add(np.concatenate(waiting.pop(lang)))
            del lengths[lang]

        def flush(lang):
            if lang in waiting:
                insert(lang)
            rows = []
            for row in tries.pop(lang).runs(lang, n_parts, hot):
                rows.append(row)
                if sum(len(x) for r in rows for x in r[2:]) > 1 << 23:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                ws = tokens(text.as_py())
                for at in range(0, len(ws), CHUNK):
                    if lang not in tries:
                        tries[lang] = HatTrie()
                    trie = tries[lang]
                    part = ws[at:at + CHUNK + WORDS - 1]     # windows may reach past the chunk
                    ids = np.fromiter(map(trie.words.__getitem__, part), np.int64, len(part))
                    if at + CHUNK < len(ws):
                        trie.add(ids, CHUNK)
                    else:
                        waiting.setdefault(lang, []).append(ids)
                        lengths[lang] = lengths.get(lang, 0) + len(ids)
                        if sum(lengths.values()) >= 2 * CHUNK:
                            insert(max(lengths, key=lengths.get))
                    if len(trie.words) + CHUNK + WORDS > _LOW:       # no numbers left for another chunk
                        yield from flush(lang)
                    elif sum(t.size for t in tries.values()) >= SPILL:
                        yield from flush(max(tries, key=lambda x: tries[x].size))
        for lang in list(tries):
            yield from flush(lang)
    return run


def _phrase_rows(lang: str, phrase: pa.Array, size: int, f: np.ndarray, schema: pa.Schema) -> pa.Table:
    n = len(phrase)
    columns = [pa.repeat(pa.scalar(lang, pa.string()), n), phrase, pa.repeat(pa.scalar(size, pa.int32()), n), pa.array(f, pa.int64())]
    return pa.Table.from_arrays(columns, schema=schema)


def _merge(min_count: int, hot_pairs, schema: pa.Schema):
    """All runs of a prefix partition to the counts of its phrases.

    Single words and frequent pairs come as shares (summed later), the row of length 0 has
    the number of word occurrences; other phrases come if they reach ``min_count``."""
    def run(table: pa.Table) -> pa.Table:
        hot = hot_pairs.value
        out: list[pa.Table] = []
        langs = table.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            rows = table.take([i for i, x in enumerate(langs) if x == lang]).to_pylist()
            lists = [zstandard.ZstdDecompressor().decompress(r["words"]).split(b" ") for r in rows]
            names = [b"", *sorted(set().union(*lists))]
            number = {x: i for i, x in enumerate(names)}
            heads, tails, counts = [], [], []
            for r, words in zip(rows, lists, strict=True):
                new = np.array([0, *map(number.__getitem__, words)], np.int64)
                h, t = np.cumsum(_unplanes(r["heads"], np.int64)), _unplanes(r["tails"], np.int64)
                heads.append(new[h >> 32] << 32 | new[h & 0xFFFFFFFF])
                tails.append(new[t >> 32] << 32 | new[t & 0xFFFFFFFF])
                counts.append(_unplanes(r["counts"], np.int64))
            head, tail, count = np.concatenate(heads), np.concatenate(tails), np.concatenate(counts)
            del heads, tails, counts, rows
            key = np.unique(head, return_inverse=True)[1].astype(np.int64) << 32
            key |= np.unique(tail, return_inverse=True)[1].astype(np.int64)
            by = np.argsort(key, kind="stable")       # merges runs that are sorted already
            del key
            head, tail, count = head[by], tail[by], count[by]
            out.append(_phrase_rows(lang, pa.array([""]), 0, count.sum(keepdims=True), schema))
            spelled = pa.array(names, pa.binary())
            w = [head >> 32, head & 0xFFFFFFFF, tail >> 32, tail & 0xFFFFFFFF]
            new_prefix = np.zeros(len(head), bool)
            new_prefix[:1] = True
            deep = {number[a] << 32 | number[b] for (x, a, b) in hot if x == lang and a in number and b in number}
            for size in range(1, WORDS + 1):
                d = w[size - 1]
                new_prefix[1:] |= d[1:] != d[:-1]
                at = np.flatnonzero(new_prefix)
                total = np.add.reduceat(count, at)
                there = w[size - 1][at] > 0
                if size == 1:
                    keep = there
                else:
                    keep = there & (total >= min_count)
                    if size == 2 and deep:
                        keep |= there & np.isin(head[at], list(deep))
                at, total = at[keep], total[keep]
                # joined as Arrow arrays, not phrase by phrase
                parts = [spelled.take(pa.array(x[at])) for x in w[:size]]
                phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                out.append(_phrase_rows(lang, phrase.cast(pa.string()), size, total, schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def frequent_pairs(docs: DataFrame, n_parts: int) -> frozenset:
    """At most ``HOT_PAIRS`` (lang, first, second) of which a bounded sample suggests that they
    hold more than an eighth of a partition's windows."""
    def run(batches):
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                ws = tokens(text.as_py())
                pairs: dict[tuple, int] = {}
                for p in zip(ws, ws[1:], strict=False):
                    if b"." not in p:
                        pairs[p] = pairs.get(p, 0) + 1
                rows += [(lang, a, b, n) for (a, b), n in pairs.items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["lang", "a", "b", "n"])
    ids = bounded_ids(docs.select("doc_id"), SAMPLE_DOCS).distinct()
    sample = docs.join(F.broadcast(ids), "doc_id").select("lang", "text")
    found = materialize(sample.mapInArrow(run, "lang string, a binary, b binary, n long").groupBy("lang", "a", "b").agg(
        F.sum("n").alias("n")))
    total = found.agg(F.sum("n")).first()[0] or 0
    most = found.where(F.col("n") > max(20, total / (8 * n_parts))).orderBy(F.desc("n"), "lang", "a", "b").limit(HOT_PAIRS)
    return frozenset((r["lang"], bytes(r["a"]), bytes(r["b"])) for r in most.collect())


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, len, f): phrases of one to four words found ``min_count`` times or more
    in a language; with length 0 the number of its word occurrences."""
    own = docs.select("doc_id", F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.col(text_col).alias("text"))
    sc = docs.sparkSession.sparkContext
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, math.ceil(size / PART_BYTES))
    hot = frequent_pairs(own, n_parts) if n_parts > 1 else frozenset()
    runs = own.select("lang", "text").mapInArrow(_spill(sc.broadcast((n_parts, hot)), to_arrow_schema(RUN)), RUN)
    counted = runs.groupBy("part").applyInArrow(_merge(min_count, sc.broadcast(hot), to_arrow_schema(COUNTED)), COUNTED)
    return counted.groupBy("lang", "phrase", "len").agg(F.sum("f").alias("f")).where(
        (F.col("len") == 0) | (F.col("f") >= min_count))


def _words(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("__w", first, n), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, ``rank`` (long, from 1), phrase, a, l, r, n,
    score, by score, then a (both falling), then phrase in byte order.

    Texts lose the case of A-Z and are cut into pieces at ``. , ; : ! ?`` and line ends, pieces
    into words at blanks and tabs.  A candidate has two to four words and a = f(phrase) of at
    least ``min_count``; each cut into a first part with l and a rest with r occurrences gives
    floor(2000000 a / (l + r)), the least one counts (ties: the earliest cut).  Candidates
    inside a longer candidate with at least 80 % of their count are left out.

    Defined results: null and empty texts have no words; a null lang is ``und``; repeated
    rows each count; a table without frequent phrases, or an empty one, gives no rows; other
    columns are ignored."""
    known = materialize(phrase_counts(docs, min_count, text_col, lang_col))
    phrases = known.where("len >= 2").withColumn("__w", F.split("phrase", " "))
    cuts = phrases.select("lang", "phrase", "f", "len", "__w",
                          F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k")).select(
        "lang", "phrase", "f", "k", _words(F.lit(1), F.col("k")).alias("first"),
        _words(F.col("k") + 1, F.col("len") - F.col("k")).alias("rest"))
    part = known.where("len between 1 and 3").select("lang", "phrase", "f")
    left = part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # whole decimals: 2000000 * a may pass 64 bits
    exact = F.expr("cast((cast(2000000 as decimal(7,0)) * cast(f as decimal(19,0))) div "
                   "(cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    scored = both.withColumn("score", exact).groupBy("lang", "phrase").agg(
        F.min("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # the most frequent longer candidate around each phrase
    inner = phrases.where("len >= 3").select("lang", "f", "len", "__w", F.explode(
        F.sequence(F.lit(2), F.col("len") - 1)).alias("z")).select(
        "lang", "f", "__w", "z", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("z") + 1)).alias("i"))
    around = inner.select("lang", _words(F.col("i"), F.col("z")).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    big = "decimal(25,0)"
    swallowed = F.col("longer").cast(big) * 100 >= F.col("a").cast(big) * 80
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~swallowed).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    near = salted.withColumn("__at", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).where(
        F.col("__at") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top)
    n = known.where("len = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
