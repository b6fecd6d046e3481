"""Secret scans: known forms by pattern, random strings by token efficiency.

A vocabulary learnt from text spends few tokens on words and many on random strings.  A
run of key characters with fewer than ``MAX_RATIO`` characters a token is taken for a
secret, unless it is a digest of a usual length, a UUID, a number or an identifier made
of words, which its letters must bear out: they are as token-efficient without the marks
and numbers, or the run is no identifier.  Where the words of a path or name lift a run over the ratio, the parts between
its marks are tested, so that the words cannot hide a key beside them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import cached_property
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.llm.common import sha256_hex
from tilth.llm.tokens import VOCABULARY, encoding, ship_vocabulary

KINDS = ("assign", "access", "hex", "random")
MAX_RATIO = 2.0

# The forms of the contract, and their least lengths.  The assign form is
# read on the text with A-Z lower-cased, so its letters match in either case.
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")
_ASSIGN_CHARS, _ACCESS_CHARS = 12, 18

_CHARS = 20
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % _CHARS)
_UUID = re.compile(rb"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
_HEX_ONLY = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
_DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
_WORDS_ONLY = re.compile(rb"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_/+=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[_/+=-]*")

_PART = re.compile(rb"(?<![A-Za-z0-9])(?:%b)(?![A-Za-z0-9])|[A-Za-z0-9]+" % _UUID.pattern)
_LETTERS = re.compile(rb"[A-Za-z]{2,}")
_MARKS, _OWN_MARKS = b"+/_=-", 2      # marks at an end of a key that are taken as its own, at most


def _is_fixed(run: bytes) -> bool:
    """Digests of usual lengths and UUIDs."""
    return bool((len(run) in _DIGEST_CHARS and _HEX_ONLY.fullmatch(run)) or _UUID.fullmatch(run))


def _between(starts: list[int], a: int, b: int) -> int:
    return bisect_left(starts, b) - bisect_left(starts, a)


class _Run:
    """A run and the places of its tokens.  No token holds both marks and letters or
    digits, so the tokens of a part are counted, not made anew."""

    def __init__(self, run: bytes, enc):
        self.run, self.enc = run, enc
        self.starts = self._starts(run)

    def _starts(self, run: bytes) -> list[int]:
        return [0, *accumulate(len(self.enc.decode_single_token_bytes(t)) for t in self.enc.encode_ordinary(run.decode()))]

    @cached_property
    def lower_starts(self) -> list[int]:
        return self._starts(self.run.lower())

    def is_random(self, a: int, b: int, max_ratio: float) -> bool:
        """Few characters a token, and no digest, UUID, number or words joined by marks.
        Words must be token-efficient too, as they stand or in small letters (vocabularies
        hold few words in capitals); single letters and numbers beside them say nothing."""
        if b - a >= max_ratio * _between(self.starts, a, b):
            return False
        part = self.run[a:b]
        if _is_fixed(part) or part.isdigit():
            return False
        if not _WORDS_ONLY.fullmatch(part.lstrip(_MARKS)):
            return True
        found = [m.span() for m in _LETTERS.finditer(self.run, a, b)]
        n = sum(y - x for x, y in found)
        return all(n < max_ratio * sum(_between(at, x, y) for x, y in found) for at in (self.starts, self.lower_starts))


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in bytes of the three known forms, leftmost, not
    overlapping within a kind; matches below the least length use up their text."""
    found: list[tuple[int, int, int]] = []
    low = raw.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(low) if len(m[2]) >= _ASSIGN_CHARS]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(raw) if len(m[0]) >= _ACCESS_CHARS]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(raw)]
    return found


def _random_parts(held: _Run, max_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the random parts of a run that is not random as a whole.

    Marks cut a run into parts; of several marks in a row one cuts and the others go with
    the parts.  Each part is tested with as many of the next ones, and with as many of the
    ones before, as make ``_CHARS``: every part of a key that has marks of its own is in a
    window without the words beside the key.  No window reaches over a UUID or a digest.
    Windows that overlap are one span."""
    run = held.run
    parts = [m.span() for m in _PART.finditer(run)]
    gaps = [b - a for a, b in zip([0, *(b for _, b in parts)], [*(a for a, _ in parts), len(run)])]
    # the marks before the first part and after the last cut nothing
    own = [min(_OWN_MARKS, max(0, g - (0 < i < len(parts)))) for i, g in enumerate(gaps)]
    lows = [a - own[i] for i, (a, _) in enumerate(parts)]
    highs = [b + own[i + 1] for i, (_, b) in enumerate(parts)]
    fixed = [0, *accumulate(_is_fixed(run[a:b]) for a, b in parts)]
    pairs = {(i, bisect_left(highs, a + _CHARS)) for i, a in enumerate(lows)}
    pairs |= {(bisect_right(lows, b - _CHARS) - 1, j) for j, b in enumerate(highs)}
    windows = [(lows[i], highs[j]) for i, j in pairs if 0 <= i and j < len(parts) and fixed[i] == fixed[j + 1]]
    windows = [x for x in windows if held.is_random(*x, max_ratio)]
    found: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if found and a < found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def random_spans(raw: bytes, enc, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    found = []
    for m in _RUN.finditer(raw):
        if _is_fixed(m[0]) or m[0].isdigit():
            continue
        held = _Run(m[0], enc)
        parts = [(0, len(m[0]))] if held.is_random(0, len(m[0]), max_ratio) else _random_parts(held, max_ratio)
        found += [(m.start() + a, m.start() + b, 3) for a, b in parts]
    return found


def _find(shipped, max_ratio: float, schema: pa.Schema):
    def run(batches):
        enc = encoding(shipped)
        for batch in batches:
            out = []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                raw = text.encode("utf-8", "surrogatepass")
                found = sorted(base_spans(raw) + random_spans(raw, enc, max_ratio), key=lambda s: (s[0], s[2]))
                if len(raw) != len(text):   # bytes to code points, in one walk over the text
                    marks = sorted({x for a, b, _ in found for x in (a, b)})
                    at, last, n = {}, 0, 0
                    for x in marks:
                        n += len(raw[last:x].decode("utf-8", "surrogatepass"))
                        at[x], last = n, x
                    found = [(at[a], at[b], k) for a, b, k in found]
                out.append([{"kind": KINDS[k], "first": a, "end": b} for a, b, k in found])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, schema.field("spans").type)], schema=schema)
    return run


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO,
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``spans`` array<struct<kind, first, end>> in code
    points, end exclusive, by start and then kind (assign, access, hex, random).

    Defined results: null and empty texts have no spans; repeated rows give equal rows; an
    empty table gives an empty table; other columns are ignored."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("first", T.LongType()),
                         T.StructField("end", T.LongType())])
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                        T.StructField("spans", T.ArrayType(span))])
    shipped = ship_vocabulary(docs.sparkSession, vocabulary)
    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(
        _find(shipped, max_ratio, to_arrow_schema(out)), out)


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the contract."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts, sha256_hex(span_list(base)).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
