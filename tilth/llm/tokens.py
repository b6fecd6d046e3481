"""A byte-pair vocabulary file turned into a tiktoken encoding inside Python tasks."""

from __future__ import annotations

import base64
import os

import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_BYTES = 32 << 20

_loaded: dict[int, tiktoken.Encoding] = {}


def ship_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> Broadcast:
    """Read the file on the driver and broadcast its bytes (refused above ``MAX_BYTES``), so
    executors need no copy of their own."""
    size = os.path.getsize(path)
    if size > MAX_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary of at most {MAX_BYTES} is broadcast")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoding(shipped: Broadcast, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The encoding of a shipped vocabulary, built once in each Python worker."""
    raw = shipped.value
    key = hash((raw, pattern))
    if key not in _loaded:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines())}
        _loaded[key] = tiktoken.Encoding("shipped", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]
