"""Registry of named queries: each key has a Spark callable and, where SQL can
express it, the equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def rnd(c: str | Column, d: int = 6) -> Column:
    """Round to d places, half away from zero, by scaling (as SQL's round does); adding 0.0
    turns -0.0 into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    p = float(10 ** d)
    return F.round(col.cast("double") * p, 0) / p + F.lit(0.0)


def rounded(df: DataFrame, cols: dict[str, int]) -> DataFrame:
    return df.select(*[rnd(c, cols[c]).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def load_all() -> None:
    # importing the modules registers their keys
    from tilth.plans import (q_clean, q_encode, q_htest, q_model, q_monitor,  # noqa: F401
                             q_committed, q_profile, q_registry, q_reports, q_sources,
                             q_history, q_tuning)
