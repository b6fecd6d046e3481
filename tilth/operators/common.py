"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a single-row aggregate to every row of ``df``.

    The aggregate becomes one scalar subquery (computed once, then a constant in the
    projection): no join, no broadcast of anything larger than one row."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_s")).scalar()
    return df.withColumn("_scalars", packed).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col("_scalars").getField(c).alias(c) for c in cols])
