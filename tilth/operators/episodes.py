"""Drift episodes over a whole run history: gaps and islands.

An episode is an unbroken stretch of runs that report drift.  Its runs are found without a
window over a series: the previous run of each run, and the number of episodes that began
before it, are running counts over ranges of run times (``ordered.running_sums``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.operators.ordered import running_sums
from tilth.session import materialize


def drift_episodes(runs: DataFrame, time: str, flag: str, by: list[str]) -> DataFrame:
    """One row per episode: ``by``, ``episode`` (from 1), ``onset``, ``last_drift``, ``n_runs``,
    ``resolved_at`` (the first run after it; null while it lasts).

    One run per series and time; several count as one that drifts if any does.  Runs
    without a time are left out, a null flag is no drift."""
    one = runs.where(F.col(time).isNotNull()).groupBy(*by, time).agg(
        F.max(F.coalesce(F.col(flag), F.lit(False)).cast("int")).alias("_drift"))
    one = materialize(one)
    order = running_sums(one.select(*by, time, F.lit(1).cast("long").alias("_one")), by, time, ["_one"]).select(
        *by, time, F.col("prev_" + time).alias("_prev"))
    before = one.select(*by, F.col(time).alias("_prev"), F.col("_drift").alias("_was"))
    marked = one.join(order, [*by, time]).join(before, [*by, "_prev"], "left").select(
        *by, time, "_drift", ((F.col("_drift") == 1) & (F.coalesce("_was", F.lit(0)) == 0)).cast("long").alias("_begins"))
    marked = materialize(marked)
    numbered = running_sums(marked.select(*by, time, "_begins"), by, time, ["_begins"]).select(
        *by, time, (F.col("_begins_before") + F.col("_begins")).alias("episode"))
    drifts = F.col("_drift") == 1
    return marked.join(numbered, [*by, time]).where("episode > 0").groupBy(*by, "episode").agg(
        F.min(F.when(drifts, F.col(time))).alias("onset"), F.max(F.when(drifts, F.col(time))).alias("last_drift"),
        F.sum("_drift").alias("n_runs"), F.min(F.when(~drifts, F.col(time))).alias("resolved_at"))
