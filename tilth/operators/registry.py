"""Model selection and registry tables.

The registry is a table of versions (model_name, version, stage, run_id, metrics,
tags).  Every decision of the reference is a column expression over that table
or over a join of candidates with the current production row, so any number of
models is decided in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.operators.cleaning import double_text
from tilth.session import materialize

# Thresholds of the reference's decision rules.
RMSE_GAIN_MIN = 2.0          # percent, optimised vs raw
R2_GAIN_MIN = 1.0            # percent
RMSE_GAIN_STRONG = 5.0       # percent, outweighs a worse R2
RMSE_TOLERANCE = 1.0         # percent, "comparable" RMSE
DEPLOY_GAIN = 0.05           # fraction over production RMSE
GATE_RMSE_MAX = 100.0
GATE_R2_MIN = 0.7
STAGE_ORDER = ["Production", "Staging", "None", "Archived"]


def pair_runs(runs: DataFrame, model: str = "model_name", kind: str = "kind") -> DataFrame:
    """Latest raw and latest optimised run per model side by side (left join raw -> opt)."""
    rec = F.struct("version", "rmse", "r2", "run_id")
    side = lambda k: runs.where(F.col(kind) == k).groupBy(model).agg(
        F.max_by(rec, F.col("version")).alias(k))
    return side("raw").join(side("optimized"), model, "left")


def real(c: Column) -> Column:
    """NaN as null: Spark orders NaN above every number, so a comparison with it could hold;
    with null it never does."""
    return F.when(~F.isnan(c), c)


def improvement(pairs: DataFrame) -> DataFrame:
    raw_rmse, raw_r2 = real(F.col("raw.rmse")), real(F.col("raw.r2"))
    opt_rmse, opt_r2 = real(F.col("optimized.rmse")), real(F.col("optimized.r2"))
    return pairs.select(
        "*", (F.try_divide(raw_rmse - opt_rmse, raw_rmse) * 100).alias("rmse_improvement_pct"),
        F.when(raw_r2 != 0, (opt_r2 - raw_r2) / F.abs(raw_r2) * 100).otherwise(0.0).alias("r2_improvement_pct"))


def winner(pairs: DataFrame) -> DataFrame:
    """The raw-vs-optimised rule; 'raw' when there is no optimised run."""
    p = improvement(pairs)
    raw_rmse, raw_r2 = real(F.col("raw.rmse")), real(F.col("raw.r2"))
    opt_rmse, opt_r2 = real(F.col("optimized.rmse")), real(F.col("optimized.r2"))
    gi, gr = F.col("rmse_improvement_pct"), F.col("r2_improvement_pct")
    a = (opt_rmse < raw_rmse) & (gi >= RMSE_GAIN_MIN)
    b = (opt_r2 > raw_r2) & (gr >= R2_GAIN_MIN)
    win = (F.when(F.col("optimized").isNull(), "raw")
           .when(a & ((opt_r2 >= raw_r2) | (gr >= R2_GAIN_MIN)), "optimized")
           .when(a & (gi > RMSE_GAIN_STRONG), "optimized")
           .when(a, "raw")
           .when(b & ((opt_rmse <= raw_rmse) | (F.abs(gi) <= RMSE_TOLERANCE)), "optimized")
           .otherwise("raw"))
    reason = (F.when(F.col("optimized").isNull(), "no optimized run")
              .when(a & ((opt_r2 >= raw_r2) | (gr >= R2_GAIN_MIN)), "lower rmse, comparable r2")
              .when(a & (gi > RMSE_GAIN_STRONG), "rmse gain outweighs r2 loss")
              .when(a, "rmse gain too small for r2 loss")
              .when(b & ((opt_rmse <= raw_rmse) | (F.abs(gi) <= RMSE_TOLERANCE)), "better r2, comparable rmse")
              .when(b, "r2 gain does not justify rmse loss")
              .otherwise("no sufficient improvement"))
    out = p.withColumn("winner", win).withColumn("reason", reason)
    chosen = F.when(F.col("winner") == "optimized", F.col("optimized")).otherwise(F.col("raw"))
    return out.withColumn("chosen", chosen)


def latest_by_stage(versions: DataFrame, model: str = "model_name") -> DataFrame:
    """Latest version per (model, stage)."""
    rec = F.struct("version", "run_id", "rmse")
    return versions.groupBy(model, "stage").agg(F.max_by(rec, F.col("version")).alias("v")).select(
        model, "stage", "v.version", "v.run_id", "v.rmse")


def deploy_decision(candidates: DataFrame, versions: DataFrame, force: bool = False,
                    threshold: float = DEPLOY_GAIN, model: str = "model_name") -> DataFrame:
    """Deploy when forced, when there is no production version, when its RMSE is
    missing or NaN, or when the candidate improves it by more than ``threshold``; a
    candidate whose own RMSE is missing or NaN improves nothing."""
    prod = latest_by_stage(versions, model).where(F.col("stage") == "Production").select(
        model, F.col("version").alias("production_version"), F.col("rmse").alias("production_rmse"))
    j = candidates.join(prod, model, "left")
    pr, cr = real(F.col("production_rmse")), real(F.col("candidate_rmse"))
    missing = pr.isNull()
    gain = F.when(~missing & (pr != 0), (pr - cr) / pr)
    deploy = (F.lit(True) if force else
              F.when(F.col("production_version").isNull(), True).when(missing, True)
              .otherwise(F.coalesce(gain > threshold, F.lit(False))))
    reason = (F.lit("forced") if force else
              F.when(F.col("production_version").isNull(), "no production model")
              .when(missing, "production rmse missing")
              .when(cr.isNull(), "candidate rmse missing")
              .when(gain > threshold, "improvement above threshold").otherwise("improvement below threshold"))
    return j.select(model, "candidate_rmse", "production_rmse", (gain * 100).alias("improvement_percentage"),
                    deploy.alias("should_deploy"), reason.alias("reason"))


def quality_gate(df: DataFrame, rmse: str = "rmse", r2: str = "r2") -> Column:
    return F.when((real(F.col(rmse)) < GATE_RMSE_MAX) & (real(F.col(r2)) > GATE_R2_MIN), "Staging").otherwise("Archived")


def append_versions(versions: DataFrame, candidates: DataFrame, registered_by: str, registered_at: str,
                    model: str = "model_name") -> DataFrame:
    """New version numbers with metric tags: from max + 1 (1 for a new model), several
    candidates of a model numbered by run id."""
    top = versions.groupBy(model).agg(F.max("version").alias("_max"))
    nth = F.row_number().over(Window.partitionBy(model).orderBy("run_id", "candidate_rmse"))
    j = candidates.withColumn("_nth", nth).join(top, model, "left")
    return j.select(model, (F.coalesce(F.col("_max"), F.lit(0)) + F.col("_nth")).alias("version"),
                    "run_id", F.col("candidate_rmse").alias("rmse"), F.col("candidate_r2").alias("r2"),
                    double_text(F.col("candidate_rmse")).alias("tag_validation_rmse"),
                    double_text(F.col("candidate_r2")).alias("tag_validation_r2"),
                    F.lit(registered_by).alias("tag_registered_by"),
                    F.lit(registered_at).alias("tag_registration_date"))


def promote(versions: DataFrame, new_versions: DataFrame, threshold: float = DEPLOY_GAIN,
            model: str = "model_name") -> DataFrame:
    """New stage of every version of the models that received a new version: the new
    version goes to Production if it passed the gate and there is no production
    version or it beats it by more than ``threshold`` (old production archived),
    to Staging if it only passed the gate, else Archived.  Of several new versions the one
    with the lowest RMSE (then the lowest number) can reach Production."""
    nv = new_versions.withColumn("gate", quality_gate(new_versions))
    prod = latest_by_stage(versions, model).where(F.col("stage") == "Production").select(
        model, F.col("rmse").alias("_prod_rmse"), F.col("version").alias("_prod_v"))
    d = nv.join(prod, model, "left")
    old_rmse = real(F.col("_prod_rmse"))
    gain = F.when(old_rmse != 0, (old_rmse - F.col("rmse")) / old_rmse)
    best = F.row_number().over(Window.partitionBy(model).orderBy(F.col("gate").desc(), "rmse", "version")) == 1
    better = old_rmse.isNull() | F.coalesce(gain > threshold, F.lit(False))   # no version or no RMSE to beat
    d = materialize(d.withColumn("promoted", (F.col("gate") == "Staging") & best & better))
    new_rows = d.select(model, "version", F.when(F.col("promoted"), "Production").otherwise(F.col("gate"))
                        .alias("new_stage"))
    old = versions.join(d.groupBy(model).agg(F.max("promoted").alias("promoted")), model)
    old_rows = old.select(model, "version", F.when(F.col("promoted") & (F.col("stage") == "Production"), "Archived")
                          .otherwise(F.col("stage")).alias("new_stage"))
    return old_rows.unionByName(new_rows)


def tag_value(entries: Column, key: str, default=None) -> Column:
    """Tag lookup over an array of (key, value) structs; absent -> default."""
    v = F.element_at(F.map_from_entries(entries), F.lit(key))
    return F.coalesce(v, F.lit(default)) if default is not None else v


def stage_rank(stage: Column) -> Column:
    expr = F.lit(len(STAGE_ORDER))
    for i, s in reversed(list(enumerate(STAGE_ORDER))):
        expr = F.when(stage == s, F.lit(i)).otherwise(expr)
    return expr


def version_uris(versions: DataFrame, model: str = "model_name") -> DataFrame:
    return versions.select(model, "version", "stage",
                           F.format_string("models:/%s/%d", F.col(model), F.col("version")).alias("version_uri"),
                           F.format_string("models:/%s/%s", F.col(model), F.col("stage")).alias("stage_uri"),
                           F.format_string("runs:/%s/model", F.col("run_id")).alias("source_uri"))
