"""Model selection and registry keys bound to ``supplier``-derived runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import registry as G
from tilth.plans.bindings import V_VERSIONS, V_VERSIONS_GAPS, v_versions, v_versions_gaps, with_ctes
from tilth.plans.catalog import query, rounded
from tilth.plans.q_clean import _dtext

REGISTERED_BY = "tilth"
REGISTERED_AT = "2024-02-01T00:00:00"

_PAIRS_SQL = V_VERSIONS + """,
raw AS (SELECT model_name, max(version) AS rv, arg_max(rmse, version) AS rr, arg_max(r2, version) AS r2r,
               arg_max(run_id, version) AS rid FROM v_versions WHERE kind = 'raw' GROUP BY 1),
opt AS (SELECT model_name, max(version) AS ov, arg_max(rmse, version) AS orr, arg_max(r2, version) AS or2,
               arg_max(run_id, version) AS oid FROM v_versions WHERE kind = 'optimized' GROUP BY 1),
p AS (SELECT raw.*, opt.ov, opt.orr, opt.or2, opt.oid FROM raw LEFT JOIN opt USING (model_name)),
imp AS (SELECT *, (rr - orr) / rr * 100 AS gi,
               CASE WHEN r2r <> 0 THEN (or2 - r2r) / abs(r2r) * 100 ELSE 0.0 END AS gr FROM p),
w AS (SELECT *,
  CASE WHEN ov IS NULL THEN 'raw'
       WHEN orr < rr AND gi >= 2 AND (or2 >= r2r OR gr >= 1) THEN 'optimized'
       WHEN orr < rr AND gi >= 2 AND gi > 5 THEN 'optimized'
       WHEN orr < rr AND gi >= 2 THEN 'raw'
       WHEN or2 > r2r AND gr >= 1 AND (orr <= rr OR abs(gi) <= 1) THEN 'optimized'
       ELSE 'raw' END AS winner,
  CASE WHEN ov IS NULL THEN 'no optimized run'
       WHEN orr < rr AND gi >= 2 AND (or2 >= r2r OR gr >= 1) THEN 'lower rmse, comparable r2'
       WHEN orr < rr AND gi >= 2 AND gi > 5 THEN 'rmse gain outweighs r2 loss'
       WHEN orr < rr AND gi >= 2 THEN 'rmse gain too small for r2 loss'
       WHEN or2 > r2r AND gr >= 1 AND (orr <= rr OR abs(gi) <= 1) THEN 'better r2, comparable rmse'
       WHEN or2 > r2r AND gr >= 1 THEN 'r2 gain does not justify rmse loss'
       ELSE 'no sufficient improvement' END AS reason
  FROM imp),
cand AS (SELECT model_name, winner,
                CASE WHEN winner = 'optimized' THEN ov ELSE rv END AS chosen_version,
                CASE WHEN winner = 'optimized' THEN orr ELSE rr END AS candidate_rmse,
                CASE WHEN winner = 'optimized' THEN or2 ELSE r2r END AS candidate_r2,
                CASE WHEN winner = 'optimized' THEN oid ELSE rid END AS run_id FROM w),
prod AS (SELECT model_name, max(version) AS pv, arg_max(rmse, version) AS prmse
         FROM v_versions WHERE stage = 'Production' GROUP BY 1),
newv AS (SELECT c.model_name, m.mx + 1 AS version, c.run_id, c.candidate_rmse AS rmse, c.candidate_r2 AS r2
         FROM cand c JOIN (SELECT model_name, max(version) AS mx FROM v_versions GROUP BY 1) m USING (model_name))"""


def _pairs(spark, d):
    return G.pair_runs(v_versions(spark, d))


def _candidates(spark, d):
    w = G.winner(_pairs(spark, d))
    return w.select("model_name", "winner", F.col("chosen.version").alias("chosen_version"),
                    F.col("chosen.rmse").alias("candidate_rmse"), F.col("chosen.r2").alias("candidate_r2"),
                    F.col("chosen.run_id").alias("run_id"))


@query("pair_improvement", "WITH " + _PAIRS_SQL + """
SELECT model_name, round(rr, 6) AS raw_rmse, round(r2r, 6) AS raw_r2, round(orr, 6) AS opt_rmse,
       round(or2, 6) AS opt_r2, round(gi, 6) AS rmse_improvement_pct, round(gr, 6) AS r2_improvement_pct
FROM imp""")
def pair_improvement(spark, d):
    p = G.improvement(_pairs(spark, d))
    out = p.select("model_name", F.col("raw.rmse").alias("raw_rmse"), F.col("raw.r2").alias("raw_r2"),
                   F.col("optimized.rmse").alias("opt_rmse"), F.col("optimized.r2").alias("opt_r2"),
                   "rmse_improvement_pct", "r2_improvement_pct")
    return rounded(out, {c: 6 for c in out.columns if c != "model_name"})


@query("pair_winner", "WITH " + _PAIRS_SQL + "\nSELECT model_name, winner, reason FROM w WHERE ov IS NOT NULL")
def pair_winner(spark, d):
    return G.winner(_pairs(spark, d)).where(F.col("optimized").isNotNull()).select("model_name", "winner", "reason")


@query("pair_fallback", "WITH " + _PAIRS_SQL + """
SELECT model_name, winner, chosen_version, round(candidate_rmse, 6) AS candidate_rmse FROM cand""")
def pair_fallback(spark, d):
    return rounded(_candidates(spark, d).select("model_name", "winner", "chosen_version", "candidate_rmse"),
                   {"candidate_rmse": 6})


@query("deploy_decision", "WITH " + _PAIRS_SQL + """
SELECT c.model_name, round(c.candidate_rmse, 6) AS candidate_rmse, round(p.prmse, 6) AS production_rmse,
       round(CASE WHEN p.prmse IS NOT NULL AND NOT isnan(p.prmse) AND p.prmse <> 0
                  THEN (p.prmse - c.candidate_rmse) / p.prmse * 100 END, 6) AS improvement_percentage,
       CASE WHEN p.pv IS NULL THEN true WHEN p.prmse IS NULL OR isnan(p.prmse) THEN true
            ELSE coalesce((p.prmse - c.candidate_rmse) / nullif(p.prmse, 0) > 0.05, false) END AS should_deploy,
       CASE WHEN p.pv IS NULL THEN 'no production model' WHEN p.prmse IS NULL OR isnan(p.prmse)
            THEN 'production rmse missing'
            WHEN (p.prmse - c.candidate_rmse) / nullif(p.prmse, 0) > 0.05 THEN 'improvement above threshold'
            ELSE 'improvement below threshold' END AS reason
FROM cand c LEFT JOIN prod p USING (model_name)""")
def deploy_decision(spark, d):
    out = G.deploy_decision(_candidates(spark, d), v_versions(spark, d))
    return rounded(out, {"candidate_rmse": 6, "production_rmse": 6, "improvement_percentage": 6})


@query("quality_gate", with_ctes(V_VERSIONS) + """
SELECT model_name, version, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       CASE WHEN rmse < 100 AND r2 > 0.7 THEN 'Staging' ELSE 'Archived' END AS gate FROM v_versions""")
def quality_gate(spark, d):
    v = v_versions(spark, d)
    return rounded(v.select("model_name", "version", "rmse", "r2", G.quality_gate(v).alias("gate")),
                   {"rmse": 6, "r2": 6})


@query("registry_append", "WITH " + _PAIRS_SQL + f"""
SELECT model_name, version, run_id, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
       {_dtext('rmse')} AS tag_validation_rmse, {_dtext('r2')} AS tag_validation_r2,
       '{REGISTERED_BY}' AS tag_registered_by, '{REGISTERED_AT}' AS tag_registration_date FROM newv""")
def registry_append(spark, d):
    out = G.append_versions(v_versions(spark, d), _candidates(spark, d), REGISTERED_BY, REGISTERED_AT)
    return rounded(out, {"rmse": 6, "r2": 6})


@query("latest_by_stage", with_ctes(V_VERSIONS) + """
SELECT model_name, stage, max(version) AS version, arg_max(run_id, version) AS run_id,
       round(arg_max(rmse, version), 6) AS rmse FROM v_versions GROUP BY 1, 2""")
def latest_by_stage(spark, d):
    return rounded(G.latest_by_stage(v_versions(spark, d)), {"rmse": 6})


@query("promote_version", "WITH " + _PAIRS_SQL + """,
d AS (SELECT n.*, CASE WHEN n.rmse < 100 AND n.r2 > 0.7 THEN 'Staging' ELSE 'Archived' END AS gate,
             p.pv, p.prmse FROM newv n LEFT JOIN prod p USING (model_name)),
d2 AS (SELECT *, gate = 'Staging' AND (prmse IS NULL OR coalesce(
               CASE WHEN prmse <> 0 THEN (prmse - rmse) / prmse > 0.05 END, false)) AS promoted FROM d)
SELECT v.model_name, v.version,
       CASE WHEN d2.promoted AND v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS new_stage
FROM v_versions v JOIN d2 USING (model_name)
UNION ALL
SELECT model_name, version, CASE WHEN promoted THEN 'Production' ELSE gate END FROM d2""")
def promote_version(spark, d):
    versions = v_versions(spark, d)
    nv = G.append_versions(versions, _candidates(spark, d), REGISTERED_BY, REGISTERED_AT)
    return G.promote(versions, nv)


def _tag_entries():
    rmse_tag = F.struct(F.lit("validation_rmse").alias("key"),
                        F.format_string("%.4f", F.col("rmse")).alias("value"))
    by_tag = F.struct(F.lit("registered_by").alias("key"), F.lit(REGISTERED_BY).alias("value"))
    return F.when(F.col("version") % 5 == 0, F.array(by_tag)).otherwise(F.array(rmse_tag, by_tag))


@query("tag_lookup", with_ctes(V_VERSIONS) + f"""
SELECT model_name, version,
       CASE WHEN version % 5 = 0 THEN NULL ELSE TRY_CAST(printf('%.4f', rmse) AS DOUBLE) END AS validation_rmse,
       version % 5 <> 0 AS has_rmse_tag, '{REGISTERED_BY}' AS registered_by FROM v_versions""")
def tag_lookup(spark, d):
    v = v_versions(spark, d).withColumn("tags", _tag_entries())
    rm = G.tag_value(F.col("tags"), "validation_rmse")
    return v.select("model_name", "version", rm.try_cast("double").alias("validation_rmse"),
                    rm.isNotNull().alias("has_rmse_tag"),
                    G.tag_value(F.col("tags"), "registered_by", "unknown").alias("registered_by"))


@query("registry_status", with_ctes(V_VERSIONS) + """
SELECT model_name, stage, version,
       CASE stage WHEN 'Production' THEN 0 WHEN 'Staging' THEN 1 WHEN 'None' THEN 2 WHEN 'Archived' THEN 3
                  ELSE 4 END AS stage_rank, run_id FROM v_versions""")
def registry_status(spark, d):
    v = v_versions(spark, d)
    return v.select("model_name", "stage", "version", G.stage_rank(F.col("stage")).alias("stage_rank"),
                    "run_id").orderBy("model_name", "stage_rank", "version")


@query("version_uri", with_ctes(V_VERSIONS) + """
SELECT model_name, version, stage, printf('models:/%s/%d', model_name, version) AS version_uri,
       printf('models:/%s/%s', model_name, stage) AS stage_uri, printf('runs:/%s/model', run_id) AS source_uri
FROM v_versions""")
def version_uri(spark, d):
    return G.version_uris(v_versions(spark, d))


# ---- the rules on metrics that are NaN, null or zero, with two candidates a model ----------

@query("pair_winner_gaps", with_ctes(V_VERSIONS_GAPS) + """,
p AS (SELECT r.model_name, r.version AS rv, r.rmse AS rr, r.r2 AS r2r, o.version AS ov, o.rmse AS orr, o.r2 AS or2,
             (r.rmse - o.rmse) / nullif(r.rmse, 0) * 100 AS gi,
             CASE WHEN r.r2 <> 0 THEN (o.r2 - r.r2) / abs(r.r2) * 100 ELSE 0.0 END AS gr
      FROM (SELECT * FROM last WHERE kind = 'raw') r
      LEFT JOIN (SELECT * FROM last WHERE kind = 'optimized') o USING (model_name)),
w AS (SELECT *, coalesce(orr < rr AND gi >= 2, false) AS a, coalesce(or2 > r2r AND gr >= 1, false) AS b,
             coalesce(or2 >= r2r OR gr >= 1, false) AS keeps, coalesce(orr <= rr OR abs(gi) <= 1, false) AS close FROM p)
SELECT model_name, round(gi, 6) AS rmse_improvement_pct, round(gr, 6) AS r2_improvement_pct,
       CASE WHEN ov IS NOT NULL AND (a AND (keeps OR gi > 5) OR NOT a AND b AND close) THEN 'optimized' ELSE 'raw' END AS winner,
       CASE WHEN ov IS NOT NULL AND (a AND (keeps OR gi > 5) OR NOT a AND b AND close) THEN ov ELSE rv END AS chosen_version
FROM w""")
def pair_winner_gaps(spark, d):
    w = G.winner(G.pair_runs(v_versions_gaps(spark, d)))
    return rounded(w.select("model_name", "rmse_improvement_pct", "r2_improvement_pct", "winner",
                            F.col("chosen.version").alias("chosen_version")),
                   {"rmse_improvement_pct": 6, "r2_improvement_pct": 6})


def _two_candidates(spark, d):
    """The latest raw and the latest optimised run of each model."""
    rec = F.struct("run_id", "rmse", "r2")
    v = v_versions_gaps(spark, d).groupBy("model_name", "kind").agg(F.max_by(rec, "version").alias("r"))
    return v.select("model_name", F.col("r.run_id").alias("run_id"), F.col("r.rmse").alias("candidate_rmse"),
                    F.col("r.r2").alias("candidate_r2"))


@query("deploy_decision_gaps", with_ctes(V_VERSIONS_GAPS) + """
SELECT model_name, coalesce(p.version IS NULL OR p.rmse IS NULL OR (p.rmse - c.rmse) / nullif(p.rmse, 0) > 0.05, false)
         AS should_deploy,
       CASE WHEN p.version IS NULL THEN 'no production model' WHEN p.rmse IS NULL THEN 'production rmse missing'
            WHEN c.rmse IS NULL THEN 'candidate rmse missing'
            WHEN (p.rmse - c.rmse) / nullif(p.rmse, 0) > 0.05 THEN 'improvement above threshold'
            ELSE 'improvement below threshold' END AS reason, count(*) AS n
FROM last c LEFT JOIN prod p USING (model_name) GROUP BY ALL""")
def deploy_decision_gaps(spark, d):
    out = G.deploy_decision(_two_candidates(spark, d), v_versions_gaps(spark, d))
    return out.groupBy("model_name", "should_deploy", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("promote_two_gaps", with_ctes(V_VERSIONS_GAPS) + """,
n AS (SELECT c.model_name, c.run_id, c.rmse, c.r2,
             (SELECT max(version) FROM v_gaps v WHERE v.model_name = c.model_name)
               + row_number() OVER (PARTITION BY c.model_name ORDER BY c.run_id) AS version,
             coalesce(c.rmse < 100 AND c.r2 > 0.7, false) AS good FROM last c),
b AS (SELECT n.*, good AND row_number() OVER (PARTITION BY n.model_name ORDER BY good DESC, n.rmse, n.version) = 1
               AND coalesce(p.rmse IS NULL OR (p.rmse - n.rmse) / nullif(p.rmse, 0) > 0.05, false) AS up
      FROM n LEFT JOIN prod p USING (model_name)),
m AS (SELECT model_name, bool_or(up) AS up FROM b GROUP BY 1)
SELECT v.model_name, v.version, CASE WHEN m.up AND v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS new_stage
FROM v_gaps v JOIN m USING (model_name)
UNION ALL
SELECT model_name, version, CASE WHEN up THEN 'Production' WHEN good THEN 'Staging' ELSE 'Archived' END FROM b""")
def promote_two_gaps(spark, d):
    versions = v_versions_gaps(spark, d)
    return G.promote(versions, G.append_versions(versions, _two_candidates(spark, d), REGISTERED_BY, REGISTERED_AT))
