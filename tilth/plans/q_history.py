"""Keys over periods: sketches per month, months by file name, drift episodes, density curves
(SURVEY 5, 24, 30, 88-92, 96, 106)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import monitor as M
from tilth.operators.density import density
from tilth.operators.episodes import drift_episodes
from tilth.operators import sketches as S
from tilth.plans.bindings import V_SKEW, table, v_skew, with_ctes
from tilth.plans.catalog import query, rounded
from tilth.session import scratch_path
from tilth.sources.files import read_months

_COLS = ["o_totalprice", "o_custkey"]
_REF, _CUR = "1996", "1999"


def _orders(spark, d):
    """Orders with a drift: prices grow from 1998 on."""
    o = table(spark, d, "orders")
    return o.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_custkey",
                    F.when(F.year("o_orderdate") >= 1998, F.col("o_totalprice") * 1.3).otherwise(F.col("o_totalprice")).alias("o_totalprice"))


@query("sketch_drift", f"""
WITH s AS (SELECT CASE WHEN year(o_orderdate) = {_REF} THEN 'r' ELSE 'c' END AS side, o_custkey::DOUBLE AS k,
    CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice * 1.3 ELSE o_totalprice END AS x
  FROM orders WHERE year(o_orderdate) IN ({_REF}, {_CUR})),
n AS (SELECT count_if(side = 'r') AS n_ref, count_if(side = 'c') AS n_cur FROM s)
SELECT c AS "column", n_ref, n_cur, true AS ks_close, true AS wasserstein_close, true AS distinct_close
FROM n, (VALUES ('o_totalprice'), ('o_custkey')) v(c)""")
def sketch_drift(spark, d):
    """Drift of two years from stored monthly sketches, held against the exact statistics: KS
    within 0.01, the distance within 5 % of a deviation, distinct counts within 10 %."""
    rows = _orders(spark, d)
    path = scratch_path(spark, "sketches")
    S.period_sketches(rows, "month", _COLS).write.parquet(path)
    stored = spark.read.parquet(path)
    year = F.substring("period", 1, 4)
    found = S.drift(stored, year == _REF, year == _CUR)
    side = F.when(F.substring("month", 1, 4) == _REF, M.REF).when(F.substring("month", 1, 4) == _CUR, M.CUR)
    both = rows.withColumn("dataset", side).where(F.col("dataset").isNotNull())
    exact = M.ks_test(both, _COLS).select("column", F.col("statistic").alias("ks_exact")).join(
        M.wasserstein(both, _COLS).select("column", F.col("statistic").alias("w_exact")), "column")
    kinds = both.where(F.col("dataset") == M.REF).agg(*[F.count_distinct(c).alias(c) for c in _COLS]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("d_exact")) for c in _COLS])).alias("r")).select("r.*")
    return found.join(exact, "column").join(kinds, "column").select(
        "column", "n_ref", "n_cur", (F.abs(F.col("ks") - F.col("ks_exact")) < 0.01).alias("ks_close"),
        (F.abs(F.col("wasserstein_norm") - F.col("w_exact")) < 0.05).alias("wasserstein_close"),
        (F.abs(F.col("distinct_ref") - F.col("d_exact")) <= 0.1 * F.col("d_exact") + 1).alias("distinct_close"))


@query("sketch_summary", """
WITH s AS (SELECT o_custkey::DOUBLE AS k, CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice * 1.3 ELSE o_totalprice END AS x FROM orders),
u AS (SELECT 'o_totalprice' AS c, x FROM s UNION ALL SELECT 'o_custkey', k FROM s)
SELECT c AS "column", count(x) AS n, round(avg(x), 4) AS mean, round(min(x), 4) AS low, round(max(x), 4) AS high FROM u GROUP BY c""")
def sketch_summary(spark, d):
    """Summary of all months from merged sketches (what is exact of it)."""
    out = S.summary(S.period_sketches(_orders(spark, d), "month", _COLS))
    return rounded(out.select("column", "n", "mean", "low", "high"), {"mean": 4, "low": 4, "high": 4})


@query("constant_columns_sketch", """
SELECT unnest(['o_orderkey', 'o_totalprice', 'o_orderstatus', 'one', 'none', 'nan']) AS "column",
       unnest([false, false, false, true, true, true]) AS is_constant""")
def constant_columns_sketch(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.lit(1)).alias("one"),
        F.lit(None).cast("string").alias("none"), F.lit(float("nan")).alias("nan"))
    return S.constant_columns(o)


_MONTHS = ["1995_02", "1997_11"]


@query("months_by_name", """
SELECT strftime(o_orderdate, '%Y_%m') AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE strftime(o_orderdate, '%Y_%m') IN ('1995_02', '1997_11') GROUP BY 1""")
def months_by_name(spark, d):
    """Two months picked by name from a folder of monthly CSV files, which is read as it lies."""
    folder = scratch_path(spark, "monthly")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy_MM").alias("name"))
    for m in ("1995_01", *_MONTHS, "1997_12"):
        o.where(F.col("name") == m).drop("name").write.csv(f"{folder}/orders_{m}.csv", header=True)
    got = read_months(spark, folder, _MONTHS, o.drop("name").schema)
    return rounded(got.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), {"total": 2})


@query("drift_episodes", """
WITH r AS (SELECT event_type AS project, CAST(ts AS DATE) AS day, avg(value) AS m FROM events GROUP BY ALL),
o AS (SELECT event_type AS project, avg(value) AS m FROM events GROUP BY ALL),
f AS (SELECT project, day, r.m > o.m AS drifted FROM r JOIN o USING (project)),
p AS (SELECT *, drifted AND NOT coalesce(lag(drifted) OVER w, false) AS begins FROM f WINDOW w AS (PARTITION BY project ORDER BY day)),
e AS (SELECT *, sum(begins::INT) OVER (PARTITION BY project ORDER BY day) AS episode FROM p)
SELECT project, episode::BIGINT AS episode, min(day) FILTER (drifted) AS onset, max(day) FILTER (drifted) AS last_drift,
       count_if(drifted)::BIGINT AS n_runs, min(day) FILTER (NOT drifted) AS resolved_at
FROM e WHERE episode > 0 GROUP BY project, episode""")
def drift_episodes_key(spark, d):
    """Stretches of days on which an event type's mean lies above its overall mean."""
    e = table(spark, d, "events")
    days = e.groupBy(F.col("event_type").alias("project"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("m"))
    whole = e.groupBy(F.col("event_type").alias("project")).agg(F.avg("value").alias("_m"))
    runs = days.join(whole, "project").select("project", "day", (F.col("m") > F.col("_m")).alias("drifted"))
    return drift_episodes(runs, "day", "drifted", ["project"])


@query("density_by", with_ctes(V_SKEW) + """,
s AS (SELECT lang AS hue, count(n_chars) AS n, stddev_samp(n_chars) AS sd, min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM v_skew GROUP BY lang),
g AS (SELECT *, sd * pow(n, -0.2) AS h FROM s),
t AS (SELECT *, lo - 3 * h AS x0, (hi - lo + 6 * h) / 99 AS step FROM g),
p AS (SELECT hue, n, h, x0, step, (n_chars - x0) / step AS p FROM v_skew JOIN t ON hue = lang WHERE n_chars IS NOT NULL),
b AS (SELECT hue, i, sum(w) AS w FROM (SELECT hue, floor(p) AS i, 1 - (p - floor(p)) AS w FROM p
      UNION ALL SELECT hue, floor(p) + 1, p - floor(p) FROM p) GROUP BY ALL)
SELECT b.hue AS hue, point, round(max(x0 + point * step), 4) AS x,
       round(sum(w * exp(-0.5 * pow((point - i) * step / h, 2)) / (sqrt(2 * pi()) * h * n)), 10) AS density
FROM b JOIN t ON b.hue = t.hue, (SELECT unnest(range(0, 100))::INTEGER AS point) GROUP BY b.hue, point""")
def density_by(spark, d):
    return rounded(density(v_skew(spark, d), "n_chars", "lang", points=100), {"x": 4, "density": 10})
