"""Hypothesis-test keys.

Oracles use closed-form tails where the degrees of freedom allow one (F with
df1 = 2, chi-square with even df); t and normal tails have no DuckDB function,
so those keys check the statistic and the p-value is covered by unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tilth.operators import htest as H
from tilth.operators import normality as N
from tilth.plans.bindings import V_GROUP, V_MODEL, V_SKEW, table, v_group, v_model, v_skew, with_ctes
from tilth.plans.catalog import query, rounded


def _anova_sql(src: str, stat: str = "f") -> str:
    """ANOVA over a relation (grp, x); F-tail closed form for three groups (df1 = 2)."""
    return f"""
g AS (SELECT grp, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM {src} GROUP BY grp),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS nn, sum(n * m) / sum(n) AS gm,
             sum((n - 1) * coalesce(v, 0)) AS ssw FROM g),
s AS (SELECT t.k, t.nn, t.ssw, sum(g.n * (g.m - t.gm) ^ 2) AS ssb FROM g, t GROUP BY t.k, t.nn, t.ssw),
r AS (SELECT k, nn, (ssb / (k - 1)) / (ssw / (nn - k)) AS f FROM s)
SELECT k, nn AS n, round(f, 6) AS {stat}, k - 1 AS df1, nn - k AS df2,
       round(pow((nn - k) / ((nn - k) + 2 * f), (nn - k) / 2.0), 6) AS p_value FROM r"""


_P6 = {"f": 6, "w": 6, "p_value": 6}


@query("anova_oneway", with_ctes(V_GROUP) + """,
src AS (SELECT l_returnflag AS grp, l_extendedprice AS x FROM v_group),""" + _anova_sql("src"))
def anova_oneway(spark, d):
    return rounded(H.anova(v_group(spark, d), [], "l_returnflag", "l_extendedprice"), _P6)


@query("levene_median", with_ctes(V_GROUP) + """,
med AS (SELECT l_returnflag AS grp, quantile_cont(l_extendedprice, 0.5) AS md FROM v_group GROUP BY 1),
src AS (SELECT v.l_returnflag AS grp, abs(v.l_extendedprice - med.md) AS x
        FROM v_group v JOIN med ON v.l_returnflag = med.grp),""" + _anova_sql("src", "w"))
def levene_median(spark, d):
    return rounded(H.levene(v_group(spark, d), [], "l_returnflag", "l_extendedprice"), _P6)


@query("ttest_pooled", with_ctes(V_GROUP) + """,
g AS (SELECT l_linestatus AS grp, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) AS v
      FROM v_group WHERE l_linestatus IN ('F', 'O') GROUP BY 1),
s AS (SELECT max(CASE WHEN grp = 'F' THEN n END) AS n1, max(CASE WHEN grp = 'O' THEN n END) AS n2,
             max(CASE WHEN grp = 'F' THEN m END) AS mean1, max(CASE WHEN grp = 'O' THEN m END) AS mean2,
             max(CASE WHEN grp = 'F' THEN v END) AS v1, max(CASE WHEN grp = 'O' THEN v END) AS v2 FROM g)
SELECT n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2,
       round((mean1 - mean2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6)
         AS t,
       n1 + n2 - 2 AS df
FROM s""")
def ttest_pooled(spark, d):
    out = H.ttest_pooled(v_group(spark, d), [], "l_linestatus", "l_extendedprice", "F", "O")
    return rounded(out.drop("p_value"), {"mean1": 6, "mean2": 6, "t": 6})


_MIDRANK = "rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0"


@query("mannwhitney_u", with_ctes(V_GROUP) + f""",
r AS (SELECT grp, x, {_MIDRANK} AS mr FROM (
        SELECT l_linestatus AS grp, l_extendedprice AS x FROM v_group WHERE l_linestatus IN ('F', 'O'))),
ties AS (SELECT sum(c * c * c - c) AS tt FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM r GROUP BY x)),
s AS (SELECT count_if(grp = 'F') AS n1, count_if(grp = 'O') AS n2, count(*) AS n,
             sum(CASE WHEN grp = 'F' THEN mr END) AS r1 FROM r),
u AS (SELECT n1, n2, n, r1 - n1 * (n1 + 1) / 2.0 AS u FROM s)
SELECT n1, n2, round(u, 4) AS u,
       round((greatest(u, n1 * n2 - u) - n1 * n2 / 2.0 - 0.5)
             / sqrt(n1 * n2 / 12.0 * ((n + 1) - tt / (n * (n - 1.0)))), 6) AS z
FROM u, ties""")
def mannwhitney_u(spark, d):
    out = H.mann_whitney(v_group(spark, d), [], "l_linestatus", "l_extendedprice", "F", "O")
    return rounded(out.drop("p_value"), {"u": 4, "z": 6})


def _kruskal_sql(src: str, by: str, pvalue: str, show_by: bool = True) -> str:
    """Kruskal-Wallis per {by} over a relation ({by}, grp, x)."""
    return f"""
r AS (SELECT {by}, grp, x,
             rank() OVER (PARTITION BY {by} ORDER BY x)
               + (count(*) OVER (PARTITION BY {by}, x) - 1) / 2.0 AS mr FROM {src}),
ties AS (SELECT {by}, sum(c * c * c - c) AS tt
         FROM (SELECT {by}, CAST(count(*) AS DOUBLE) AS c FROM r GROUP BY {by}, x) GROUP BY {by}),
g AS (SELECT {by}, grp, count(*) AS ng, sum(mr) AS rs FROM r GROUP BY {by}, grp),
s AS (SELECT {by}, count(*) AS k, CAST(sum(ng) AS BIGINT) AS n, sum(rs * rs / ng) AS q FROM g GROUP BY {by}),
h AS (SELECT s.{by}, k, n, (12.0 / (n * (n + 1.0)) * q - 3 * (n + 1.0)) / (1 - tt / (n * n * n * 1.0 - n)) AS h,
             k - 1 AS df
      FROM s JOIN ties USING ({by}))
SELECT {by + ", " if show_by else ""}k, n, round(h, 6) AS h, df, round({pvalue}, 6) AS p_value FROM h"""


@query("kruskal_wallis", with_ctes(V_GROUP) + """,
src AS (SELECT 'all' AS feature, l_returnflag AS grp, l_extendedprice AS x FROM v_group),"""
       + _kruskal_sql("src", "feature", "exp(-h / 2)", show_by=False))
def kruskal_wallis(spark, d):
    return rounded(H.kruskal(v_group(spark, d), [], "l_returnflag", "l_extendedprice"), {"h": 6, "p_value": 6})


@query("pearson_r", """
SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS r,
       round(corr(l_quantity, l_extendedprice)
             * sqrt((count(*) - 2) / (1 - corr(l_quantity, l_extendedprice) ^ 2)), 4) AS t
FROM lineitem""")
def pearson_r(spark, d):
    out = H.pearson(table(spark, d, "lineitem"), [], "l_quantity", "l_extendedprice")
    return rounded(out.drop("p_value"), {"r": 6, "t": 4})


@query("normality_jb", with_ctes(V_SKEW) + """,
m AS (SELECT lang, avg(n_chars) AS mu, count(n_chars) AS n FROM v_skew GROUP BY lang),
c AS (SELECT v.lang, m.n, avg((v.n_chars - m.mu) ^ 2) AS m2, avg((v.n_chars - m.mu) ^ 3) AS m3,
             avg((v.n_chars - m.mu) ^ 4) AS m4
      FROM v_skew v JOIN m USING (lang) GROUP BY v.lang, m.n),
g AS (SELECT lang, n, CASE WHEN n >= 3 THEN m3 / pow(m2, 1.5) END AS g,
             CASE WHEN n >= 3 THEN m4 / (m2 * m2) - 3 END AS k FROM c)
SELECT lang, n, round(g, 6) AS skew, round(k, 6) AS kurt, round(n / 6.0 * (g * g + k * k / 4), 4) AS jb,
       round(exp(-(n / 6.0 * (g * g + k * k / 4)) / 2), 6) AS p_value
FROM g""")
def normality_jb(spark, d):
    out = H.jarque_bera(v_skew(spark, d), ["lang"], "n_chars")
    return rounded(out, {"skew": 6, "kurt": 6, "jb": 4, "p_value": 6})


_SCREEN_FEATURES = ["l_returnflag", "line_no", "tax_band"]
# chi-square upper tails for the even degrees of freedom of the three candidates
_EVEN_DF_TAIL = """CASE df
  WHEN 2 THEN exp(-h / 2)
  WHEN 6 THEN exp(-h / 2) * (1 + h / 2 + (h / 2) ^ 2 / 2)
  WHEN 8 THEN exp(-h / 2) * (1 + h / 2 + (h / 2) ^ 2 / 2 + (h / 2) ^ 3 / 6) END"""


@query("feature_screen", with_ctes(V_MODEL) + """,
src AS (SELECT 'l_returnflag' AS feature, l_returnflag AS grp, target AS x FROM v_model
        UNION ALL SELECT 'line_no', line_no, target FROM v_model
        UNION ALL SELECT 'tax_band', CAST(l_tax AS VARCHAR), target FROM v_model),
res AS (WITH """ + _kruskal_sql("src", "feature", _EVEN_DF_TAIL).lstrip() + """)
SELECT *, p_value < 0.05 AS keep FROM res""")
def feature_screen(spark, d):
    m = v_model(spark, d).withColumn("tax_band", F.col("l_tax").cast("string"))
    out = H.feature_screen(m, _SCREEN_FEATURES, "target")
    return rounded(out, {"h": 6, "p_value": 6}).withColumn("keep", F.col("p_value") < 0.05)


@query("feature_screen_mixed", with_ctes(V_MODEL) + """,
g AS (SELECT l_returnflag, count(*) AS n, avg(target) AS m, var_samp(target) AS v FROM v_model GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS nn, sum(n * m) / sum(n) AS gm, sum((n - 1) * v) AS ssw FROM g),
f AS (SELECT (sum(g.n * (g.m - t.gm) ^ 2) / (max(t.k) - 1)) / (max(t.ssw) / (max(t.nn) - max(t.k))) AS f,
             max(t.nn) - max(t.k) AS d2 FROM g, t)
SELECT 'l_returnflag' AS feature, 'anova' AS test, round(f, 6) AS statistic, round(pow(d2 / (d2 + 2 * f), d2 / 2.0), 6) AS p_value,
       pow(d2 / (d2 + 2 * f), d2 / 2.0) < 0.05 AS keep FROM f
UNION ALL
SELECT unnest(['l_quantity', 'l_discount']), 'pearson',
       unnest([round(corr(l_quantity, target), 6), round(corr(l_discount, target), 6)]), 0.0, true FROM v_model""")
def feature_screen_mixed(spark, d):
    """The parametric branch: ANOVA for the three-level flag, Pearson for the numeric
    features that make up the target (so far from chance that p is 0 to six places)."""
    out = H.screen(v_model(spark, d), ["l_returnflag"], ["l_quantity", "l_discount"], "target", parametric=True)
    return rounded(out, {"statistic": 6, "p_value": 6})


@query("test_router", """
WITH src AS (SELECT 'l_extendedprice' AS target_name, l_returnflag AS grp, l_extendedprice AS x FROM lineitem
             UNION ALL SELECT 'l_quantity', l_returnflag, l_quantity FROM lineitem),
med AS (SELECT target_name, grp, quantile_cont(x, 0.5) AS md FROM src GROUP BY 1, 2),
dev AS (SELECT s.target_name, s.grp, abs(s.x - m.md) AS x FROM src s JOIN med m USING (target_name, grp)),
g AS (SELECT target_name, grp, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM dev GROUP BY 1, 2),
t AS (SELECT target_name, count(*) AS k, sum(n) AS nn, sum(n * m) / sum(n) AS gm, sum((n - 1) * v) AS ssw
      FROM g GROUP BY 1),
f AS (SELECT t.target_name, t.k, (sum(g.n * (g.m - t.gm) ^ 2) / (t.k - 1)) / (t.ssw / (t.nn - t.k)) AS w,
             t.nn - t.k AS d2
      FROM g JOIN t USING (target_name) GROUP BY t.target_name, t.k, t.nn, t.ssw),
mm AS (SELECT target_name, grp, avg(x) AS mu, count(*) AS n FROM src GROUP BY 1, 2),
c AS (SELECT s.target_name, s.grp, mm.n, avg((s.x - mm.mu) ^ 2) AS m2, avg((s.x - mm.mu) ^ 3) AS m3,
             avg((s.x - mm.mu) ^ 4) AS m4 FROM src s JOIN mm USING (target_name, grp)
      GROUP BY s.target_name, s.grp, mm.n),
jb AS (SELECT target_name, min(exp(-(n / 6.0 * ((m3 / pow(m2, 1.5)) ^ 2 + (m4 / (m2 * m2) - 3) ^ 2 / 4)) / 2))
              AS min_normal_p FROM c GROUP BY 1),
j AS (SELECT f.target_name, f.k, pow(d2 / (d2 + 2 * w), d2 / 2.0) AS levene_p, jb.min_normal_p
      FROM f JOIN jb USING (target_name))
SELECT target_name, k, round(levene_p, 6) AS levene_p, round(min_normal_p, 6) AS min_normal_p,
       CASE WHEN levene_p >= 0.05 AND min_normal_p >= 0.05 THEN (CASE WHEN k = 2 THEN 't-test' ELSE 'anova' END)
            WHEN k = 2 THEN 'mann-whitney' ELSE 'kruskal' END AS test
FROM j""")
def test_router(spark, d):
    li = table(spark, d, "lineitem")
    long = li.select(F.lit("l_extendedprice").alias("target_name"), "l_returnflag",
                     F.col("l_extendedprice").alias("x")).unionByName(
        li.select(F.lit("l_quantity").alias("target_name"), "l_returnflag", F.col("l_quantity").alias("x")))
    out = H.test_router(long, ["target_name"], "l_returnflag", "x")
    return rounded(out.select("target_name", "k", "levene_p", "min_normal_p", "test"),
                   {"levene_p": 6, "min_normal_p": 6})


def _poly_sql(c: list[float], x: str) -> str:
    out = repr(c[-1]) + "::DOUBLE"
    for v in reversed(c[:-1]):
        out = f"({out} * ({x}) + {v!r}::DOUBLE)"
    return out


def _quantile_sql(p: str) -> str:
    ratio = lambda c, x: f"({_poly_sql(c[0], x)} / {_poly_sql(c[1], x)})"
    t = f"sqrt(-ln(least({p}, 1 - {p})))"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(N.CENTRE, f'0.180625 - ({p} - 0.5) * ({p} - 0.5)')} "
            f"WHEN {t} <= 5 THEN sign({p} - 0.5) * {ratio(N.TAIL, t + ' - 1.6')} ELSE sign({p} - 0.5) * {ratio(N.FAR, t + ' - 5')} END")


@query("normality_w", with_ctes(V_SKEW) + f""",
r AS (SELECT lang, n_chars::DOUBLE AS x, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM v_skew WHERE n_chars IS NOT NULL),
m AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM r),
q AS (SELECT lang, x, i, n::DOUBLE AS n, {_quantile_sql('p')} AS m FROM m),
s AS (SELECT lang, n, sum(m * x) AS s, sum(m * m) AS mm, var_pop(x) * n AS ss, max(m) AS m1, max(CASE WHEN i = n - 1 THEN m END) AS m2,
             max(x) - min(x) AS ends, max(CASE WHEN i = n - 1 THEN x END) - max(CASE WHEN i = 2 THEN x END) AS inside
      FROM q GROUP BY lang, n),
a AS (SELECT *, m1 / sqrt(mm) + {_poly_sql(N.LAST, '1 / sqrt(n)')} AS a1, m2 / sqrt(mm) + {_poly_sql(N.NEXT, '1 / sqrt(n)')} AS a2 FROM s),
w AS (SELECT lang, n, pow((s - m1 * ends - m2 * inside) / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
             + a1 * ends + a2 * inside, 2) / ss AS w FROM a)
SELECT lang, n::BIGINT AS n, round(w, 6) AS w FROM w""")
def normality_w(spark, d):
    """W of text lengths by language (groups of 12 to 5,000 values here; p is unit-tested)."""
    return rounded(N.shapiro(v_skew(spark, d), ["lang"], "n_chars").drop("p_value"), {"w": 6})


@query("mannwhitney_exact", """
WITH RECURSIVE g AS (SELECT s_nationkey AS nation, s_acctbal AS x, s_suppkey % 2 AS side,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) AS rk FROM supplier),
t AS (SELECT nation, count(*) AS n, count_if(side = 1) AS n1, count_if(side = 0) AS n2,
             sum(CASE WHEN side = 1 THEN rk END) - count_if(side = 1) * (count_if(side = 1) + 1) / 2 AS u FROM g GROUP BY nation),
sub AS (SELECT nation, n, n1, 0 AS i, 0 AS taken, 0 AS ranks FROM t WHERE n1 > 0 AND n2 > 0
  UNION ALL SELECT nation, n, n1, i + 1, taken + b, ranks + b * (i + 1) FROM sub, (VALUES (0), (1)) v(b)
  WHERE i < n AND taken + b <= n1),
d AS (SELECT nation, ranks - n1 * (n1 + 1) / 2 AS u FROM sub WHERE i = n AND taken = n1)
SELECT t.nation, t.n1, t.n2, t.u, round(least(1.0, 2.0 * count_if(d.u >= greatest(t.u, t.n1 * t.n2 - t.u)) / count(*)), 9) AS p_value
FROM t JOIN d USING (nation) GROUP BY t.nation, t.n1, t.n2, t.u""")
def mannwhitney_exact(spark, d):
    """Balances of odd and even suppliers of each nation: samples small enough for the exact
    distribution (the SQL lists every subset)."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_acctbal", (F.col("s_suppkey") % 2).alias("side"))
    out = H.mann_whitney(s, ["nation"], "side", "s_acctbal", 1, 0, exact=400).where("n1 > 0 and n2 > 0")
    return rounded(out.select("nation", "n1", "n2", "u", "p_value"), {"p_value": 9})
