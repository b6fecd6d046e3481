"""Distribution tails against published critical values and closed forms."""

import math

import pytest

from tilth.functions import stats as S


@pytest.mark.parametrize("f,d1,d2", [(3.0, 2, 10), (0.5, 2, 57), (12.0, 2, 300)])
def test_f_tail_matches_closed_form_for_two_numerator_df(f, d1, d2):
    closed = (d2 / (d2 + 2 * f)) ** (d2 / 2)
    assert S.f_sf(f, d1, d2) == pytest.approx(closed, rel=1e-10)


@pytest.mark.parametrize("x,df,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (9.487729, 4, 0.05),
                                    (18.307038, 10, 0.05), (6.634897, 1, 0.01)])
def test_chi2_critical_values(x, df, p):
    assert S.chi2_sf(x, df) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("t,df,p", [(2.228139, 10, 0.05), (1.959964, 1e9, 0.05), (2.570582, 5, 0.05),
                                    (3.169273, 10, 0.01)])
def test_two_sided_t_critical_values(t, df, p):
    assert S.t_sf2(t, df) == pytest.approx(p, abs=1e-6)


def test_f_critical_value_general_df():
    # F(3, 20) upper 5% point is 3.098391
    assert S.f_sf(3.098391, 3, 20) == pytest.approx(0.05, abs=1e-6)


def test_normal_two_sided():
    assert S.norm_sf2(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert S.norm_sf2(0.0) == pytest.approx(1.0)


def test_even_df_chi2_closed_form():
    for x in [0.5, 2.0, 7.5]:
        assert S.chi2_sf(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)


def test_bad_inputs_give_nan():
    assert math.isnan(S.f_sf(float("nan"), 2, 3))
    assert math.isnan(S.t_sf2(1.0, 0))


def test_pvalue_udfs_and_ks_series(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(5.991465, 2.0, 1.959964, 1.358099)], "x double, df double, z double, lam double")
    r = df.select(S.chi2_pvalue("x", "df").alias("c"), S.norm_pvalue("z").alias("n"),
                  S.ks_pvalue(F.col("lam")).alias("k")).first()
    assert r["c"] == pytest.approx(0.05, abs=1e-6)
    assert r["n"] == pytest.approx(0.05, abs=1e-6)
    assert r["k"] == pytest.approx(0.05, abs=1e-4)
