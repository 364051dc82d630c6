import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.functions.probability import chi2_tail, student_tail
from remitlens.plans import forecast, hypotheses
from tests.conftest import day


def test_corrected_chi_square_of_a_published_table(spark):
    df = spark.createDataFrame(
        [(True, True, 4994), (True, False, 2639), (False, True, 15087), (False, False, 72879)],
        "late boolean, bad boolean, n long",
    )
    row = hypotheses.chi2_2x2(df, F.col("late"), F.col("bad"), F.col("n")).first()
    assert row.chi2 == pytest.approx(9861.727157, abs=1e-6)
    assert row.p_value == 0.0


def test_chi_square_needs_both_margins(spark):
    df = spark.createDataFrame([(True, True), (True, False)], "a boolean, b boolean")
    row = hypotheses.chi2_2x2(df, F.col("a"), F.col("b")).first()
    assert (row.chi2, row.p_value) == (None, None) or math.isnan(row.p_value)


def test_tails():
    assert chi2_tail(3.841458820694124) == pytest.approx(0.05, rel=1e-9)
    # Table values of Student's t.
    assert student_tail(1.812461, 10) == pytest.approx(0.05, rel=1e-5)
    assert student_tail(2.763769, 10) == pytest.approx(0.01, rel=1e-5)
    assert student_tail(0.0, 4) == 0.5
    assert student_tail(-1.812461, 10) == pytest.approx(0.95, rel=1e-6)
    # One degree of freedom is the Cauchy distribution.
    assert student_tail(3.0, 1) == pytest.approx(0.5 - math.atan(3.0) / math.pi, rel=1e-12)
    assert 0 < student_tail(41.2, 1200) < 1e-200


@pytest.mark.parametrize("t", [0.01, 1.0, 5.0, 20.0, -3.0])
def test_tails_with_many_degrees_of_freedom(t):
    normal = 0.5 * math.erfc(t / math.sqrt(2))
    for df in (1e11, 1e13, 1e14):
        assert student_tail(t, df) == pytest.approx(normal, rel=1e-6)
    # Both ways of computing agree where one takes over from the other.
    assert student_tail(t, 99_999.0) == pytest.approx(student_tail(t, 100_000.0), rel=2e-3 if t == 20 else 1e-4)


def test_welch_from_folded_moments(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(6)), float(rng.normal(5, 2))) for _ in range(400)] + [(7, 1.0), (8, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    group = F.col("k").isin(1, 4, 7)
    whole = hypotheses.welch(df, F.col("x"), group).first()
    folded = hypotheses.welch_of_moments(hypotheses.folded_moments(df, F.col("x"), ["k"]), group).first()
    for name in ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df", "p_value"):
        assert folded[name] == pytest.approx(whole[name], rel=1e-9), name


def test_welch_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(1.0, 2.0, 40), rng.normal(0.2, 0.7, 90)
    df = spark.createDataFrame([(float(x), True) for x in a] + [(float(x), False) for x in b], "x double, g boolean")
    row = hypotheses.welch(df, F.col("x"), F.col("g")).first()
    ea, eb = a.var(ddof=1) / 40, b.var(ddof=1) / 90
    assert row.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(ea + eb))
    assert row.df == pytest.approx((ea + eb) ** 2 / (ea**2 / 39 + eb**2 / 89))
    assert row.p_value == pytest.approx(student_tail(row.t, row.df))


def test_ridge_against_the_penalised_normal_equations(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(100_000, 20_000, 15)
    fest = np.array([0, 0, 1, 1] + [0] * 11)
    rows = [(day(7 * i), float(y[i]), int(fest[i]), i) for i in range(15)]
    series = spark.createDataFrame(rows, "wk date, leakage_rs double, fest int, t int")
    x = np.column_stack([np.arange(15), fest]).astype(float)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
    fit = forecast.ridge_fit(series).first()
    assert (fit.coef_t, fit.coef_fest) == pytest.approx(tuple(beta))
    assert fit.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ beta)
    assert fit.r2 == pytest.approx(1 - ((yc - xc @ beta) ** 2).sum() / (yc**2).sum())
    ahead = forecast.ridge_forecast(series).orderBy("wk").collect()
    assert [r.wk for r in ahead] == [day(7 * (14 + i)) for i in range(1, 5)]
    assert [r.leakage_rs for r in ahead] == [float(np.round(fit.intercept + fit.coef_t * (14 + i))) for i in range(1, 5)]
    assert forecast.actual_and_forecast(series).where("forecast").count() == 4
