"""Published table values, deep tails and identities between the distributions."""

import math

import numpy as np
import pytest

from lanewise.functions import tails


@pytest.mark.parametrize("x, df, p", [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05),
    (18.307038053275146, 10, 0.05), (6.6348966010212145, 1, 0.01),
])
def test_chi2_table(x, df, p):
    assert tails.chi2_upper(x, df) == pytest.approx(p, rel=1e-10)


def test_chi2_two_degrees_is_exponential_far_out():
    for x in (1.0, 50.0, 630.0, 1300.0):
        assert tails.chi2_upper(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-11)


def test_chi2_one_degree_is_squared_normal():
    for z in (0.1, 1.959963984540054, 8.0, 24.9):
        assert tails.chi2_upper(z * z, 1) == pytest.approx(tails.normal_two_sided(z), rel=1e-10)
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert 0 < tails.normal_two_sided(24.9) < 1e-136


@pytest.mark.parametrize("t, df, p", [
    (12.706204736432095, 1, 0.05), (2.2281388519649385, 10, 0.05), (1.959963984540054, 1e9, 0.05),
])
def test_t_table(t, df, p):
    assert tails.t_two_sided(t, df) == pytest.approx(p, rel=1e-7)
    assert tails.t_quantile_two_sided(1 - p, df) == pytest.approx(t, rel=1e-7)


def test_f_with_one_numerator_degree_is_squared_t():
    for t, df in ((0.3, 4), (2.5, 30), (9.0, 500)):
        assert tails.f_upper(t * t, 1, df) == pytest.approx(tails.t_two_sided(t, df), rel=1e-9)
    assert tails.f_upper(3.8379, 2, 27) == pytest.approx(0.034, abs=5e-4)


def test_large_degrees_approach_their_limits():
    for df in (1e5, 1e7, 1e10, 1e13):
        for t in (0.5, 1.9, 3.0, 12.0):
            # The normal deviate with the same tail, up to terms of order df ** -2.
            z = math.sqrt(df * math.log1p(t * t / df)) * (8 * df + 1) / (8 * df + 3)
            assert tails.t_two_sided(t, df) == pytest.approx(
                tails.normal_two_sided(z), rel=1e-8 + 100 / df**2)
            ratio = (df + 7 / 2 - 1) * math.log1p(7 * t / df)
            assert tails.f_upper(t, 7, df) == pytest.approx(
                tails.chi2_upper(ratio, 7), rel=1e-8 + 1000 / df**2)


@pytest.mark.parametrize("df", [40, 1e4, 1e8, 1e11])
def test_chi2_of_many_degrees(df):
    """Wilson and Hilferty's normal deviate, which gets better with the degrees."""
    for z in (-1.5, 0.0, 2.0):
        root = 1 - 2 / (9 * df) + z * math.sqrt(2 / (9 * df))
        upper = math.erfc(z / math.sqrt(2)) / 2
        assert tails.chi2_upper(df * root**3, df) == pytest.approx(upper, rel=0.05 / math.sqrt(df))


@pytest.mark.parametrize("n, rate", [(50, 0.3), (10**6, 0.01), (10**9, 0.01), (10**10, 0.01)])
def test_binomial_of_any_size(n, rate):
    """Against all terms, by their ratios, divided by their sum."""
    deviation = math.sqrt(n * rate * (1 - rate))
    mode = int(n * rate)
    reach = int(12 * deviation) + 2
    up = np.arange(mode, min(n, mode + reach))
    down = np.arange(mode, max(0, mode - reach), -1)
    ups = np.cumprod((n - up) / (up + 1) * rate / (1 - rate))
    downs = np.cumprod(down / (n - down + 1) * (1 - rate) / rate)
    terms = np.concatenate([downs[::-1], [1.0], ups])
    first = mode - len(downs)
    for shift in (-3, -1.5, 0, 2):
        hits = int(mode + shift * deviation)
        exact = terms[:hits - first + 1].sum() / terms.sum()
        assert tails.binomial_lower(hits, n, rate) == pytest.approx(exact, rel=1e-9)


def test_binomial_ends():
    assert tails.binomial_lower(-1, 5, 0.5) == 0 and tails.binomial_lower(5, 5, 0.5) == 1
    assert tails.binomial_lower(0, 3, 0.5) == pytest.approx(0.125, rel=1e-12)


def test_normal_tail_as_a_column(spark):
    values = [k / 64 for k in range(-2400, 2400, 7)] + [0.0, 37.0, 40.0, 1e308, math.inf, -math.inf]
    frame = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "z double")
    result = frame.select("z", tails.normal_p("z").alias("p"))
    for row in result.collect():
        if row.z is None or math.isnan(row.z):
            assert row.p is None
        else:
            exact = tails.normal_two_sided(row.z)
            assert row.p == pytest.approx(exact, rel=1e-12, abs=1e-300)
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ends():
    assert tails.chi2_upper(0, 3) == 1.0
    assert tails.t_two_sided(0, 5) == 1.0
    assert tails.t_two_sided(math.inf, 5) == 0.0
