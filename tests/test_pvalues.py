import math

import pytest

from shelfscope.functions import pvalues as pv


@pytest.mark.parametrize("t,df,expected", [(2.0, 10, 0.0733880347707), (1.0, 1, 0.5), (0.0, 5, 1.0),
                                           (3.5, 30, 0.0014768074)])
def test_t_two_sided_textbook(t, df, expected):
    assert pv.t_two_sided(t, df) == pytest.approx(expected, rel=1e-5)


def test_t_ppf_inverts_cdf():
    for df in (2, 7.5, 40):
        for p in (0.025, 0.5, 0.9, 0.975):
            assert pv.t_cdf(pv.t_ppf(p, df), df) == pytest.approx(p, abs=1e-10)
    assert pv.t_ppf(0.975, 10) == pytest.approx(2.228138851986273, rel=1e-9)


def test_f_sf_closed_form():
    # d1 = 2: P(F > f) = (1 + 2 f / d2) ** (-d2 / 2)
    for f, d2 in ((3.0, 20), (0.5, 7), (10.0, 3)):
        assert pv.f_sf(f, 2, d2) == pytest.approx((1 + 2 * f / d2) ** (-d2 / 2), rel=1e-10)


def test_normal_and_missing_inputs():
    assert pv.norm_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-12)
    assert pv.t_two_sided(float("nan"), 5) is None
    assert pv.f_sf(None, 1, 2) is None
    assert pv.t_two_sided(math.inf, 5) == 0.0


def test_against_jvm_commons_math(spark):
    try:
        jdist = spark._jvm.org.apache.commons.math3.distribution
        t = jdist.TDistribution(12.0)
        f = jdist.FDistribution(3.0, 40.0)
    except Exception:  # noqa: BLE001
        pytest.skip("commons-math3 not reachable")
    assert pv.t_cdf(1.7, 12) == pytest.approx(t.cumulativeProbability(1.7), rel=1e-9)
    assert pv.f_sf(2.5, 3, 40) == pytest.approx(1 - f.cumulativeProbability(2.5), rel=1e-8)


def test_large_degrees_of_freedom():
    """Student t tends to the normal and F to the chi-square, without losing digits on the way."""
    normal = math.erfc(2 / math.sqrt(2))
    for df in (9_999.0, 10_001.0, 1e6, 1e10, 6e11):
        first_order = normal + 2 * (2 ** 3 + 2) / (4 * df) * math.exp(-2) / math.sqrt(2 * math.pi)
        assert pv.t_two_sided(2.0, df) == pytest.approx(first_order, rel=1e-7)
        assert pv.t_two_sided(0.01, df) == pytest.approx(math.erfc(0.01 / math.sqrt(2)), rel=1e-5)
    assert pv.t_two_sided(2.0, 10_000.0) == pytest.approx(pv.t_two_sided(2.0, 10_000.0001), rel=1e-9)  # both sides of the switch
    for d2 in (1e8, 1e10, 1e12):
        assert pv.f_sf(3.0, 4, d2) == pytest.approx(math.exp(-6) * 7, rel=1e-6)
    assert pv.f_sf(30.0, 4, 1e10) == pytest.approx(math.exp(-60) * 61, abs=1e-15)


def test_fraction_must_converge(monkeypatch):
    monkeypatch.setattr(pv, "_EPS", 0.0)
    with pytest.raises(ArithmeticError):
        pv.betainc(3.3, 2.2, 0.3)
