import math

import numpy as np

from statlake.functions import special
from tests.fixtures_solar import LJUNG_BOX_P, LJUNG_BOX_Q


def test_chi2_ljung_box_pair():
    assert math.isclose(float(special.chi2_sf(LJUNG_BOX_Q, 19)), LJUNG_BOX_P, rel_tol=1e-9)


def test_chi2_two_df_is_exponential():
    for x in (0.1, 1.0, 7.5, 30.0):
        assert math.isclose(float(special.chi2_sf(x, 2)), math.exp(-x / 2), rel_tol=1e-12)


def test_t_and_f_tails():
    assert math.isclose(float(special.t_two_sided(2.0, 10)), 0.0733880347707, rel_tol=1e-9)
    assert math.isclose(float(special.f_sf(3.0, 2, 20)), 0.0725381502864, rel_tol=1e-9)
    # F(1, d) tail equals the two-sided t tail of sqrt(F)
    assert math.isclose(float(special.f_sf(4.0, 1, 15)), float(special.t_two_sided(2.0, 15)), rel_tol=1e-9)


def test_normal_quantile_roundtrip():
    p = np.array([0.001, 0.025, 0.5, 0.9, 0.975])
    assert np.allclose(special.norm_cdf(special.norm_ppf(p)), p, atol=1e-12)
