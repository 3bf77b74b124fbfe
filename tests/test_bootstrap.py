"""The bootstrap runs all surveyed draws."""

import os

import pytest

from pagliaio.plans.prose import ext_01


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_two_thousand_draws(spark):
    r = ext_01(spark, "/root/testdata/sf0.001").first()
    assert r.draws == 2000 and r.low < r.middle < r.high
