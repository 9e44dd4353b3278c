"""Identities of published result figures that must come out of the operators without the input data."""

import math

import pytest

from millrace.operators import explain, metrics
from millrace.operators.clean import Fence
from millrace.operators.quantiles import Rank
from millrace.operators.select import kept_features
from millrace.operators.tuning import combinations


def test_fence_from_published_quartiles():
    f = Fence.around(-1.63, 0.55)
    assert (f.low, f.high) == pytest.approx((-4.9, 3.82))


def test_hold_out_size_and_kept_features():
    assert Rank(0.2, interpolated=False).position(32_070)[0] + 1 == 6_414 == math.ceil(0.2 * 32_070)
    assert kept_features(62) == 43


def test_interaction_products(spark):
    # importances whose pair products are published: 0.107606, 0.025676, 0.024577, 0.024557, 0.008967
    a, b = 0.55498, 0.193892
    values = {"class": a, "sin": b, "speed": 0.025676 / 0.55498, "cos": 0.024577 / 0.55498, "temp": 0.024557 / 0.55498}
    df = spark.createDataFrame(list(values.items()), "feature string, importance double")
    got = [r["score"] for r in explain.interaction_pairs(df).collect()]
    assert got == pytest.approx([0.107606, 0.025676, 0.024577, 0.024557, 0.008967], abs=1e-5)
    assert len(explain.interaction_pairs(df, k=100).collect()) == 10


def test_improvement_signs(spark):
    base = spark.createDataFrame([(0.3386, 0.5483, 0.9646)], "mae double, rmse double, r2 double")
    new = spark.createDataFrame([(0.4003, 0.6014, 0.9575)], "mae double, rmse double, r2 double")
    row = metrics.improvement(base, new).first()
    assert round(row["rmse_improvement_pct"], 2) == -9.68 and round(row["r2_improvement_pct"], 2) == -0.74
    assert row["mae_delta"] == pytest.approx(-0.0617)


def test_grid_size():
    assert combinations({"trees": [450, 600, 800], "depth": [20, 30, None], "leaf": [2, 5]}) == 18
