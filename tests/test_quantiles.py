import numpy as np
import pytest

from millrace.operators.quantiles import Rank, order_stats, quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    n = 20_000
    heavy = np.where(rng.random(n) < 0.34, 5.0, rng.exponential(3.0, n) ** 3)
    flat = rng.integers(0, 4, n).astype(float)
    group = np.where(rng.random(n) < 0.9, "a", "b")
    rows = [(g, float(x), None if i % 50 == 0 else float(y)) for i, (g, x, y) in enumerate(zip(group, heavy, flat))]
    return spark.createDataFrame(rows, "grp string, x double, y double").repartition(6).cache(), group, heavy, flat


def expected(values):
    return {p: float(np.quantile(values, p)) for p in PROBS}


@pytest.mark.parametrize("sortable,grid", [(250_000, 4000), (300, 50), (3, 20)])
def test_matches_numpy_at_every_bracket_size(table, sortable, grid):
    df, _, heavy, flat = table
    got = quantiles(df, {"x": PROBS, "y": PROBS}, sortable=sortable, grid=grid)
    keep = np.arange(len(flat)) % 50 != 0
    assert got["x"] == pytest.approx(expected(heavy), rel=1e-12)
    assert got["y"] == pytest.approx(expected(flat[keep]), rel=1e-12)


@pytest.mark.parametrize("sortable,grid", [(250_000, 4000), (200, 40)])
def test_grouped(table, sortable, grid):
    df, group, heavy, _ = table
    got = order_stats(df, {"x": PROBS}, by=["grp"], sortable=sortable, grid=grid)
    for g in ("a", "b"):
        want = expected(heavy[group == g])
        assert {r.p: s.value for r, s in got[(g,)]["x"].items()} == pytest.approx(want, rel=1e-12)


def test_quantile_of_clipped_column(table):
    df, _, heavy, _ = table
    ps = [0.01, 0.25, 0.75, 0.99]
    stats = order_stats(df, {"x": ps})[()]["x"]
    low, high = stats[Rank(0.01)].value, stats[Rank(0.99)].value
    clipped = np.clip(heavy, low, high)
    for p in ps:
        assert stats[Rank(p)].clipped(low, high) == pytest.approx(np.quantile(clipped, p), rel=1e-12)


def test_ceil_rank_null_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,), (float("nan"),)], "x double")
    stat = order_stats(df, {"x": [Rank(0.25, interpolated=False)]})[()]["x"][Rank(0.25, interpolated=False)]
    assert stat.value == 2.0 and stat.n == 10
    assert quantiles(df.where("x > 100 and not isnan(x)"), {"x": [0.5]})["x"][0.5] is None
