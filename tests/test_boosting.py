"""Leaf-wise boosting against an exhaustive best-first search, passes over a table against rows at hand."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from millrace.operators import boosting, models
from millrace.operators.boosting import Boosted, Rounds
from millrace.operators.models import Boosting


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(18)
    x = np.stack([draw.integers(0, 20, 500), draw.integers(0, 6, 500), np.round(draw.normal(size=500), 1)], 1).astype(float)
    return x, x[:, 0] * (x[:, 1] > 2) + 2 * x[:, 2] + draw.normal(size=500), draw.choice([0.35, 0.65, 1.0], 500)


@pytest.fixture(scope="module")
def frame(spark, rows):
    data = [(i, Vectors.dense(v), float(y), float(w)) for i, (v, y, w) in enumerate(zip(*rows))]
    return spark.createDataFrame(data, ["id", "features", "label", "weight"]).repartition(3, "id").cache()


def plain_rounds(bins, y, w, how):
    """Predictions of all rows after all rounds: each round splits, as long as it may, the leaf with the greatest gain of all cuts of all leaves."""
    said = np.zeros(len(y))
    for _ in range(how.rounds):
        rest = y - said

        def loss(mask):
            return float((w[mask] * (rest[mask] - np.average(rest[mask], weights=w[mask])) ** 2).sum())

        def best(mask, depth):
            out = None
            if depth < how.depth:
                for f in range(bins.shape[1]):
                    for b in np.unique(bins[mask, f])[:-1]:
                        left, right = mask & (bins[:, f] <= b), mask & (bins[:, f] > b)
                        if min(left.sum(), right.sum()) >= how.min_leaf:
                            gain = loss(mask) - loss(left) - loss(right)
                            if gain > 1e-9 and (out is None or gain > out[0] + 1e-9):
                                out = (gain, left, right)
            return out

        whole = np.ones(len(y), bool)
        leaves = [(whole, 0, best(whole, 0))]
        for _ in range(how.splits):
            at = max((i for i, x in enumerate(leaves) if x[2]), key=lambda i: leaves[i][2][0], default=None)
            if at is None:
                break
            _, depth, (_, left, right) = leaves.pop(at)
            leaves += [(m, depth + 1, best(m, depth + 1)) for m in (left, right)]
        for mask, _, _ in leaves:
            said[mask] += how.step * (np.average(rest[mask], weights=w[mask]) if len(leaves) > 1 else 0.0)
    return said


@pytest.mark.parametrize("how", [Rounds(3, 0.5, leaves=9, depth=4, min_leaf=5), Rounds(2, 0.5, depth=3), Rounds(2, 1.0, leaves=25, min_leaf=2)])
def test_same_as_the_exhaustive_best_first_search(rows, how):
    x, y, w = rows
    y = y - np.average(y, weights=w)
    bins = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], 1).astype(np.uint8)
    trees = list(boosting.boost_rows(bins, y, w, how))
    assert all((t["feature"] < 0).sum() <= how.splits + 1 for t in trees)
    assert boosting.told(trees, bins, how.step) == pytest.approx(plain_rounds(bins, y, w, how), abs=1e-8)


def test_passes_over_a_table_grow_the_same_trees(frame, monkeypatch):
    how = Rounds(5, 0.3, leaves=8, depth=5, min_leaf=3)
    whole = boosting.fit_boosted(frame, how, "weight")
    monkeypatch.setattr(boosting, "TASK_CELLS", 10)
    monkeypatch.setattr(boosting, "CHAIN", 2)
    parts = boosting.fit_boosted(frame, how, "weight")
    for a, b in zip(whole.trees, parts.trees, strict=True):
        assert (a["feature"] == b["feature"]).all() and (a["bin"] == b["bin"]).all() and a["value"] == pytest.approx(b["value"])


def test_model_learns_saves_and_loads(spark, frame, rows, tmp_path):
    model = models.fit_boosting(Boosting(60, 0.1, depth=15, leaves=12, min_leaf=5, weighted=True), frame, "weight")
    said = {r["id"]: r["prediction"] for r in model.transform(frame).collect()}
    rest = rows[1] - np.array([said[i] for i in range(len(rows[1]))])
    assert rest.var() < 0.15 * rows[1].var() and sum(model.featureImportances) == pytest.approx(1)
    model.save(spark, str(tmp_path))
    again = Boosted.load(spark, str(tmp_path)).copy().setPredictionCol("again").transform(frame)
    assert {r["id"]: r["again"] for r in again.collect()} == said


def test_edges_of_input(frame):
    with pytest.raises(ValueError, match="no training rows"):
        boosting.fit_boosted(frame.limit(0), Rounds(2))
    one = frame.limit(1)
    assert boosting.fit_boosted(one, Rounds(2)).transform(one).first()["prediction"] == pytest.approx(one.first()["label"])
