"""Tables of a bounded size: every task is given the whole table, and nothing changes."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from millrace.operators import forest
from millrace.operators.forest import UNLIMITED, Cell, Spec


@pytest.fixture(scope="module")
def frame(spark):
    draw = np.random.default_rng(3)
    x = np.stack([draw.integers(0, 9, 300), draw.integers(0, 4, 300)], 1).astype(float)
    y = np.round(x[:, 0] + draw.normal(size=300), 1)
    data = [(i, Vectors.dense(v), float(t), float(u), i % 3) for i, (v, t, u) in enumerate(zip(x, y, draw.choice([0.35, 1.0], 300)))]
    return spark.createDataFrame(data, ["id", "features", "label", "weight", "fold"]).repartition(3, "id").cache()


def totals(grown, table, cells, squares=False):
    return {r["row"]: [x for c in r[1:] for x in c] for r in grown.sums(table, cells, squares).collect()}


def test_a_held_table_is_not_dealt(frame, monkeypatch):
    table, cells = forest.bin_table(frame, weight="weight", fold="fold"), [Cell(0, 3, 2), Cell(1, 4)]
    specs = [Spec(3, min_leaf=2), Spec(4, tried=1, without_fold=1)]
    with monkeypatch.context() as never:
        never.setattr(forest, "_dealt", None)
        never.setattr(forest.Grown, "_sums_of_dealt", None)
        whole = forest.grow_forests(table, specs)
        a = totals(whole, table, cells, True)
    monkeypatch.setattr(forest, "HELD_BYTES", 0)
    dealt = forest.grow_forests(table, specs)
    b = totals(dealt, table, cells, True)
    assert len(a) == 300 and all(a[k] == pytest.approx(b[k]) for k in b) and a.keys() == b.keys()
    assert list(whole.importance(cells[0])) == pytest.approx(list(dealt.importance(cells[0])))


def test_cross_predictions_need_no_kept_trees(frame, monkeypatch):
    table = forest.bin_table(frame, weight="weight", fold="fold")
    asked = [Spec(4), Spec(4, min_leaf=5)], [(0, 2, 3), (0, 4, UNLIMITED), (1, 4, 4)], 3

    def rows():
        return sorted((r["fold"], r["label"], *np.round(r["predictions"], 9)) for r in forest.cross_predictions(table, *asked).collect())

    with monkeypatch.context() as never:
        never.setattr(forest, "grow_forests", None)
        a = rows()
    monkeypatch.setattr(forest, "HELD_BYTES", 0)
    assert np.array(a) == pytest.approx(np.array(rows()))


def test_trees_that_drew_no_row_say_the_mean(spark):
    one = spark.createDataFrame([(Vectors.dense([1.0]), 3.0)], ["features", "label"])
    assert forest.fit_deep_forest(one, Spec(12)).transform(one).first()["prediction"] == pytest.approx(3.0)
