"""Boosting of rows at hand: the sums of a round come from the rows of its nodes, which are kept."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import boosting
from millrace.operators.boosting import Rounds


@pytest.mark.parametrize("how", [Rounds(6, 0.3, leaves=7, min_leaf=3), Rounds(6, 0.3, depth=3)])
@pytest.mark.parametrize("weighted", [False, True])
def test_rows_are_told_what_the_trees_say(monkeypatch, how, weighted):
    draw = np.random.default_rng(5)
    bins = draw.integers(0, 20, (500, 3)).astype(np.uint8)
    y, w = bins[:, 0] * (bins[:, 1] > 9) + draw.normal(size=500), draw.choice([0.35, 1.0], 500) if weighted else np.ones(500)
    roots, grow = [], boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda how, counted, root: (roots.append(root), grow(how, counted, root))[1])
    trees = list(boosting.boost_rows(bins, y, w, how))
    for i, root in enumerate(roots):
        rest = y - boosting.told(trees[:i], bins, how.step)
        assert np.allclose(root, boosting.histogram(bins.astype(np.int32), w, w * rest))


def test_half_a_million_rows_are_boosted_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(boosting, "boost_table", None)
    x = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: (F.col("id") % (i + 1)).cast("double"))
    rows = spark.range(480_000).select(array_to_vector(x).alias("features"), (F.col("id") % 2).cast("double").alias("label"))
    model = boosting.fit_boosted(rows, Rounds(2, 1.0, leaves=2))
    assert {r[0] for r in model.transform(rows.limit(20)).select(F.round("prediction", 6)).collect()} == {0.0, 1.0}
