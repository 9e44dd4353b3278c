"""Two-phase forests against a plain recursive tree, shared forests against forests of their own."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import explain, forest, metrics, models, split, tuning
from millrace.operators.forest import UNLIMITED, Cell, DeepForest, Spec
from millrace.operators.models import FORESTS, Forest
from millrace.plans import experiments
from millrace.plans.experiments import make_holdout

FEATURES = ["a", "b", "c"]


def plain_tree(bins, y, w, min_leaf, depth, level=0):
    """Nested (value, feature, bin, left, right) by trying every cut."""
    value = float(np.average(y, weights=w))
    if level >= depth or len(y) < 2 or y.min() == y.max():
        return (value,)

    def loss(mask):
        return float((w[mask] * (y[mask] - np.average(y[mask], weights=w[mask])) ** 2).sum())

    best = None
    for f in range(bins.shape[1]):
        for b in np.unique(bins[:, f])[:-1]:
            mask = bins[:, f] <= b
            if min(mask.sum(), (~mask).sum()) >= min_leaf:
                found = loss(mask) + loss(~mask)
                if best is None or found < best[0] - 1e-9 * max(1.0, abs(best[0])):
                    best = (found, f, b, mask)
    if best is None:
        return (value,)
    _, f, b, mask = best
    return (value, f, b, plain_tree(bins[mask], y[mask], w[mask], min_leaf, depth, level + 1), plain_tree(bins[~mask], y[~mask], w[~mask], min_leaf, depth, level + 1))


def plain_value(tree, row):
    while len(tree) > 1:
        tree = tree[3] if row[tree[1]] <= tree[2] else tree[4]
    return tree[0]


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(8)
    x = np.stack([draw.integers(0, 12, 400), draw.integers(0, 5, 400), np.round(draw.normal(size=400), 1)], 1).astype(float)
    y = x[:, 0] * (x[:, 1] > 2) + 2 * x[:, 2] + draw.normal(size=400)
    return x, y, draw.choice([0.35, 0.65, 1.0], 400)


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, w = rows
    data = [(i, Vectors.dense(v), float(t), float(u), i % 3, *map(float, v)) for i, (v, t, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(data, ["id", "features", "label", "weight", "fold", *FEATURES]).repartition(3, "id").cache()


def predictions(model, frame):
    return {r["id"]: r["prediction"] for r in model.transform(frame).select("id", "prediction").collect()}


@pytest.mark.parametrize(("min_leaf", "depth"), [(1, 50), (2, 4), (7, 50), (1, 0)])
def test_grown_tree_is_the_plain_tree(rows, min_leaf, depth):
    x, y, w = rows
    bins = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], 1).astype(np.uint8)
    tree = forest.grow(bins, y, w, min_leaf, depth, 0, np.uint64(1))
    plain = plain_tree(bins, y, w, min_leaf, depth)
    got = forest._read(tree, bins, [UNLIMITED])[:, 0]
    assert got == pytest.approx([plain_value(plain, r) for r in bins])


def test_forest_equals_plain_trees_on_the_drawn_rows(spark, frame, rows):
    """The means of plain trees on the same Poisson draws, with weights."""
    spec = Spec(5, min_leaf=2)
    model = forest.fit_deep_forest(frame, spec, "weight")
    table = forest.bin_table(frame, weight="weight")
    blocks = [(np.frombuffer(r["row"], np.int64), np.frombuffer(r["bins"], np.uint8).reshape(-1, 3), np.frombuffer(r["y"]), np.frombuffer(r["w"])) for r in table.blocks.orderBy("part", "number").collect()]
    row, bins, y, w = (np.concatenate(c) for c in zip(*blocks))
    ids = {r["__row"]: r["id"] for r in table.rows.select("__row", "id").collect()}
    want = np.zeros(len(row))
    for t in range(5):
        count = forest.drawn(row, forest._seed_of(spec, t))
        inside = count > 0
        tree = plain_tree(bins[inside], y[inside], (w * count)[inside], 2, 99)
        want += [plain_value(tree, b) for b in bins]
    want = dict(zip([ids[r] for r in row.tolist()], want / 5 + table.middle))
    assert predictions(model, frame) == pytest.approx(want)


@pytest.mark.parametrize("tried", [0, 2])
def test_growing_on_the_cluster_first_changes_nothing(frame, monkeypatch, tried):
    spec = Spec(4, min_leaf=2, tried=tried)
    whole = forest.fit_deep_forest(frame, spec)
    monkeypatch.setattr(forest, "TASK_CELLS", 90)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", 3)
    parts = forest.fit_deep_forest(frame, spec)
    assert len(parts.grown.tops[0].feature) > 5
    assert predictions(whole, frame) == pytest.approx(predictions(parts, frame))
    assert list(whole.featureImportances) == pytest.approx(list(parts.featureImportances)) and sum(whole.featureImportances) == pytest.approx(1)
    for depth in (1, 4):
        a, b = (DeepForest(m.grown, Cell(0, 3, depth)) for m in (whole, parts))
        assert predictions(a, frame) == pytest.approx(predictions(b, frame))
        assert list(a.featureImportances) == pytest.approx(list(b.featureImportances))


def test_fewer_trees_and_levels_are_read_off(frame):
    big = forest.fit_deep_forest(frame, Spec(6)).grown
    for trees, depth in ((2, UNLIMITED), (6, 3), (4, 5)):
        own = forest.fit_deep_forest(frame, Spec(trees, depth=depth))
        assert predictions(own, frame) == pytest.approx(predictions(DeepForest(big, Cell(0, trees, depth)), frame))


def test_shared_grid_equals_single_fits(frame):
    grid = {"numTrees": [3, 5], "maxDepth": [2, None], "minInstancesPerNode": [1, 4]}
    found = tuning.shared_grid_search(frame, Spec(5), grid, folds=3, weight="weight")
    table = {(r["numTrees"], r["maxDepth"], r["minInstancesPerNode"]): (r["mse"], r["mse_std"]) for r in found.table.collect()}
    assert len(table) == 8 and found.leaders(3).count() == 3
    for (trees, depth, leaf), scores in table.items():
        if trees == 3:
            spec = Spec(3, int(leaf), depth=UNLIMITED if depth is None else int(depth))
            # the draws go by the row's number, so a single fit leaves the fold out as the shared one does
            single = forest.cross_predictions(forest.bin_table(frame, weight="weight", fold="fold"), [spec], [(0, 3, spec.depth)], 3)
            assert tuning._fold_scores(single, 1, "mse")[0] == pytest.approx(scores)
    at = min(table, key=table.get)
    assert (found.best["numTrees"], found.best["maxDepth"], found.best["minInstancesPerNode"]) == at
    folds = forest.cross_predictions(forest.bin_table(frame, fold="fold"), [Spec(2)], [(0, 2, UNLIMITED)], 3)
    assert folds.count() == frame.count()


def test_saved_forest_predicts_the_same(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "TASK_CELLS", 90)
    model = forest.fit_deep_forest(frame, Spec(3), "weight")
    model.save(str(tmp_path))
    again = DeepForest.load(spark, str(tmp_path))
    assert predictions(model, frame) == predictions(again, frame)
    assert list(again.featureImportances) == pytest.approx(list(model.featureImportances))


def test_disagreement_of_the_trees(frame):
    model = forest.fit_deep_forest(frame, Spec(4))
    each = [predictions(DeepForest(forest.Grown([Spec(4)], model.grown.edges, model.grown.middle, model.grown.tops, model.grown.subtrees), Cell(0, n)), frame) for n in (1, 2, 3)]
    single = [each[0], {k: 2 * each[1][k] - each[0][k] for k in each[0]}, {k: 3 * each[2][k] - 2 * each[1][k] for k in each[0]}]
    want = {k: float(np.std([s[k] for s in single])) for k in each[0]}
    got = {r["id"]: r["tree_std"] for r in explain.tree_disagreement(model, frame, 3, ["id"]).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_classifier_and_edges_of_input(spark, frame):
    flags = frame.withColumn("label", (F.col("label") > 3).cast("double"))
    model = models.fit_forest(Forest(15, subset="sqrt"), flags, classifier=True)
    got = model.copy().setPredictionCol("said").transform(flags)
    assert {r["said"] for r in got.select("said").distinct().collect()} == {0.0, 1.0}
    assert metrics.classification_metrics(got, "label", "said").first()["accuracy"] > 0.9
    with pytest.raises(ValueError, match="0 and 1"):
        models.fit_forest(Forest(2), frame, classifier=True)
    with pytest.raises(ValueError, match="no training rows"):
        models.fit_forest(Forest(2), frame.limit(0))
    one = frame.limit(1)
    assert predictions(models.fit_forest(Forest(20), one), one) == pytest.approx({r["id"]: r["label"] for r in one.collect()})
    same = frame.withColumn("label", F.lit(2.5))
    assert set(predictions(models.fit_forest(Forest(2), same), same).values()) == {2.5}


def test_many_values_are_binned_by_rank(spark):
    wide = spark.range(5000).select(F.col("id"), F.array((F.col("id") * 7919 % 5003).cast("double"), F.lit(1.0)).alias("x"))
    from pyspark.ml.functions import array_to_vector

    wide = wide.select("id", array_to_vector("x").alias("features"), F.col("x")[0].alias("label"))
    edges = forest.fit_edges(wide, "features", 2)
    assert len(edges[0]) <= forest.BINS - 1 and len(edges[0]) > 200 and edges[1] == []
    assert max(np.diff(edges[0])) < 5003 / 100


def test_presets_run_deep_in_the_experiments(spark, frame):
    """Small numbers of trees, the rest as in the presets: every experiment takes the two-phase forest."""
    small = {n: Forest(3, depth=p.depth, min_leaf=p.min_leaf, subset=p.subset, weighted=p.weighted) for n, p in FORESTS.items()}
    kind = F.when(F.col("id") % 10 == 0, "valid").when(F.col("id") % 17 == 0, "suspicious").otherwise("normal")
    table = frame.select(F.col("id").alias("obs_id"), *FEATURES, F.col("label").alias("delay_min"), kind.alias("outlier_type"))
    h = make_holdout(table, names=FEATURES)
    done = experiments.final_training(h, small["final"])
    assert isinstance(done.model, DeepForest) and done.importances.count() == 3
    tuned = experiments.tune(h, {"numTrees": [2, 3], "minInstancesPerNode": [2, 5]}, small["baseline"], cv_folds=2)
    assert tuned.search.leaders().count() == 4 and tuned.cv.count() == 2
    gap, _ = experiments.regularised(h, small["baseline"], small["regularised"], folds=2)
    assert gap.count() == 2
    told = experiments.explained(h, small["baseline"], 2)
    assert told.uncertain.count() == 5 and told.importances.first()["importance"] > 0.3
    out = experiments.outlier_experiment(h, small["experiment"])
    assert out.metrics.count() == 2
    s = make_holdout(table, names=FEATURES, stratified=True)
    both = experiments.single_vs_dual(s, small["single"], small["classifier"], context=FEATURES)
    assert both.routes.groupBy().sum("n").first()[0] == s.test.count()
    assert split.with_fold(h.train, "obs_id", 3).count() == h.train.count()
