"""Learners on a target with a known signal, neighbours against brute force, persistence."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from millrace.functions.columns import hash52
from millrace.operators import cluster, encode, explain, kernel, metrics, models, neighbors
from millrace.operators.models import BOOSTINGS, FORESTS
from millrace.plans import experiments
from millrace.plans.experiments import make_holdout
from millrace.plans.preprocess import prepare, report
from millrace.sources.observations import OBS_ROLES, obs

FEATURES = ["hour_sin", "hour_cos", "temperature", "wind", "is_rush_hour"]


@pytest.fixture(scope="module")
def signal(spark):
    h = F.pmod(F.col("obs_id") * 7, F.lit(24))
    angle = 2 * F.pi() * h / 24
    noise = (hash52("obs_id", 5) / F.lit(float(1 << 52)) - 0.5)
    df = spark.range(3000).select(
        F.col("id").alias("obs_id"), F.sin(2 * F.pi() * F.pmod(F.col("id") * 7, F.lit(24)) / 24).alias("hour_sin"),
        F.cos(2 * F.pi() * F.pmod(F.col("id") * 7, F.lit(24)) / 24).alias("hour_cos"),
        (F.pmod(F.col("id") * 13, F.lit(30)).cast("double")).alias("temperature"), F.pmod(F.col("id"), F.lit(11)).cast("double").alias("wind"))
    df = df.withColumn("is_rush_hour", (F.col("hour_sin") > 0.7).cast("int"))
    df = df.withColumn("delay_min", 3 * F.col("hour_sin") + 0.2 * F.col("temperature") + noise)
    kind = F.when(F.col("hour_sin") > 0.9, "valid").when(F.col("obs_id") % 50 == 0, "suspicious").otherwise("normal")
    return df.withColumn("outlier_type", kind).cache()


@pytest.fixture(scope="module")
def held(signal):
    return make_holdout(signal, names=FEATURES)


def r2(table):
    return table.first()["r2"]


def test_forest_boosting_kernel_find_the_signal(held):
    assert r2(held.metrics(held.forest(FORESTS["final"].scaled(10, 8)))) > 0.9
    assert r2(held.metrics(held.boosting(BOOSTINGS["comparison"].scaled(40, 5)))) > 0.7
    model = kernel.fit_kernel_regression(held.train, FEATURES, "delay_min", "sample_weight", size=128)
    assert r2(metrics.regression_metrics(model.transform(held.test), "delay_min", "prediction")) > 0.8


def test_voting_is_the_mean_of_its_members(held):
    a, b = held.forest(FORESTS["voting"].scaled(5, 5)), held.boosting(BOOSTINGS["voting"].scaled(5, 3))
    both = models.Voting((a, b)).transform(held.vectors(held.test)).select("obs_id", "prediction")
    one = held.scored(a).select("obs_id", F.col("prediction").alias("a")).join(held.scored(b).select("obs_id", F.col("prediction").alias("b")), "obs_id")
    worst = both.join(one, "obs_id").agg(F.max(F.abs(F.col("prediction") - (F.col("a") + F.col("b")) / 2))).first()[0]
    assert worst < 1e-9


def test_forest_is_the_mean_of_its_trees_and_importances_sum_to_one(spark, held):
    model = held.forest(FORESTS["single"].scaled(6, 5))
    assert explain.importances(spark, model, FEATURES).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    rows = held.vectors(held.test).limit(20).cache()
    whole = [r["prediction"] for r in model.transform(rows).orderBy("obs_id").collect()]
    trees = np.array([[r["prediction"] for r in t.transform(rows).orderBy("obs_id").collect()] for t in model.trees])
    assert whole == pytest.approx(trees.mean(axis=0))
    spread = explain.tree_disagreement(model, rows, carry=["obs_id"]).orderBy("obs_id").collect()
    assert [r["tree_std"] for r in spread] == pytest.approx(trees.std(axis=0))


def test_saved_model_predicts_the_same(held, tmp_path):
    done = experiments.final_training(held, FORESTS["final"].scaled(5, 5))
    done.save(str(tmp_path))
    again = RandomForestRegressionModel.load(f"{tmp_path}/model")
    a = [r["prediction"] for r in held.scored(done.model).orderBy("obs_id").collect()]
    assert a == [r["prediction"] for r in held.scored(again).orderBy("obs_id").collect()]


def test_routed_models_score_every_row_once(signal):
    h = make_holdout(signal, names=FEATURES, stratified=True)
    both = experiments.single_vs_dual(h, FORESTS["single"].scaled(8, 6), FORESTS["classifier"].scaled(8, 6))
    rows = h.test.count()
    assert both.routes.agg(F.sum("n")).first()[0] == rows
    assert {r["model"]: r["n"] for r in both.comparison.collect()} == {"single": rows, "dual": rows}
    assert both.classifier.first()["recall"] > 0.5 and {r["predicted_class"] for r in both.routes.collect()} == {0, 1}
    assert min(r["r2"] for r in both.comparison.collect()) > 0.7


def test_no_leak_from_the_target_class(signal):
    with_class = signal.withColumn("target_class", F.lit(1))
    assert "target_class" not in encode.feature_columns(with_class)
    assert "target_class" in encode.feature_columns(with_class, include_label_features=True)


def test_clusters_keep_the_cheapest_run(held):
    found = cluster.fit_clusters(held.train, ["temperature", "wind"], k=3, restarts=3)
    singles = [cluster.fit_clusters(held.train, ["temperature", "wind"], k=3, restarts=1, seed=42 + i).cost for i in range(3)]
    assert found.cost == pytest.approx(min(singles))
    assert found.summary(held.train, "delay_min").agg(F.sum("n")).first()[0] == held.train.count()


def brute(train, queries, k):
    out = {}
    for qid, q in queries:
        d = sorted((float(np.sqrt(((np.array(q) - np.array(x)) ** 2).sum())), tid) for tid, x in train)
        out[qid] = [t for _, t in d[:k]]
    return out


@pytest.mark.parametrize("copies", [0, 400])
def test_neighbours_equal_brute_force_also_with_a_hot_vector(spark, monkeypatch, copies):
    monkeypatch.setattr(neighbors, "TRAIN_BLOCK", 40)
    monkeypatch.setattr(neighbors, "QUERY_BLOCK", 30)
    rng = np.random.default_rng(3)
    pts = [(i, *map(float, rng.integers(0, 12, 2)), float(rng.normal())) for i in range(600)]
    pts += [(600 + i, 3.0, 3.0, 0.5) for i in range(copies)]
    qs = [(i, *map(float, rng.uniform(-3, 15, 2)), 0.0) for i in range(80)] + [(80 + i, 3.0, 3.0, 0.5) for i in range(60)]
    schema = "id long, a double, b double, c double"
    train = spark.createDataFrame([(*p, float(p[0])) for p in pts], schema + ", y double")
    queries = spark.createDataFrame(qs, schema)
    got = {}
    for r in neighbors.knn_join(queries, train, ["a", "b", "c"], 7, "id", "id").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["train_id"])
    assert got == brute([(p[0], p[1:]) for p in pts], [(q[0], q[1:]) for q in qs], 7)


def test_neighbour_prediction_rules(spark):
    train = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, 20.0), (3, 1.0, 99.0), (4, 3.0, 5.0)], "id long, x double, y double")
    queries = spark.createDataFrame([(1, 0.0), (2, 2.0), (3, None)], "id long, x double")
    got = {r[0]: r[1] for r in neighbors.knn_predict(queries, train, ["x"], "y", "id", "id", k=3).collect()}
    assert got[1] == 15.0
    assert len(got) == 3 and got[3] is None
    # distances 1, 1 and 2 (the smaller id of the two at distance 2)
    assert got[2] == pytest.approx((99.0 + 5.0 + 10.0 / 2) / 2.5)
    few = neighbors.knn_join(queries, train, ["x"], 10, "id", "id")
    assert few.count() == 8


def test_outlier_experiment_and_tuning(held):
    done = experiments.outlier_experiment(held, FORESTS["experiment"].scaled(5, 5))
    row = done.removed.first()
    assert row["train_before"] - row["removed_total"] == row["train_after"]
    tuned = experiments.tune(held, {"maxDepth": [2, 6]}, FORESTS["baseline"].scaled(4, 3), parallelism=2, cv_folds=2)
    assert tuned.search.best == {"maxDepth": 6}
    assert tuned.search.leaders(1).count() == 1


def test_tournament(held):
    t = experiments.tournament(held, FORESTS["baseline"].scaled(4, 5), BOOSTINGS["comparison"].scaled(4, 3), neighbours=5, waves=32, restarts=1)
    names = [r["model"] for r in t.before.collect()]
    assert set(names) == {"forest", "boosting", "kernel", "neighbours"}
    assert t.after.count() == 4 and t.change.count() == 4


def test_report_covers_the_run(spark, sf_dir):
    p = prepare(obs(spark, sf_dir), OBS_ROLES, sample_n=900, one_hot=True)
    row = report(p).first()
    assert row["outlier_counts"]["total_rows"] == p.labelled.count() <= 900
    assert row["shape"]["original_rows"] == 900 and row["quality"]["total_missing"] == 0
    assert sum(r["n"] for r in row["hour_distribution_outliers"]) == row["outlier_counts"]["outlier_rows"]
    assert any(c.startswith("route_") for c in p.final.columns)
    skews = [abs(r["skewness"]) for r in row["skewness"]]
    shifts = [r["abs_delta"] for r in row["correlation_shift"]]
    routes = [(r["scope"], -r["mean_target"]) for r in row["top_routes"]]
    assert skews == sorted(skews, reverse=True) and shifts == sorted(shifts, reverse=True) and routes == sorted(routes)
