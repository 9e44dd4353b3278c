"""Hand-written edge tables: what must hold for gaps, ties, constants and empty groups."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import percent, sanitised
from millrace.operators import clean, encode, features, metrics, outliers, split, stats
from millrace.operators.clean import Fence
from millrace.operators.select import f_scores, fit_scaler, kept_features
from millrace.roles import Roles
from millrace.sources.tables import read_observations

NAN, INF = float("nan"), float("inf")


def test_flags_are_never_null_and_nan_is_null(spark):
    df = spark.createDataFrame([(None, 9.0), (NAN, NAN), (1.0, None), (0.0, 8.0), (NAN, 9.0)], "rain double, wind double")
    got = [r["is_bad_weather"] for r in features.derive_features(df).collect()]
    assert got == [1, 0, 1, 0, 1]


def test_non_finite_becomes_null(spark):
    df = spark.createDataFrame([(INF,), (-INF,), (NAN,), (1.5,)], "distance_km double")
    assert [r[0] for r in features.derive_features(df).collect()] == [None, None, None, 1.5]


def test_unreadable_time(spark):
    df = spark.createDataFrame([("bad",), (None,), ("2024-01-06 07:30:00",)], "timestamp string")
    rows = features.derive_features(df).collect()
    assert [(r["hour"], r["day_of_week"], r["is_weekend"], r["is_rush_hour"]) for r in rows] == [
        (None, None, 0, 0), (None, None, 0, 0), (7, 5, 1, 1)]


def test_zero_divisor_gives_null_ratio(spark):
    df = spark.createDataFrame([(3.0, -1e-5), (3.0, 0.0)], "distance_km double, duration_normal_min double")
    got = [r["speed_normal"] for r in features.derive_features(df).collect()]
    assert got[0] is None and got[1] == pytest.approx(3e5)


def test_target_bins(spark):
    df = spark.createDataFrame([(2.99,), (3.0,), (6.99,), (7.0,), (None,)], "delay_min double")
    out, name = features.with_target(df, "Classification")
    assert [r[name] for r in out.collect()] == ["Low", "Medium", "Medium", "High", None]
    with pytest.raises(ValueError):
        features.with_target(df, "ranking")
    with pytest.raises(ValueError):
        features.with_target(df.drop("delay_min"), "regression")


def test_constant_columns_and_constant_target(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None), (3, 5.0, None)], "a int, delay_min double, e double")
    df = df.withColumn("half", F.when(F.col("a") > 1, 1))
    assert clean.constant_columns(df, keep=["delay_min"]) == ["e"]
    assert clean.drop_constant_columns(df, keep=["delay_min"]).columns == ["a", "delay_min", "half"]
    rules = outliers.fit_outlier_rules(df)
    assert df.where(rules.beyond_z()).count() == 0
    assert clean.fence_counts(df, ["delay_min"]).first()["outlier_count"] == 0


def test_few_values_are_guarded_in_cleaning_only(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4] * 10 + [100]], "x double")
    assert clean.fence_counts(df, ["x"]).first()["outlier_count"] == 0
    assert clean.fence_counts(df, ["x"], guarded=False).first()["outlier_count"] == 1


def test_ties_at_the_limits(spark):
    fence = Fence(0.0, 2.0, -3.0, 5.0)
    rules = outliers.OutlierRules(fence, top=9.0)
    df = spark.createDataFrame([(5.0,), (5.01,), (9.0,), (-3.0,), (-3.01,), (None,)], "delay_min double")
    got = [r["outlier_type"] for r in rules.transform(df).collect()]
    assert got == ["normal", "suspicious", "suspicious", "normal", "invalid", "normal"]


def test_label_branches(spark):
    rules = outliers.OutlierRules(Fence(0.0, 2.0, -2.0, 5.0), top=9.0)
    rows = [(6.0, 1, 0, 1.0), (6.0, 0, 1, 1.0), (6.0, 0, 0, 1.0), (6.0, 1, 1, 0.0), (-2.5, 0, 0, 1.0), (1.0, 0, 0, 1.0)]
    df = spark.createDataFrame(rows, "delay_min double, is_rush_hour int, is_bad_weather int, speed_normal double")
    assert [r["outlier_type"] for r in rules.transform(df).collect()] == ["valid", "valid", "suspicious", "invalid", "suspicious", "normal"]
    inferred = outliers.OutlierRules(Fence(0.0, 2.0, -2.0, 5.0), top=9.0, low_side=False)
    assert [r["outlier_type"] for r in inferred.transform(df).collect()][4] == "normal"


def test_empty_groups(spark):
    df = spark.createDataFrame([(1.0, "normal", 1)], "delay_min double, outlier_type string, is_rush_hour int")
    row = outliers.outlier_counts(df).first()
    assert (row["outlier_rows"], row["valid_of_outliers_pct"], row["outliers_in_bad_weather_pct"]) == (0, 0.0, 0.0)
    assert [r["n"] for r in outliers.label_counts(df).orderBy("position").collect()] == [1, 0, 0, 0]
    assert outliers.target_by_outlier(df).count() == 1
    assert outliers.interpretation(outliers.outlier_counts(df)).first()["verdict"] == "realistic"
    assert spark.range(1).select(percent(F.lit(1), F.lit(0))).first()[0] == 0.0


def test_one_hot_leaves_out_the_first_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "route string")
    wide = encode.one_hot(df, "route")
    assert wide.columns == ["route", "route_b", "route_c"]
    assert [(r["route_b"], r["route_c"]) for r in wide.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    with pytest.raises(ValueError):
        encode.categories(df, "route", limit=2)
    vectors = [r["route_vector"].toArray().tolist() for r in encode.fit_one_hot_vector(df, "route").transform(df).collect()]
    assert [sum(v) for v in vectors] == [1.0, 0.0, 0.0, 1.0] and len(vectors[0]) == 2


def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "a int, b int")
    row = metrics.classification_metrics(df, "a", "b").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)
    assert sorted(tuple(r) for r in metrics.confusion(df, "a", "b").collect()) == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]


def test_r2_without_spread_and_mape_floor(spark):
    exact = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y_true double, y_pred double")
    wrong = spark.createDataFrame([(0.0, 1.0), (0.0, 1.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(exact).first()["r2"] == 1.0
    row = metrics.regression_metrics(wrong).first()
    assert row["r2"] == 0.0 and row["mape"] == pytest.approx(1 / 2.220446049250313e-16)


def test_weights(spark):
    df = spark.createDataFrame([("suspicious",), ("invalid",), ("other",), (None,)], "outlier_type string")
    assert [r["sample_weight"] for r in features.with_label_weight(df).collect()] == [0.65, 0.35, 1.0, 1.0]
    assert features.with_label_weight(df.drop("outlier_type").withColumn("x", F.lit(1))).first()["sample_weight"] == 1.0


def test_imputation_dedup_winsorize(spark):
    rows = [(1, 1.0, 2.0), (1, 1.0, 2.0), (2, None, 4.0), (3, 3.0, NAN)]
    df = features.finite_table(spark.createDataFrame(rows, "obs_id int, x double, delay_min double"))
    c = clean.clean(df, ["delay_min"], key="obs_id")
    got = {r["obs_id"]: (r["x"], r["delay_min"]) for r in c.deduped.collect()}
    assert got == {1: (1.0, 2.0), 2: (1.0, 4.0), 3: (3.0, 2.0)}
    low, high = c.winsorizer.bounds["delay_min"]
    assert all(low <= r["delay_min"] <= high for r in c.table.collect())
    assert clean.dedup(c.deduped).count() == c.deduped.count()


def test_missing_columns_are_refused(spark):
    df = spark.createDataFrame([("a",)], "name string")
    with pytest.raises(ValueError):
        outliers.fit_outlier_rules(df)
    with pytest.raises(ValueError):
        outliers.without_invalid(df)
    with pytest.raises(ValueError):
        encode.feature_columns(df)
    with pytest.raises(ValueError):
        encode.context_columns(df)
    with pytest.raises(FileNotFoundError):
        read_observations(spark, "/tmp/no-such-table-anywhere")


def test_optional_steps_are_skipped(spark):
    df = spark.createDataFrame([(1.0,)], "delay_min double")
    assert features.derive_features(df).columns == ["delay_min"]
    assert encode.prune(df).columns == ["delay_min"]


def test_skewness_and_scaler_match_definitions(spark):
    xs = [1.0, 2.0, 2.5, 9.0, 4.0, 1.5]
    df = spark.createDataFrame([(x, 2 * x + 1) for x in xs], "x double, y double")
    n, m = len(xs), sum(xs) / len(xs)
    m2, m3 = (sum((x - m) ** k for x in xs) / n for k in (2, 3))
    want = math.sqrt(n * (n - 1)) / (n - 2) * m3 / m2 ** 1.5
    assert df.agg(stats.skewness("x")).first()[0] == pytest.approx(want)
    assert df.limit(2).agg(stats.skewness("x")).first()[0] is None
    scaled = [r["x"] for r in fit_scaler(df, ["x"]).transform(df).collect()]
    assert sum(scaled) == pytest.approx(0.0, abs=1e-12) and sum(v * v for v in scaled) / n == pytest.approx(1.0)
    assert f_scores(df, ["x"], "y").first()["f_score"] > 1e12 or f_scores(df, ["x"], "y").first()["f_score"] == INF


def test_correlations_with_gaps(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 1.0), (3.0, 7.0, 2.0), (4.0, 8.5, 2.5), (5.0, None, 7.0), (6.0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("k", F.lit(1.0))
    got = {(r[0], r[1]): r[2] for r in stats.correlations(df).collect()}
    want = {p: df.agg(F.corr(*p)).first()[0] for p in [("a", "b"), ("a", "c"), ("b", "c")]}
    assert got == pytest.approx(want)
    shift = stats.correlation_shift(df, F.col("a") > 2).collect()
    part = df.where("a > 2")
    for r in shift:
        pair = (r["feature_a"], r["feature_b"])
        assert r["full_corr"] == pytest.approx(want[pair])
        assert r["outlier_corr"] == pytest.approx(part.agg(F.corr(*pair)).first()[0])


def test_names_and_counts():
    assert sanitised(["a b", "a:b", "ok-1"]) == ["a_b", "a_b_2", "ok-1"]
    assert (kept_features(62), kept_features(6), kept_features(3)) == (43, 5, 3)


def test_split_is_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "obs_id").withColumn("cls", (F.col("obs_id") % 10 == 0).cast("int"))
    train, test = split.holdout(df, "obs_id")
    again = {r[0] for r in split.holdout(df.repartition(7), "obs_id")[1].collect()}
    ids = {r[0] for r in test.collect()}
    assert ids == again and train.count() + len(ids) == 5000 and 850 < len(ids) < 1150
    _, strat = split.stratified_holdout(df, "obs_id", "cls")
    assert {r["cls"]: r["count"] for r in strat.groupBy("cls").count().collect()} == {0: 900, 1: 100}
    assert split.exact_sample(df, "obs_id", 77).count() == 77
    folds = {r[0] for r in split.with_fold(df, "obs_id", 5).select("fold").distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_projections_run_on_a_stream(spark, tmp_path):
    rows = [("2024-01-01 08:00:00", "a", "b", 6.0, 2.0, 6.5, 0.0, 1.0)]
    schema = "timestamp string, origin string, destination string, distance_km double, duration_normal_min double, delay_min double, rain double, wind double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    rules = outliers.OutlierRules(Fence(0.0, 2.0, -2.0, 5.0), top=9.0)
    out = rules.transform(features.derive_features(stream))
    run = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/out").first()
    assert (got["outlier_type"], got["route"], got["is_rush_hour"]) == ("valid", "a → b", 1)


def test_roles_rename(spark):
    roles = Roles(target="late", rain="wet", wind="gust")
    df = spark.createDataFrame([(4.0, 1.0, 0.0)], "late double, wet double, gust double")
    out = features.derive_features(df, roles)
    assert out.first()["is_bad_weather"] == 1
    assert outliers.fit_outlier_rules(out, roles).transform(out).first()["outlier_type"] == "valid"


def test_staged_tables_are_released(spark):
    from millrace.session import Staging

    with Staging() as stage:
        df = stage(spark.range(5))
        path = df.inputFiles()[0]
        assert df.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_recomputed_columns_do_not_change_deduplication(spark):
    rows = [(1, "2024-01-01 08:00:00", "a", None, 6.0, None, 1.0), (1, "2024-01-01 08:00:00", "a", None, 6.0, None, 1.0),
            (1, "2024-01-01 08:00:00", "a", None, 6.0, 2.0, 1.0), (1, "bad", "a", "b", 6.0, 2.0, 2.0), (1, None, "a", "b", 6.0, 2.0, 2.0),
            (2, "2024-01-02 09:00:00", "a", "b", None, 2.0, 3.0)]
    schema = "obs_id int, timestamp string, origin string, destination string, distance_km double, duration_normal_min double, delay_min double"
    df = features.derive_features(spark.createDataFrame(rows, schema))
    plain = clean.clean(df, ["delay_min"], key="obs_id").deduped
    slim = clean.clean(df, ["delay_min"], key="obs_id", recompute=features.recomputable(df)).deduped
    assert slim.columns == plain.columns and slim.dtypes == plain.dtypes
    assert sorted(map(str, slim.collect())) == sorted(map(str, plain.collect()))


def test_large_samples_equal_small_ones(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 2500).alias("obs_id"))
    direct = sorted(r[0] for r in split.exact_sample(df, "obs_id", 1001).collect())
    monkeypatch.setattr(split, "TOP_N", 10)
    assert sorted(r[0] for r in split.exact_sample(df, "obs_id", 1001).collect()) == direct
    assert split.exact_sample(df, "obs_id", 9999).count() == 3000


def test_box_figures_share_groupings(spark):
    from millrace.operators import chartdata

    df = spark.createDataFrame([(float(v), v % 2) for v in range(1, 12)] + [(100.0, None)], "x double, g int")
    rows = {(r["grouping"], r["series"]): r for r in chartdata.box_figures(df, "x", ["g", None]).collect()}
    assert set(rows) == {("g", "0"), ("g", "1"), ("g", None), ("column", "all")}
    whole = rows["column", "all"]
    assert (whole["outliers"], whole["whisker_low"], whole["whisker_high"], whole["median"]) == (1, 1.0, 11.0, 6.5)


def test_unseen_category_is_all_zeros(spark):
    fitted = encode.fit_one_hot_vector(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), "k")
    got = [r["k_vector"].toArray().tolist() for r in fitted.transform(spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "k string")).select("k_vector").collect()]
    assert sum(got[1]) == 1 and got[0] == got[2] == got[3] == [0.0, 0.0]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    from millrace.sources.tables import read_observations

    (tmp_path / "t.csv").write_text("wind,more,temperature\n3.5,x,25\n")
    schema = T.StructType.fromDDL("temperature double, wind double")
    assert [tuple(r) for r in read_observations(spark, str(tmp_path / "t.csv"), schema).collect()] == [(25.0, 3.5)]
    with pytest.raises(ValueError, match="rain"):
        read_observations(spark, str(tmp_path / "t.csv"), T.StructType.fromDDL("rain double"))


def test_joins_with_group_figures_do_not_exchange_the_table(spark):
    from millrace.functions.columns import small

    table = spark.range(1000).selectExpr("id", "id % 2 as k")
    plan = table.join(small(table.groupBy("k").count()), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
