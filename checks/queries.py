"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, one_row, small
from millrace.operators import (
    chartdata, clean, cluster, encode, explain, features, kernel, metrics, models, neighbors, outliers, profile, select, split, stats, tuning,
)
from millrace.operators.forest import DeepForest
from millrace.operators.models import BOOSTINGS, FORESTS
from millrace.plans import experiments, preprocess
from millrace.plans.experiments import Holdout, make_holdout
from millrace.roles import Roles, numeric_columns
from millrace.session import shared_dir, staged
from millrace.sources import tables
from millrace.sources.observations import OBS_ROLES, obs, obs_big

KEY = "obs_id"
TARGET, SPEED = "delay_min", "speed_normal"
RAW = ["obs_id", "ts_text", "origin", "destination", "distance_km", "duration_normal_min", "duration_traffic_min",
       "delay_min", "temperature", "wind", "rain"]
MODEL = ["distance_km", "duration_normal_min", "day_of_week", "is_weekend", "temperature", "wind", "is_rush_hour",
         "is_bad_weather", "speed_normal", "hour_sin", "hour_cos"]
KNN = ["distance_km", "duration_normal_min", "wind"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals in double columns (all, or the named ones), without negative zero.

    The nudge keeps exact halves, frequent among means of short decimals, off the rounding edge.
    """
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and (not names or f.name in names)]
    return df.select(*[(F.round(col(c) + F.lit(1e-9), 6) + F.lit(0.0)).alias(c) if c in real else col(c) for c in df.columns])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def beside(df: DataFrame, one: DataFrame) -> DataFrame:
    """The columns of a one-row table on every row."""
    if both := set(df.columns) & set(one.columns):
        raise ValueError(f"both tables have {sorted(both)}")
    return df.withColumn("_one", one_row(one)).select(*df.columns, "_one.*")


def feats(spark, d, big=False):
    return features.derive_features(obs_big(spark, d), Roles()) if big else features.derive_features(obs(spark, d), OBS_ROLES)


def cleaned(spark, d, big=False) -> clean.Cleaned:
    df = feats(spark, d, big)
    again = features.recomputable(df, Roles() if big else OBS_ROLES)
    return clean.clean(df, [TARGET, SPEED], key=KEY, stage=staged, recompute=again)


def labelled(spark, d, big=False, low_side=True):
    c = cleaned(spark, d, big)
    rules = outliers.fit_outlier_rules(c.table, Roles(), low_side=low_side, winsorizer=c.winsorizer)
    return rules.transform(c.table), rules, c


def lab(spark, d, big=False) -> DataFrame:
    return labelled(spark, d, big)[0]


def group_mean_predictions(df: DataFrame, *by: str, shift: float = 0.0) -> DataFrame:
    """Predictions without a learner: the mean target per group, joined back."""
    means = df.groupBy(*by).agg((F.avg(TARGET) + F.lit(shift)).alias("y_pred"))
    joined = df.join(small(means), list(by)) if by else df.withColumn("y_pred", means.scalar())
    return joined.withColumnRenamed(TARGET, "y_true")


def with_log_mape(df: DataFrame) -> DataFrame:
    return df.withColumn("mape", F.log10("mape")).withColumnRenamed("mape", "mape_log10")


# ---- sources, sinks, scope ------------------------------------------------------------


@query
def scan_csv(spark, d):
    source = obs(spark, d)
    path = f"{shared_dir(spark)}/obs-csv-{spark.sparkContext.applicationId}-{abs(hash(d)) % 10**8}"
    tables.write_dataset(source, path, "csv")
    df = tables.read_observations(spark, path, source.schema)
    return tables.with_text_columns(df.withColumn("has_text", F.col("distance_km")), "has_text").withColumn("has_text", F.col("has_text").isNotNull())


@query
def scope_sample(spark, d):
    return split.scope(obs(spark, d), KEY, 5_000).select(KEY, TARGET)


@query
def plot_sample(spark, d):
    return rounded(split.exact_sample(lab(spark, d), KEY, 12_000, columns=[TARGET, SPEED, "outlier_type"]).select(KEY, TARGET, SPEED, "outlier_type"))


@query
def sink_roundtrip(spark, d):
    base = f"{shared_dir(spark)}/sink-{spark.sparkContext.applicationId}-{abs(hash(d)) % 10**8}"
    tables.write_dataset(lab(spark, d).select("route", "outlier_type", TARGET), f"{base}-data")
    small = spark.read.parquet(f"{base}-data").groupBy("route", "outlier_type").agg(
        F.count("*").alias("n"), F.avg(TARGET).alias("mean_target"))
    tables.write_dataset(small, f"{base}-table", "csv")
    return rounded(tables.read_observations(spark, f"{base}-table", small.schema))


# ---- projections ----------------------------------------------------------------------


@query
def feature_engineering(spark, d):
    df = feats(spark, d).withColumn("has_time", F.col("ts_text").isNotNull())
    return rounded(df.select(KEY, "has_time", "hour", "day_of_week", "is_weekend", "route", "is_rush_hour", "is_bad_weather",
                             SPEED, "hour_sin", "hour_cos"))


@query
def type_audit(spark, d):
    df = feats(spark, d)
    plan = encode.column_plan(df)
    audit = profile.type_audit(df, roles=OBS_ROLES)
    present = df.agg(*[F.count(col(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "values")
    return audit.join(plan, "column", "left").join(present, "column", "left")


@query
def route_onehot(spark, d):
    df = lab(spark, d)
    wide = encode.one_hot(df, "route")
    names = [c for c in wide.columns if c.startswith("route_")]
    return wide.agg(*[F.sum(col(c)).alias(c) for c in names]).unpivot([], names, "column_name", "ones")


@query
def route_onehot_vector(spark, d):
    df = lab(spark, d, big=True)
    out = encode.fit_one_hot_vector(df, "route").transform(df)
    hot = F.array_max(vector_to_array("route_vector"))
    return out.groupBy("route").agg(F.count("*").alias("n"), F.sum(hot).alias("ones"), F.max(F.size(vector_to_array("route_vector"))).alias("width"))


@query
def readiness_cleanup(spark, d):
    model = encode.prune(lab(spark, d).withColumn("source_version", F.lit(1)), OBS_ROLES).drop(KEY)
    ready, _ = clean.ready_for_learning(model, TARGET, stage=staged)
    return rounded(ready, SPEED, "hour_sin", "hour_cos", TARGET, "temperature")


@query
def target_bins(spark, d):
    df, target = features.with_target(obs(spark, d), "classification")
    label = features.with_target(obs(spark, d), "regression")[1]
    return df.select(KEY, F.col(label).alias("label"), target, features.bin_rank(target).alias("level_rank"))


@query
def class_and_weights(spark, d):
    df = features.with_day_type(features.with_label_weight(features.with_target_class(lab(spark, d))))
    return df.select(KEY, "outlier_type", "target_class", "sample_weight", "day_type")


# ---- filters --------------------------------------------------------------------------


@query
def valid_rows(spark, d):
    kept = outliers.without_invalid(lab(spark, d))
    return kept.select(KEY, "outlier_type", F.col("outlier_type").isin("valid", "suspicious").alias("is_extreme"))


@query
def delay_by_label(spark, d):
    return rounded(outliers.target_by_outlier(lab(spark, d)))


@query
def robust_train_filter(spark, d):
    train, _ = split.holdout(lab(spark, d), KEY)
    return outliers.fit_robust_filter(train).summary(train)


# ---- cleaning and labelling -----------------------------------------------------------


@query
def median_impute(spark, d):
    df = feats(spark, d)
    out = clean.fit_median_imputer(df, exclude=[KEY]).transform(df)
    return rounded(out.select(KEY, "temperature", "wind", "rain", "hour", "day_of_week", "hour_sin", "hour_cos"), "hour_sin", "hour_cos")


@query
def dedup(spark, d):
    return clean.dedup(obs(spark, d), key=KEY).select(*RAW)


@query
def iqr_counts(spark, d):
    df = cleaned(spark, d).deduped
    names = [TARGET, SPEED, "rain", "day_of_week"]
    fences = clean.fit_fences(df, names)
    a = clean.fence_counts(df, names, fences=fences).withColumnRenamed("outlier_count", "guarded_count")
    b = clean.fence_counts(df, names, guarded=False, fences=fences).withColumnRenamed("outlier_count", "plain_count")
    return a.join(b, "column").withColumnRenamed("column", "column_name")


@query
def winsorize(spark, d):
    return rounded(cleaned(spark, d).table.select(KEY, TARGET, SPEED))


@query
def zscore_top1(spark, d):
    df, rules, _ = labelled(spark, d)
    return df.select(KEY, rules.beyond_z().alias("beyond_z"), rules.in_top().alias("is_top"), rules.outside_fence().alias("off_fence"))


@query
def outlier_labels(spark, d):
    return rounded(lab(spark, d).select(KEY, TARGET, "outlier_type"))


@query
def outlier_labels_big(spark, d):
    return rounded(lab(spark, d, big=True).groupBy("outlier_type").agg(F.count("*").alias("n"), F.avg(TARGET).alias("mean_target")))


@query
def outlier_labels_inferred(spark, d):
    table = cleaned(spark, d).table
    return outliers.ensure_labels(table).select(KEY, "outlier_type")


@query
def clean_summary(spark, d):
    df = feats(spark, d)
    c = clean.clean(df, [TARGET, SPEED], key=KEY, stage=staged)
    out = c.summary(df, [TARGET, SPEED])
    return rounded(out.withColumnRenamed("column", "column_name"))


# ---- profiles and statistics ----------------------------------------------------------


@query
def completeness(spark, d):
    return rounded(profile.completeness(obs(spark, d))).withColumnRenamed("column", "column_name")


@query
def completeness_totals(spark, d):
    return profile.completeness_totals(feats(spark, d))


@query
def quality(spark, d):
    df = feats(spark, d)
    return rounded(profile.quality(df, [*features.recomputable(df, OBS_ROLES), KEY]))


@query
def distincts(spark, d):
    df = feats(spark, d)
    names = ["origin", "destination", "route", *[c for c in numeric_columns(df) if c != KEY]]
    few = stats.indicator_columns(df)
    return (stats.distinct_counts(df, names).withColumn("is_indicator", F.col("column").isin(few) | (F.col("distinct_values") <= 2))
            .withColumnRenamed("column", "column_name"))


@query
def describe(spark, d):
    df = lab(spark, d).drop(KEY)
    out = stats.describe(df, clean.continuous_columns(df))
    return rounded(out).withColumnsRenamed({"column": "column_name", "count": "n"})


@query
def class_distribution(spark, d):
    df = lab(spark, d).withColumn("traffic_level", features.binned(TARGET))
    parts = [stats.class_distribution(df, c).select(F.lit(c).alias("target"), "class", "n", "pct") for c in ("outlier_type", "traffic_level")]
    return rounded(union(parts))


@query
def detection_summary(spark, d):
    df, rules, _ = labelled(spark, d)
    return rounded(outliers.detection_summary(df, rules))


@query
def outlier_counts(spark, d):
    return rounded(outliers.outlier_counts(lab(spark, d)))


@query
def outlier_hours(spark, d):
    return outliers.outlier_hours(lab(spark, d, big=True))


@query
def top_routes(spark, d):
    return rounded(outliers.top_routes_report(lab(spark, d, big=True)))


@query
def corr_long(spark, d):
    df = lab(spark, d).drop(KEY)
    return rounded(stats.correlations(df))


@query
def corr_shift(spark, d):
    df = lab(spark, d).drop(KEY)
    return rounded(stats.correlation_shift(df, outliers.is_outlier()))


@query
def skew_rank(spark, d):
    return rounded(stats.skew_ranking(lab(spark, d).drop(KEY))).withColumnRenamed("column", "column_name")


# ---- chart tables ---------------------------------------------------------------------


@query
def histogram(spark, d):
    return rounded(chartdata.histograms(lab(spark, d), [TARGET, SPEED, "temperature", "wind"])).withColumnRenamed("column", "column_name")


@query
def density_hist(spark, d):
    return rounded(chartdata.density(lab(spark, d), TARGET, outliers.is_outlier()))


@query
def boxplot_stats(spark, d):
    df = features.with_day_type(lab(spark, d, big=True))
    return rounded(chartdata.box_figures(df, TARGET, ["is_rush_hour", "is_bad_weather", "day_type", None]))


@query
def hour_mean_sd(spark, d):
    return rounded(chartdata.hourly_band(lab(spark, d, big=True)))


@query
def grid2d(spark, d):
    return chartdata.grid2d(lab(spark, d), "distance_km", TARGET)


@query
def hexagons(spark, d):
    return rounded(chartdata.hexagons(lab(spark, d), "distance_km", TARGET))


@query
def ols_trend(spark, d):
    return rounded(stats.ols_trend(lab(spark, d), "distance_km", TARGET))


@query
def label_counts_filled(spark, d):
    # the last label is never given, so its zero has to be filled in
    return outliers.label_counts(lab(spark, d), labels=(*outliers.LABELS, "unlabelled"))


@query
def interpretation(spark, d):
    return rounded(outliers.interpretation(outliers.outlier_counts(lab(spark, d)))).drop("advice")


# ---- splits ---------------------------------------------------------------------------


@query
def holdout_split(spark, d):
    return lab(spark, d).select(KEY, split.in_test(KEY).alias("is_test"))


@query
def stratified_split(spark, d):
    df = features.with_target_class(outliers.without_invalid(lab(spark, d)))
    return split.stratified_flag(df, KEY, "target_class").select(KEY, "target_class", "is_test")


@query
def labels_for_train(spark, d):
    df = lab(spark, d)
    train, _ = split.holdout(df.select(KEY, TARGET), KEY)
    return rounded(train.join(df.select(KEY, "outlier_type"), KEY))


@query
def kfold(spark, d):
    train, _ = split.holdout(lab(spark, d), KEY)
    return split.with_fold(train, KEY, 5).select(KEY, "fold")


# ---- evaluation -----------------------------------------------------------------------


@query
def metrics_regression(spark, d):
    return rounded(with_log_mape(metrics.regression_metrics(group_mean_predictions(lab(spark, d), "hour"))))


@query
def metrics_by_label(spark, d):
    preds = group_mean_predictions(lab(spark, d), "hour")
    return rounded(with_log_mape(metrics.regression_metrics_by(preds, "outlier_type", groups=["normal", "valid", "suspicious"])))


@query
def metrics_classification(spark, d):
    return rounded(metrics.classification_metrics(features.with_target_class(lab(spark, d)), "target_class", "is_rush_hour"))


@query
def confusion(spark, d):
    return metrics.confusion(features.with_target_class(lab(spark, d)), "target_class", "is_rush_hour")


@query
def improvement_pct(spark, d):
    df = lab(spark, d)
    base = metrics.regression_metrics(group_mean_predictions(df, shift=0.25))
    named = {"hourly": "hour", "route": "route"}
    new = metrics.comparison({n: metrics.regression_metrics(group_mean_predictions(df, by)) for n, by in named.items()})
    same = metrics.comparison({n: base for n in named})
    return rounded(metrics.improvement(same, new))


@query
def residual_confidence(spark, d):
    return rounded(metrics.residual_confidence(group_mean_predictions(lab(spark, d), "hour")))


@query
def prediction_table(spark, d):
    preds = group_mean_predictions(lab(spark, d), "hour")
    return rounded(metrics.predictions(preds, "y_true", "y_pred", carry=[KEY]))


# ---- learners that SQL can check ------------------------------------------------------


@query
def knn_predict(spark, d):
    df = staged(lab(spark, d).select(KEY, TARGET, *KNN), "knn-source")
    train, test = split.holdout(df, KEY)
    return rounded(neighbors.knn_predict(test, train, KNN, TARGET, KEY, KEY, k=15))


@query
def standardize(spark, d):
    df = lab(spark, d)
    train, _ = split.holdout(df, KEY)
    return rounded(select.fit_scaler(train, KNN).transform(df).select(KEY, *KNN))


@query
def f_select(spark, d):
    train, _ = split.holdout(lab(spark, d), KEY)
    return rounded(select.select_features(train, MODEL, TARGET))


@query
def interaction_pairs(spark, d):
    train, _ = split.holdout(lab(spark, d), KEY)
    scores = select.f_scores(train, MODEL, TARGET)
    total = scores.agg(F.sum("f_score").alias("total")).scalar()
    share = scores.select("feature", (F.col("f_score") / total).alias("importance"))
    return rounded(explain.interaction_pairs(share))


# ---- learners: rows-only checks -------------------------------------------------------
# All at their presets, on all training rows.


def holdout_of(spark, d, stratified=False) -> Holdout:
    keep = [KEY, TARGET, "outlier_type", *MODEL]
    return make_holdout(staged(lab(spark, d).select(*keep), "labelled"), names=MODEL, stratified=stratified)


@query
def report_json(spark, d):
    p = preprocess.prepare(obs(spark, d), OBS_ROLES)
    path = f"{shared_dir(spark)}/report-{spark.sparkContext.applicationId}-{abs(hash(d)) % 10**8}"
    row = preprocess.report(p)
    tables.write_report(row, path)
    return spark.read.schema(row.schema).json(path).select(
        "target", "shape", "quality", "outlier_counts", "interpretation", F.size("cleaning").alias("cleaning_entries"),
        F.size("top_routes").alias("top_route_entries"), F.size("correlation_shift").alias("shift_entries"))


@query
def model_roundtrip(spark, d):
    h = holdout_of(spark, d)
    done = experiments.final_training(h, FORESTS["final"])
    path = f"{shared_dir(spark)}/model-{spark.sparkContext.applicationId}-{abs(hash(d)) % 10**8}"
    done.save(path)
    again = h.scored(DeepForest.load(spark, f"{path}/model")).select(KEY, F.col("prediction").alias("reloaded"))
    both = h.scored(done.model).select(KEY, "prediction").join(again, KEY)
    return both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("largest_difference"))


@query
def rf_holdout(spark, d):
    h = holdout_of(spark, d)
    model = h.forest(FORESTS["single"])
    preds = metrics.predictions(h.scored(model))
    axis = metrics.prediction_range(preds)
    return beside(metrics.regression_metrics(preds), axis)


@query
def rf_weighted(spark, d):
    done = experiments.final_training(holdout_of(spark, d), FORESTS["final"])
    return beside(done.weights.withColumnRenamed("n", "n_train"), done.metrics)


@query
def rf_classifier(spark, d):
    h = holdout_of(spark, d, stratified=True)
    context = encode.context_columns(h.train)
    model = models.fit_forest(FORESTS["classifier"], encode.assembled(h.train, context, "target_class"), classifier=True)
    return metrics.classification_metrics(model.transform(encode.assembled(h.test, context, "target_class")), "label", "prediction")


@query
def route_learner(spark, d):
    """The single forest without and with the indicators of the routes as a sparse vector."""
    rows = staged(lab(spark, d).select(KEY, TARGET, "outlier_type", "route", *MODEL), "labelled")
    both = encode.fit_one_hot_vector(rows, "route").transform(rows)
    names = {"without": MODEL, "with": [*MODEL, "route_vector"]}
    return metrics.comparison({n: (h := make_holdout(both, names=c)).metrics(h.forest(FORESTS["single"])) for n, c in names.items()})


@query
def gbt_holdout(spark, d):
    h = holdout_of(spark, d)
    return metrics.comparison({n: h.metrics(h.boosting(BOOSTINGS[n])) for n in ("comparison", "voting")})


@query
def kernel_reg(spark, d):
    h = holdout_of(spark, d)
    model = kernel.fit_kernel_regression(h.train, h.features, TARGET, "sample_weight", size=128, iterations=50)
    return metrics.regression_metrics(model.transform(h.test), TARGET, "prediction")


@query
def kmeans_clusters(spark, d):
    h = holdout_of(spark, d)
    return cluster.fit_clusters(h.train, h.features, restarts=10).summary(h.train, TARGET)


@query
def algorithm_tournament(spark, d):
    t = experiments.tournament(holdout_of(spark, d), FORESTS["baseline"], BOOSTINGS["comparison"], waves=128, restarts=10)
    return t.before.join(t.change, "model")


@query
def voting(spark, d):
    h = holdout_of(spark, d)
    _, table, _ = experiments.voting(h, FORESTS["baseline"], FORESTS["voting"], BOOSTINGS["voting"])
    return table


@query
def dual_routing(spark, d):
    both = experiments.single_vs_dual(holdout_of(spark, d, stratified=True), FORESTS["single"], FORESTS["classifier"])
    return both.comparison


@query
def outlier_experiment(spark, d):
    done = experiments.outlier_experiment(holdout_of(spark, d), FORESTS["experiment"])
    return beside(done.metrics, done.removed)


@query
def grid_search(spark, d):
    h = holdout_of(spark, d)
    data = h.vectors(split.with_fold(h.train, KEY, 3))
    return tuning.shared_grid_search(data, FORESTS["baseline"].spec(len(MODEL)), weight="sample_weight").leaders()


@query
def tuned_model(spark, d):
    done = experiments.tune(holdout_of(spark, d))
    return done.comparison.join(done.cv, "model")


@query
def cv_scores(spark, d):
    h = holdout_of(spark, d)
    table, _ = experiments.regularised(h)
    return table


@query
def importance(spark, d):
    h = holdout_of(spark, d)
    return explain.importances(spark, h.forest(FORESTS["baseline"]), h.features)


@query
def tree_disagreement(spark, d):
    h = holdout_of(spark, d)
    done = experiments.explained(h, FORESTS["baseline"])
    return beside(done.uncertain, done.disagreement)


@query
def optimisation_chain(spark, d):
    h = holdout_of(spark, d)
    return experiments.optimise(h).log
