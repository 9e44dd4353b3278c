"""Model experiments composed of splits, learners and metrics.

All runs take a labelled table with a row key, hold out the same rows, and
return DataFrames. Budgets (trees, depth, rounds) are arguments with the named
presets as defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators import explain, features, metrics, models, neighbors, outliers, split, tuning
from millrace.operators.cluster import Clusters, fit_clusters
from millrace.operators.encode import assembled, context_columns, feature_columns
from millrace.operators.kernel import fit_kernel_regression
from millrace.operators.models import BOOSTINGS, FORESTS, Boosting, Forest
from millrace.operators.select import kept_features, select_features
from millrace.roles import Roles, require_numeric
from millrace.session import staged
from millrace.sources.fitted import save_fitted
from millrace.sources.tables import save_model, write_dataset

WEIGHT = "sample_weight"


@dataclass(frozen=True)
class Holdout:
    """Training and test rows with target, weight and feature list."""

    train: DataFrame
    test: DataFrame
    features: tuple[str, ...]
    roles: Roles = Roles()
    fitted: dict = field(default_factory=dict)

    @property
    def target(self) -> str:
        return self.roles.target

    def vectors(self, rows: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        carry = [self.roles.key, self.roles.label, WEIGHT, "fold", "target_class"]
        return assembled(rows, names or self.features, self.target, carry=carry)

    def forest(self, preset: Forest, names: Sequence[str] | None = None):
        """Fit once per preset and feature list; equal fits of several experiments are shared."""
        key = (preset, tuple(names or self.features))
        if key not in self.fitted:
            self.fitted[key] = models.fit_forest(preset, self.vectors(self.train, names), WEIGHT)
        return self.fitted[key]

    def boosting(self, preset: Boosting):
        key = (preset, self.features)
        if key not in self.fitted:
            self.fitted[key] = models.fit_boosting(preset, self.vectors(self.train), WEIGHT)
        return self.fitted[key]

    def scored(self, model, names: Sequence[str] | None = None) -> DataFrame:
        return model.transform(self.vectors(self.test, names))

    def metrics(self, model, names: Sequence[str] | None = None) -> DataFrame:
        return metrics.regression_metrics(self.scored(model, names), "label", "prediction")


def make_holdout(labelled: DataFrame, roles: Roles = Roles(), names: Sequence[str] | None = None, stratified: bool = False,
                 share: float = 0.2, seed: int = 42, include_label_features: bool = False) -> Holdout:
    """Split a labelled table; weights come from the labels.

    Features made from the target (``target_class``) are left out unless asked for.
    """
    require_numeric(labelled, roles.target, "as a regression target")
    rows = features.with_label_weight(labelled, roles.label)
    if stratified:
        rows = features.with_target_class(outliers.without_invalid(rows, roles.label), roles.label)
        train, test = split.stratified_holdout(rows, roles.key, "target_class", share, seed)
    else:
        train, test = split.holdout(rows, roles.key, share, seed)
    chosen = list(names or feature_columns(rows, roles, include_label_features))
    return Holdout(train, test, tuple(chosen), roles)


# ---- outlier handling ------------------------------------------------------------------


@dataclass(frozen=True)
class OutlierExperiment:
    metrics: DataFrame
    removed: DataFrame
    delta: DataFrame


def outlier_experiment(h: Holdout, preset: Forest = FORESTS["experiment"]) -> OutlierExperiment:
    """The same model with all training rows and without the doubtful ones, on the same untouched test rows."""
    keep = outliers.fit_robust_filter(h.train, h.roles)
    full = h.metrics(h.forest(preset))
    cleaned = models.fit_forest(preset, h.vectors(keep.transform(h.train)))
    less = h.metrics(cleaned)
    table = metrics.comparison({"with_outliers": full, "without_outliers": less}, "experiment")
    delta = metrics.improvement(full, less).select(
        (-F.col("mae_delta")).alias("mae"), (-F.col("rmse_delta")).alias("rmse"), F.col("r2_delta").alias("r2"))
    return OutlierExperiment(table, keep.summary(h.train), delta)


@dataclass(frozen=True)
class FinalModel:
    model: object
    metrics: DataFrame
    predictions: DataFrame
    importances: DataFrame
    weights: DataFrame

    def save(self, path: str) -> None:
        write_dataset(self.predictions, f"{path}/test_predictions", "csv")
        write_dataset(self.importances, f"{path}/feature_importance", "csv")
        save_model(self.model, f"{path}/model")


def final_training(h: Holdout, preset: Forest = FORESTS["final"]) -> FinalModel:
    """Weighted forest on all training rows, with the tables to be kept."""
    model = h.forest(preset)
    scored = h.scored(model)
    weights = h.train.groupBy(col(h.roles.label), WEIGHT).agg(F.count("*").alias("n"))
    return FinalModel(model, metrics.regression_metrics(scored, "label", "prediction"), metrics.predictions(scored),
                      explain.importances(h.train.sparkSession, model, h.features), weights)


# ---- routing ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DualComparison:
    routed: models.Routed
    comparison: DataFrame
    improvement: DataFrame
    by_label: DataFrame
    classifier: DataFrame
    confusion: DataFrame
    routes: DataFrame


def single_vs_dual(h: Holdout, preset: Forest = FORESTS["single"], classifier: Forest = FORESTS["classifier"],
                   context: Sequence[str] | None = None) -> DualComparison:
    """One forest against a classifier that routes rows to a normal and an extreme forest."""
    single = h.forest(preset)
    one = h.scored(single)
    routed = models.fit_routed(h.train, h.features, context or context_columns(h.train, h.roles), h.target, h.roles.label,
                               "target_class", preset, classifier)
    two = routed.transform(h.test, carry=["target_class", h.roles.label])
    a, b = (metrics.regression_metrics(s, "label", "prediction") for s in (one, two))
    return DualComparison(
        routed,
        metrics.comparison({"single": a, "dual": b}),
        metrics.improvement(a, b),
        metrics.regression_metrics_by(one, h.roles.label, "label", "prediction", ["normal", "valid", "suspicious"]),
        metrics.classification_metrics(two, "target_class", "predicted_class"),
        metrics.confusion(two, "target_class", "predicted_class"),
        two.groupBy("predicted_class").agg(F.count("*").alias("n")))


# ---- tournament ------------------------------------------------------------------------


def _contest(h: Holdout, forest: Forest, boosting: Boosting, neighbours: int, waves: int, stage) -> DataFrame:
    kernel = fit_kernel_regression(h.train.where(col(h.target).isNotNull()), h.features, h.target, WEIGHT, size=waves)
    test = h.test.where(col(h.target).isNotNull())
    near = neighbors.knn_predict(test, h.train, h.features, h.target, h.roles.key, h.roles.key, k=neighbours, stage=stage)
    near = test.select(col(h.roles.key).alias("query_id"), col(h.target).alias("label")).join(near, "query_id")
    return metrics.comparison({
        "forest": h.metrics(h.forest(forest)),
        "boosting": h.metrics(h.boosting(boosting)),
        "kernel": metrics.regression_metrics(kernel.transform(test.withColumn("label", col(h.target))), "label", "prediction"),
        "neighbours": metrics.regression_metrics(near, "label", "prediction"),
    })


@dataclass(frozen=True)
class Tournament:
    clusters: Clusters
    before: DataFrame
    after: DataFrame
    change: DataFrame

    def save(self, path: str) -> None:
        for name, table in (("before", self.before), ("after", self.after), ("change", self.change)):
            write_dataset(table, f"{path}/algorithms_{name}", "csv")
        save_fitted(self.before.sparkSession, self.clusters, f"{path}/clusters")


def tournament(h: Holdout, forest: Forest = FORESTS["baseline"], boosting: Boosting = BOOSTINGS["comparison"], neighbours: int = 15,
               waves: int = 128, k: int = 5, restarts: int = 10, scale: bool = False, stage=staged) -> Tournament:
    """All learners without and with the cluster number as a feature; tables sorted by RMSE."""
    before = _contest(h, forest, boosting, neighbours, waves, stage)
    found = fit_clusters(h.train, h.features, k, restarts, scale=scale)
    more = Holdout(found.transform(h.train), found.transform(h.test), (*h.features, "cluster"), h.roles)
    after = _contest(more, forest, boosting, neighbours, waves, stage)
    change = before.select("model", F.col("rmse").alias("rmse_before")).join(after.select("model", F.col("rmse").alias("rmse_after")), "model")
    change = change.withColumn("improvement_pct", F.lit(100.0) * F.try_divide(F.col("rmse_before") - F.col("rmse_after"), F.col("rmse_before")))
    return Tournament(found, before.orderBy("rmse"), after.orderBy("rmse"), change.orderBy("rmse_after"))


# ---- tuning and optimisation -----------------------------------------------------------


@dataclass(frozen=True)
class Tuned:
    search: tuning.Search
    comparison: DataFrame
    improvement: DataFrame
    cv: DataFrame

    def save(self, path: str) -> None:
        """The tables, the best combination as one row, and the tuned model."""
        spark = self.comparison.sparkSession
        best = spark.createDataFrame([(n, None if v is None else str(v)) for n, v in self.search.best.items()], "parameter string, value string")
        for name, table in (("grid", self.search.table), ("best", best), ("baseline_vs_tuned", self.comparison), ("improvement", self.improvement), ("cross_validation", self.cv)):
            write_dataset(table, f"{path}/{name}", "csv")
        save_fitted(spark, self.search.model, f"{path}/model")


def tune(h: Holdout, grid: Mapping[str, Sequence] = tuning.GRID, baseline: Forest = FORESTS["baseline"], folds: int = 3, cv_folds: int = 5,
         parallelism: int = 2) -> Tuned:
    """Grid search against the baseline, each with its cross-validated error; a deep forest shares its trees among the combinations."""
    key = h.roles.key
    searched = h.vectors(split.with_fold(h.train, key, folds))
    if baseline.deep:
        spec = baseline.spec(len(h.features))
        search = tuning.shared_grid_search(searched, spec, grid, folds, weight=WEIGHT if baseline.weighted else None)
        a, b = h.metrics(h.forest(baseline)), h.metrics(search.model)
        best = search.model.grown.specs[0]
        scored = tuning.shared_cv_scores(h.vectors(split.with_fold(h.train, key, cv_folds)), [spec, best], "rmse", cv_folds)
        cv = h.train.sparkSession.createDataFrame([(n, *s) for n, s in zip(("baseline", "tuned"), scored)], "model string, cv_rmse_mean double, cv_rmse_std double")
        return Tuned(search, metrics.comparison({"baseline": a, "tuned": b}), metrics.improvement(a, b), cv)
    learner = models.forest_regressor(baseline, WEIGHT)
    search = tuning.grid_search(searched, learner, grid, folds, parallelism=parallelism)
    a, b = h.metrics(h.forest(baseline)), h.metrics(search.model)
    # the cross-validated error is measured without weights
    folded = h.vectors(split.with_fold(h.train, key, cv_folds))
    plain = models.forest_regressor(baseline)
    scores = [("baseline", *tuning.cv_score(folded, plain, "rmse", cv_folds, parallelism=parallelism)),
              ("tuned", *tuning.cv_score(folded, plain.copy({plain.getParam(n): v for n, v in search.best.items()}), "rmse", cv_folds,
                                         parallelism=parallelism))]
    cv = h.train.sparkSession.createDataFrame(scores, "model string, cv_rmse_mean double, cv_rmse_std double")
    return Tuned(search, metrics.comparison({"baseline": a, "tuned": b}), metrics.improvement(a, b), cv)


def feature_selection(h: Holdout, preset: Forest = FORESTS["baseline"], share: float = 0.7) -> tuple[list[str], DataFrame, DataFrame]:
    """The same forest on all and on the best features."""
    k = kept_features(len(h.features), share)
    best = {r["feature"] for r in select_features(h.train, h.features, h.target, k).collect()}
    kept = [f for f in h.features if f in best]
    a, b = h.metrics(h.forest(preset)), h.metrics(h.forest(preset, kept), kept)
    table = metrics.comparison({"all features": a, "selected features": b})
    return kept, table.withColumn("n_features", F.when(F.col("model") == "all features", len(h.features)).otherwise(k)), metrics.improvement(a, b)


def voting(h: Holdout, baseline: Forest = FORESTS["baseline"], forest: Forest = FORESTS["voting"],
           boosting: Boosting = BOOSTINGS["voting"]) -> tuple[models.Voting, DataFrame, DataFrame]:
    """The mean of a forest and a boosted model against a single forest."""
    both = models.Voting((h.forest(forest), h.boosting(boosting)))
    a, b = h.metrics(h.forest(baseline)), h.metrics(both)
    return both, metrics.comparison({"forest": a, "voting": b}), metrics.improvement(a, b)


def regularised(h: Holdout, baseline: Forest = FORESTS["baseline"], strict: Forest = FORESTS["regularised"], folds: int = 5,
                parallelism: int = 2) -> tuple[DataFrame, DataFrame]:
    """Stricter forest against the baseline, with the gap between cross-validated and test R2."""
    folded = h.vectors(split.with_fold(h.train, h.roles.key, folds))
    both = {"baseline": baseline, "regularised": strict}
    tables = {name: h.metrics(h.forest(preset)) for name, preset in both.items()}
    if baseline.deep and strict.deep:
        scores = tuning.shared_cv_scores(folded, [p.spec(len(h.features)) for p in both.values()], "r2", folds)
        rows = [(name, mean) for name, (mean, _) in zip(both, scores)]
    else:
        rows = [(name, tuning.cv_score(folded, models.forest_regressor(p), "r2", folds, parallelism=parallelism)[0]) for name, p in both.items()]
    cv = h.train.sparkSession.createDataFrame(rows, "model string, cv_r2 double")
    table = metrics.comparison(tables).join(F.broadcast(cv), "model")  # one row per model
    return table.withColumn("cv_stability", F.abs(F.col("cv_r2") - F.col("r2"))), metrics.improvement(tables["baseline"], tables["regularised"])


@dataclass(frozen=True)
class Explained:
    importances: DataFrame
    interactions: DataFrame
    confidence: DataFrame
    disagreement: DataFrame
    uncertain: DataFrame


def explained(h: Holdout, preset: Forest = FORESTS["baseline"], trees: int = 10) -> Explained:
    """Importances, pair interactions, residual confidence and disagreement between trees."""
    model = h.forest(preset)
    scored = h.scored(model)
    table = explain.importances(h.train.sparkSession, model, h.features)
    per_row = explain.tree_disagreement(model, scored, trees, carry=[h.roles.key])
    return Explained(table, explain.interaction_pairs(table), metrics.residual_confidence(scored, "label", "prediction"),
                     explain.disagreement_summary(per_row), explain.most_uncertain(per_row))


@dataclass(frozen=True)
class Optimised:
    log: DataFrame
    comparison: DataFrame
    explained: Explained
    models: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        """The tables, and the voting and the regularised model."""
        told = self.explained
        tables = {"improvements": self.log, "voting": self.comparison, "importances": told.importances, "interactions": told.interactions, "confidence": told.confidence}
        for name, table in (tables | {"disagreement": told.disagreement, "uncertain": told.uncertain}).items():
            write_dataset(table, f"{path}/{name}", "csv")
        for name, model in self.models.items():
            save_fitted(self.log.sparkSession, model, f"{path}/{name}_model")


def optimise(h: Holdout, baseline: Forest = FORESTS["baseline"], forest: Forest = FORESTS["voting"], boosting: Boosting = BOOSTINGS["voting"],
             strict: Forest = FORESTS["regularised"], folds: int = 5, parallelism: int = 2) -> Optimised:
    """Selection, voting and regularisation against one baseline fit, the log of gains, and the explanation."""
    _, _, gain_selected = feature_selection(h, baseline)
    both, versus, gain_voting = voting(h, baseline, forest, boosting)
    _, gain_strict = regularised(h, baseline, strict, folds, parallelism)
    log = metrics.comparison({"feature selection": gain_selected, "voting": gain_voting, "regularisation": gain_strict}, "step")
    return Optimised(log, versus, explained(h, baseline), {"voting": both, "regularised": h.forest(strict)})
