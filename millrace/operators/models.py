"""Tree learners with the presets of the workflow, voting and routed pairs of models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators.boosting import Rounds, fit_boosted
from millrace.operators.encode import assembled
from millrace.operators.forest import UNLIMITED, Spec, fit_deep_forest

SEED = 42
DEEPEST = 30  # MLlib refuses deeper trees


@dataclass(frozen=True)
class Forest:
    """Depth None is unlimited. A deep forest is grown in two phases (``operators.forest``), any other by MLlib level by level."""

    trees: int
    depth: int | None = None
    min_leaf: int = 1
    subset: str = "all"
    weighted: bool = False
    bins: int = 64
    deep: bool = True

    def scaled(self, trees: int, depth: int) -> Forest:
        """The same preset with a smaller budget, for MLlib."""
        return replace(self, trees=min(self.trees, trees), depth=min(self.depth or depth, depth), deep=False)

    def spec(self, features: int, seed: int = SEED) -> Spec:
        tried = max(1, int(features**0.5)) if self.subset == "sqrt" else 0
        return Spec(self.trees, self.min_leaf, tried, UNLIMITED if self.depth is None else self.depth, seed)


@dataclass(frozen=True)
class Boosting:
    """Deep boosting grows trees leaf by leaf (``operators.boosting``), any other by MLlib level by level."""

    rounds: int
    step: float = 0.05
    depth: int = 5
    weighted: bool = False
    bins: int = 64
    leaves: int | None = None
    min_leaf: int = 1
    deep: bool = True

    def scaled(self, rounds: int, depth: int) -> Boosting:
        return replace(self, rounds=min(self.rounds, rounds), depth=min(self.depth, depth), deep=False)

    def how(self) -> Rounds:
        return Rounds(self.rounds, self.step, self.leaves, self.depth, self.min_leaf)


# Budgets of the named models. Minimum split size 10 follows from five rows per leaf.
FORESTS = {
    "experiment": Forest(350),
    "final": Forest(450, min_leaf=2, weighted=True),
    "single": Forest(300),
    "baseline": Forest(450, weighted=True),
    "voting": Forest(450, depth=20),
    "regularised": Forest(600, depth=15, min_leaf=5, subset="sqrt", weighted=True),
    "classifier": Forest(300, subset="sqrt"),
}
# The compared learner's default of 20 rows for a leaf is stated here.
BOOSTINGS = {
    "comparison": Boosting(500, depth=15, weighted=True, leaves=40, min_leaf=20),
    "voting": Boosting(200),
}


def forest_regressor(p: Forest, weight: str | None = None, seed: int = SEED) -> RandomForestRegressor:
    depth = min(p.depth or DEEPEST, DEEPEST)
    out = RandomForestRegressor(numTrees=p.trees, maxDepth=depth, minInstancesPerNode=p.min_leaf, maxBins=p.bins,
                                featureSubsetStrategy=p.subset, seed=seed, cacheNodeIds=depth > 12, checkpointInterval=10)
    return out.setWeightCol(weight) if weight and p.weighted else out


def forest_classifier(p: Forest, seed: int = SEED) -> RandomForestClassifier:
    depth = min(p.depth or DEEPEST, DEEPEST)
    return RandomForestClassifier(numTrees=p.trees, maxDepth=depth, minInstancesPerNode=p.min_leaf, maxBins=p.bins,
                                  featureSubsetStrategy=p.subset, seed=seed, cacheNodeIds=depth > 12, checkpointInterval=10)


def boosting_regressor(p: Boosting, weight: str | None = None, seed: int = SEED) -> GBTRegressor:
    out = GBTRegressor(maxIter=p.rounds, stepSize=p.step, maxDepth=p.depth, maxBins=p.bins, seed=seed)
    return out.setWeightCol(weight) if weight and p.weighted else out


def fit_once(learner, data: DataFrame):
    """Fit on a cached table and release it; tree learners pass over it once per level."""
    data = data.persist()
    try:
        return learner.fit(data)
    finally:
        data.unpersist()


def fit_forest(p: Forest, data: DataFrame, weight: str | None = None, classifier: bool = False, seed: int = SEED):
    """A forest on ``features`` and ``label`` by the preset; ``weight`` counts where the preset is weighted."""
    if not p.deep:
        return fit_once(forest_classifier(p, seed) if classifier else forest_regressor(p, weight, seed), data)
    head = data.select("features").first()
    if head is None:
        raise ValueError("no training rows")
    return fit_deep_forest(data, p.spec(len(head[0]), seed), weight if p.weighted and not classifier else None, classifier)


def fit_boosting(p: Boosting, data: DataFrame, weight: str | None = None, seed: int = SEED):
    if not p.deep:
        return fit_once(boosting_regressor(p, weight, seed), data)
    return fit_boosted(data, p.how(), weight if p.weighted else None)


@dataclass(frozen=True)
class Voting:
    """Mean of the members' predictions."""

    members: tuple

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        names = [f"_vote{i}" for i in range(len(self.members))]
        for name, m in zip(names, self.members):
            out = m.copy().setPredictionCol(name).transform(out)
        total = sum((F.col(n) for n in names), F.lit(0.0))
        return out.withColumn("prediction", total / len(names)).drop(*names)


@dataclass(frozen=True)
class Routed:
    """A classifier sends each row to the model for normal or for extreme rows."""

    classifier: object
    normal: object
    extreme: object
    context: tuple[str, ...]
    features: tuple[str, ...]
    target: str

    def classify(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        both = assembled(df, self.context, self.target, carry=[*self.features, *carry])
        named = self.classifier.copy().setPredictionCol("predicted_class").setProbabilityCol("").setRawPredictionCol("")
        scored = named.transform(both)
        keep = [c for c in dict.fromkeys([*self.features, *carry]) if c in df.columns]
        return scored.select(*[col(c) for c in keep], F.col("label"), F.col("predicted_class").cast("int").alias("predicted_class"))

    def transform(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        routed = self.classify(df, carry)

        def part(model, cls):
            rows = routed.where(F.col("predicted_class") == cls)
            scored = assembled(rows.withColumnRenamed("label", "_y"), self.features, "_y", carry=[*carry, "predicted_class"])
            return model.transform(scored).drop("features")

        return part(self.normal, 0).unionByName(part(self.extreme, 1))


def fit_routed(train: DataFrame, features: Sequence[str], context: Sequence[str], target: str, label: str, class_column: str,
               forest: Forest, classifier: Forest, seed: int = SEED) -> Routed:
    """Classifier on contextual features; one regressor per side of the training labels."""
    sides = {"normal": train.where(col(label) == "normal"), "extreme": train.where(col(label).isin("valid", "suspicious"))}
    for name, rows in sides.items():
        if rows.isEmpty():
            raise ValueError(f"no {name} training rows")
    cls = fit_forest(classifier, assembled(train, context, class_column), classifier=True, seed=seed)
    a, b = (fit_forest(forest, assembled(rows, features, target), seed=seed) for rows in sides.values())
    return Routed(cls, a, b, tuple(context), tuple(features), target)
