"""Contextual outlier labels and the reports on them.

A row is *invalid* when its numbers cannot be right, *valid* when a high target
is explained by rush hour or weather, *suspicious* when it is not explained,
else *normal*.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.columns import col, percent, true_or_false
from millrace.operators.clean import Fence
from millrace.operators.quantiles import Rank, order_stats
from millrace.roles import LABEL_COLUMN, Roles, require_column

# Label names in report order, limits of the rules.
LABELS = ("normal", "valid", "suspicious", "invalid")
LOWEST_TARGET = -3.0
Z_LIMIT = 3.0
TOP_SHARE = 0.99
# Shares (percent of outliers) at which the reading of the report changes.
QUALITY_SHARE = 20.0
UNEXPLAINED_SHARE = 40.0


@dataclass(frozen=True)
class OutlierRules:
    """Frozen thresholds of the target; applying them is a pure projection."""

    fence: Fence
    top: float | None
    mean: float | None = None
    std: float | None = None
    lowest: float = LOWEST_TARGET
    z_limit: float = Z_LIMIT
    low_side: bool = True
    roles: Roles = Roles()

    def outside_fence(self) -> Column:
        return self.fence.outside(self.roles.target)

    def in_top(self) -> Column:
        return F.lit(False) if self.top is None else true_or_false(col(self.roles.target) >= F.lit(self.top))

    def high(self) -> Column:
        if self.fence.high is None:
            return F.lit(False)
        return true_or_false(col(self.roles.target) > F.lit(self.fence.high)) | self.in_top()

    def beyond_z(self) -> Column:
        """Population z-score beyond the limit; nobody is beyond it when there is no spread."""
        if not self.std:
            return F.lit(False)
        return true_or_false(F.abs((col(self.roles.target) - F.lit(self.mean)) / F.lit(self.std)) > F.lit(self.z_limit))

    def impossible(self, have: set[str]) -> Column:
        bad = true_or_false(col(self.roles.target) < F.lit(self.lowest))
        if self.roles.speed in have:
            bad = bad | true_or_false(col(self.roles.speed) <= 0)
        if self.roles.duration in have:
            bad = bad | true_or_false(col(self.roles.duration) == 0)
        return bad

    def label(self, have: set[str]) -> Column:
        flags = [col(c) if c in have else F.lit(0) for c in (self.roles.is_rush_hour, self.roles.is_bad_weather)]
        explained = true_or_false(flags[0] == 1) | true_or_false(flags[1] == 1)
        unexplained = true_or_false(flags[0] == 0) & true_or_false(flags[1] == 0)
        out = (F.when(self.impossible(have), "invalid")
               .when(self.high() & explained, "valid")
               .when(self.high() & unexplained, "suspicious"))
        if self.low_side:
            out = out.when(self.outside_fence() | self.in_top(), "suspicious")
        return out.otherwise("normal")

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.roles.label, self.label(set(df.columns)))


def fit_outlier_rules(df: DataFrame, roles: Roles = Roles(), low_side: bool = True, winsorizer=None,
                      lowest: float = LOWEST_TARGET, width: float = 1.5, top: float = TOP_SHARE) -> OutlierRules:
    """Thresholds from the target. Given the winsorizer that made ``df``, its passes are reused.

    ``low_side=False`` is the inference variant for already cleaned tables: rows
    that are only low stay normal.
    """
    require_column(df, roles.target, "for outlier labels")
    if winsorizer is not None and all(Rank(p) in winsorizer.stats.get(roles.target, {}) for p in (0.25, 0.75, top)):
        q1, q3, q_top = (winsorizer.quantile_after(roles.target, p) for p in (0.25, 0.75, top))
    else:
        stats = order_stats(df, {roles.target: [0.25, 0.75, top]}).get((), {})[roles.target]
        q1, q3, q_top = (stats[Rank(p)].value for p in (0.25, 0.75, top))
    row = df.agg(F.avg(col(roles.target)).alias("m"), F.stddev_pop(col(roles.target)).alias("s")).first()
    return OutlierRules(Fence.around(q1, q3, width), q_top, row["m"], row["s"], lowest, low_side=low_side, roles=roles)


def ensure_labels(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    if roles.label in df.columns:
        return df
    return fit_outlier_rules(df, roles, low_side=False).transform(df)


def without_invalid(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    require_column(df, label, "to remove invalid rows")
    return df.where(~true_or_false(col(label) == "invalid"))


def with_labels(df: DataFrame, *wanted: str, label: str = LABEL_COLUMN) -> DataFrame:
    return df.where(col(label).isin(*wanted))


def is_outlier(label: str = LABEL_COLUMN) -> Column:
    return ~true_or_false(col(label) == "normal")


# ---- reports -------------------------------------------------------------------------


def detection_summary(df: DataFrame, rules: OutlierRules) -> DataFrame:
    """One row: quartiles, fences, top threshold and how many rows each rule marks."""
    f = rules.fence
    consts = {"q1": f.q1, "q3": f.q3, "iqr": f.iqr, "low_bound": f.low, "high_bound": f.high, "q99_threshold": rules.top,
              "z_threshold": rules.z_limit}
    counts = df.agg(
        F.count_if(rules.outside_fence()).alias("iqr_count"),
        F.count_if(rules.in_top()).alias("top_count"),
        F.count_if(rules.beyond_z()).alias("z_count"),
    )
    return counts.select(*[F.lit(v).cast("double").alias(k) for k, v in consts.items()], "iqr_count", "top_count", "z_count")


def label_counts(df: DataFrame, label: str = LABEL_COLUMN, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Rows per label in the fixed order, 0 for labels that do not occur."""
    order = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(labels)], "position int, outlier_type string")
    counts = df.groupBy(col(label).alias("outlier_type")).agg(F.count("*").alias("n"))
    return order.join(counts, "outlier_type", "left").select("position", "outlier_type", F.coalesce("n", F.lit(0)).alias("n"))


def outlier_counts(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row of counts and shares; shares of an empty set are 0."""
    label = col(roles.label)
    out = is_outlier(roles.label)
    have = set(df.columns)
    rush = true_or_false(col(roles.is_rush_hour) == 1) if roles.is_rush_hour in have else F.lit(False)
    weather = true_or_false(col(roles.is_bad_weather) == 1) if roles.is_bad_weather in have else F.lit(False)
    c = df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(out).alias("outlier_rows"),
        F.count_if(~out).alias("normal_rows"),
        *[F.count_if(true_or_false(label == x)).alias(x) for x in LABELS[1:]],
        F.count_if(out & rush).alias("rush_outliers"),
        F.count_if(out & weather).alias("weather_outliers"),
    )
    o, n = F.col("outlier_rows"), F.col("total_rows")
    return c.withColumns({
        "outliers_of_dataset_pct": percent(o, n),
        "valid_of_outliers_pct": percent(F.col("valid"), o),
        "suspicious_of_outliers_pct": percent(F.col("suspicious"), o),
        "invalid_of_outliers_pct": percent(F.col("invalid"), o),
        "outliers_in_rush_hour_pct": percent(F.col("rush_outliers"), o),
        "outliers_in_bad_weather_pct": percent(F.col("weather_outliers"), o),
    })


def outlier_hours(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return (df.where(is_outlier(roles.label)).groupBy(col(roles.hour).alias("hour"))
            .agg(F.count("*").alias("n")).orderBy("hour"))


def top_routes(df: DataFrame, k: int, roles: Roles = Roles()) -> DataFrame:
    """Routes by mean target, a missing route being a group of its own; ties by name."""
    means = df.groupBy(col(roles.route).alias("route")).agg(F.avg(col(roles.target)).alias("mean_target"))
    return means.where(F.col("mean_target").isNotNull()).orderBy(F.desc("mean_target"), F.asc_nulls_last("route")).limit(k)


def top_routes_report(df: DataFrame, roles: Roles = Roles(), k: int = 10, k_all: int = 15) -> DataFrame:
    """``(scope, route, mean_target)`` for outliers, normal rows and all rows.

    The three means come from one aggregate; the ranking limits each scope
    before it is shuffled.
    """
    out, x = is_outlier(roles.label), col(roles.target)
    scopes = {"outliers": (F.when(out, x), k), "normal": (F.when(~out, x), k), "all": (x, k_all)}
    means = df.groupBy(col(roles.route).alias("route")).agg(*[F.avg(v).alias(s) for s, (v, _) in scopes.items()])
    long = means.unpivot(["route"], list(scopes), "scope", "mean_target").where(F.col("mean_target").isNotNull())
    place = F.row_number().over(Window.partitionBy("scope").orderBy(F.desc("mean_target"), F.asc_nulls_last("route")))
    best = long.withColumn("_place", place).where(F.col("_place") <= max(k, k_all))
    wanted = F.when(F.col("scope") == "all", k_all).otherwise(k)
    return best.where(F.col("_place") <= wanted).select("scope", "route", "mean_target")


def target_by_outlier(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Mean and exact median of the target for outliers and for normal rows."""
    flagged = df.select(is_outlier(roles.label).alias("is_outlier"), col(roles.target).alias("x")).where(F.col("x").isNotNull())
    medians = order_stats(flagged, {"x": [0.5]}, by=["is_outlier"])
    table = df.sparkSession.createDataFrame(
        [(g[0], s["x"][Rank(0.5)].value) for g, s in medians.items()], "is_outlier boolean, median_target double")
    means = flagged.groupBy("is_outlier").agg(F.count("*").alias("n"), F.avg("x").alias("mean_target"))
    # two rows on either side
    return means.join(F.broadcast(table), "is_outlier")


def interpretation(counts: DataFrame) -> DataFrame:
    """Reading of an ``outlier_counts`` row: which remedy the shares call for."""
    verdict = (F.when(F.col("invalid_of_outliers_pct") >= QUALITY_SHARE, "data_quality")
               .when(F.col("suspicious_of_outliers_pct") >= UNEXPLAINED_SHARE, "unexplained")
               .otherwise("realistic"))
    advice = (F.when(F.col("verdict") == "data_quality", "review the invalid rows before modelling")
              .when(F.col("verdict") == "unexplained", "look for rare events or for features that are missing")
              .otherwise("keep the outliers and their labels"))
    return counts.withColumn("verdict", verdict).withColumn("advice", advice).select(
        "invalid_of_outliers_pct", "suspicious_of_outliers_pct", "outliers_in_rush_hour_pct", "verdict", "advice")


# ---- training filter ------------------------------------------------------------------


@dataclass(frozen=True)
class RobustFilter:
    """Keep rule for training rows: inside the fence, within the z limit, label not doubtful."""

    rules: OutlierRules
    removed_labels: tuple[str, ...] = ("invalid", "suspicious")

    def checks(self, have: set[str]) -> dict[str, Column]:
        target, label = self.rules.roles.target, self.rules.roles.label
        z = F.lit(True)
        if self.rules.std:
            z = true_or_false(F.abs((col(target) - F.lit(self.rules.mean)) / F.lit(self.rules.std)) <= F.lit(self.rules.z_limit))
        doubtful = true_or_false(col(label).isin(*self.removed_labels)) if label in have else F.lit(False)
        return {"iqr": self.rules.fence.inside(target), "z_score": z, "context": ~doubtful}

    def transform(self, df: DataFrame) -> DataFrame:
        a, b, c = self.checks(set(df.columns)).values()
        return df.where(a & b & c)

    def summary(self, df: DataFrame) -> DataFrame:
        checks = self.checks(set(df.columns))
        a, b, c = checks.values()
        return df.agg(F.count("*").alias("train_before"), F.count_if(a & b & c).alias("train_after"),
                      F.count_if(~(a & b & c)).alias("removed_total"),
                      *[F.count_if(~x).alias(f"removed_{n}") for n, x in checks.items()])


def fit_robust_filter(train: DataFrame, roles: Roles = Roles()) -> RobustFilter:
    return RobustFilter(fit_outlier_rules(train, roles))
