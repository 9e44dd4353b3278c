"""The preprocessing run: scope, features, cleaning, labels, encoding, learning-ready table, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators import clean as cleaning
from millrace.operators import encode, features, outliers, profile, split, stats
from millrace.roles import Roles
from millrace.session import staged


@dataclass(frozen=True)
class Prepared:
    """Tables and frozen numbers of one run; every table is lazy but for the staged ones."""

    raw: DataFrame
    featured: DataFrame
    cleaned: cleaning.Cleaned
    rules: outliers.OutlierRules
    labelled: DataFrame
    modelling: DataFrame
    final: DataFrame
    dropped: tuple[str, ...]
    roles: Roles
    target: str


def prepare(raw: DataFrame, roles: Roles = Roles(), sample_n: int | None = None, task: str = "regression",
            one_hot: bool = False, stage: Callable[..., DataFrame] = staged) -> Prepared:
    """Whole-table preprocessing in the fixed order.

    The labelled table is staged once; reports, experiments and sinks read only
    the columns they need from it. ``one_hot`` adds the wide route block, which
    is sensible for few routes only.
    """
    scoped = split.scope(raw, roles.key, sample_n)
    featured = features.derive_features(scoped, roles)
    cleaned = cleaning.clean(featured, [roles.target, roles.speed], key=roles.key, stage=stage,
                             recompute=features.recomputable(featured, roles))
    rules = outliers.fit_outlier_rules(cleaned.table, roles, winsorizer=cleaned.winsorizer)
    labelled = rules.transform(cleaned.table)
    encoded = encode.one_hot(labelled, roles.route) if one_hot and roles.route in labelled.columns else labelled
    modelling, target = features.with_target(encode.prune(encoded, roles, keep_label=True), task, roles)
    keyless = modelling.drop(roles.label, roles.key)
    final, dropped = cleaning.ready_for_learning(keyless, target, stage=stage)
    return Prepared(scoped, featured, cleaned, rules, labelled, modelling, final, tuple(dropped), roles, target)


def _nested(table: DataFrame, name: str, *order: Column) -> DataFrame:
    """A small table as one row holding an array of structs, in the order of ``order``, then of the columns."""
    places = [c.alias(f"o{i}") for i, c in enumerate(order)]
    record = F.struct(*[col(c) for c in table.columns]).alias("record")
    rows = F.sort_array(F.collect_list(F.struct(*places, record)))
    return table.agg(F.transform(rows, lambda x: x["record"]).alias(name))


def _record(table: DataFrame, name: str) -> DataFrame:
    """A one-row table as one struct column."""
    return table.select(F.struct(*[col(c) for c in table.columns]).alias(name))


def report(p: Prepared) -> DataFrame:
    """The whole run as one nested row, ready for a JSON sink.

    Every part is a summary whose size depends on the number of columns, labels
    or hours, never on the number of rows.
    """
    roles, label = p.roles, p.labelled
    shift = stats.correlation_shift(label.drop(roles.key), outliers.is_outlier(roles.label))
    counts = outliers.outlier_counts(label, roles)
    parts = [
        _nested(profile.type_audit(p.raw, roles=roles), "type_groups"),
        _record(profile.completeness_totals(p.raw), "completeness_original"),
        _nested(profile.completeness(p.raw), "column_completeness_original"),
        _record(profile.completeness_totals(p.final), "completeness_final"),
        _nested(p.cleaned.summary(p.featured, [roles.target, roles.speed]), "cleaning"),
        _record(profile.quality(p.final), "quality"),
        _nested(stats.skew_ranking(p.final), "skewness", -F.abs("skewness")),
        _record(outliers.detection_summary(label, p.rules), "detection"),
        _record(counts, "outlier_counts"),
        _nested(outliers.outlier_hours(label, roles), "hour_distribution_outliers"),
        _nested(outliers.top_routes_report(label, roles), "top_routes", F.col("scope"), -F.col("mean_target")),
        _nested(outliers.target_by_outlier(label, roles), "target_summary"),
        _nested(shift, "correlation_shift", -F.col("abs_delta")),
        _record(outliers.interpretation(counts), "interpretation"),
        _record(profile.shape_report(p.raw, p.final), "shape"),
    ]
    if p.target == "traffic_level":
        parts.append(_nested(stats.class_distribution(p.final, p.target), "class_distribution"))
    return p.final.sparkSession.range(1).select(
        F.lit(p.target).alias("target"),
        F.array(*[F.lit(c) for c in features.CREATED]).alias("created_features"),
        F.array(*[F.lit(c) for c in p.dropped]).cast("array<string>").alias("zero_variance_columns_dropped"),
        *[t.scalar().alias(t.columns[0]) for t in parts])
