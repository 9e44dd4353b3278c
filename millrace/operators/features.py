"""Row-wise feature derivation: one projection, no shuffle, valid on streams too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, cyclic, finite_table, flag, lookup, ratio, relabel
from millrace.roles import LABEL_COLUMN, Roles, require_column

# Hours counted as rush hour, wind limit, label weights, target bins.
RUSH_HOURS = (7, 8, 9, 16, 17)
WIND_LIMIT = 8.0
LABEL_WEIGHTS = {"normal": 1.0, "valid": 1.0, "suspicious": 0.65, "invalid": 0.35}
TARGET_BINS = ((3.0, "Low"), (7.0, "Medium"), (None, "High"))

CREATED = ("hour", "day_of_week", "is_weekend", "route", "is_rush_hour", "is_bad_weather",
           "speed_normal", "hour_sin", "hour_cos")


def parsed_time(df: DataFrame, name: str):
    """Lenient parse: text that is no time becomes NULL instead of failing under ANSI mode."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return col(name)
    return col(name).try_cast("timestamp_ntz")


def _hour_columns(hour: Column, roles: Roles, rush_hours: Sequence[int]) -> dict[str, Column]:
    sine, cosine = cyclic(hour, 24)
    return {roles.is_rush_hour: flag(hour.isin(*rush_hours)), roles.hour_sin: sine, roles.hour_cos: cosine}


def recomputable(df: DataFrame, roles: Roles = Roles(), rush_hours: Sequence[int] = RUSH_HOURS) -> dict[str, Column]:
    """Features that follow from the time or the two places alone.

    They need not travel through a shuffle: drop them before and derive them after.
    """
    have, out = set(df.columns), {}
    if roles.timestamp in have:
        hour, day = F.hour(col(roles.timestamp)), F.weekday(col(roles.timestamp))
        out |= {roles.hour: hour, roles.day_of_week: day, roles.is_weekend: flag(day.isin(5, 6))}
        out |= _hour_columns(hour, roles, rush_hours)
    if {roles.origin, roles.destination} <= have:
        start, end = (F.coalesce(col(c).cast("string"), F.lit("unknown")) for c in (roles.origin, roles.destination))
        out[roles.route] = F.concat(start, F.lit(" → "), end)
    return out


def derive_features(
    df: DataFrame,
    roles: Roles = Roles(),
    rush_hours: Sequence[int] = RUSH_HOURS,
    wind_limit: float = WIND_LIMIT,
) -> DataFrame:
    """Add the time, route, flag, ratio and cyclic columns whose inputs the table has.

    Flags are taken before any imputation: a missing rain or wind counts as "no".
    """
    out = finite_table(df)
    if roles.timestamp in out.columns:
        out = out.withColumn(roles.timestamp, parsed_time(out, roles.timestamp))
    have = set(out.columns)
    new = recomputable(out, roles, rush_hours)
    if roles.hour in have and roles.timestamp not in have:
        new |= _hour_columns(col(roles.hour), roles, rush_hours)
    if {roles.rain, roles.wind} <= have:
        rain, wind = flag(col(roles.rain) > 0) == 1, flag(col(roles.wind) > F.lit(float(wind_limit))) == 1
        new[roles.is_bad_weather] = (rain | wind).cast("int")
    if {roles.distance, roles.duration} <= have:
        new[roles.speed] = ratio(roles.distance, roles.duration)
    # inputs are finite and the ratio is NULL on a zero divisor, so nothing non-finite is created
    return out.withColumns(new) if new else out


def with_target(df: DataFrame, task: str, roles: Roles = Roles()) -> tuple[DataFrame, str]:
    """Target for a task: the measured column, or its left-closed bins Low / Medium / High."""
    require_column(df, roles.target, "to build a target")
    kind = task.lower()
    if kind == "regression":
        return df, roles.target
    if kind == "classification":
        return df.withColumn("traffic_level", binned(roles.target)), "traffic_level"
    raise ValueError("task must be regression or classification")


def binned(name: str, bins: Sequence[tuple[float | None, str]] = TARGET_BINS):
    """Upper-open bins ``x < limit``; NULL stays NULL."""
    x = col(name)
    out = None
    for limit, text in bins:
        cond = x.isNotNull() if limit is None else x < F.lit(float(limit))
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return out


def bin_rank(name: str, bins: Sequence[tuple[float | None, str]] = TARGET_BINS):
    """Ordinal of each bin, for ordering the text labels."""
    return F.element_at(F.create_map(*[F.lit(x) for i, (_, t) in enumerate(bins) for x in (t, i)]), col(name))


def with_target_class(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """0 for normal rows, 1 for every other label (also a missing one)."""
    require_column(df, label, "to derive the class")
    return df.withColumn("target_class", 1 - flag(col(label) == "normal"))


def with_label_weight(df: DataFrame, label: str = LABEL_COLUMN, weights: dict[str, float] = LABEL_WEIGHTS) -> DataFrame:
    """Training weight by label; unknown and missing labels weigh 1. Without labels every row weighs 1."""
    weight = lookup(label, weights, 1.0) if label in df.columns else F.lit(1.0)
    return df.withColumn("sample_weight", weight)


def with_day_type(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumn("day_type", relabel(roles.is_weekend, {0: "Weekday", 1: "Weekend"}))
