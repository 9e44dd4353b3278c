"""Column roles and explicit source schemas.

Operators never hard-wire column names: they take a ``Roles`` value and check,
at plan-building time, which of its columns the table has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LABEL_COLUMN = "outlier_type"
ROUTE_PREFIX = "route_"


@dataclass(frozen=True)
class Roles:
    key: str = "obs_id"
    timestamp: str = "timestamp"
    origin: str = "origin"
    destination: str = "destination"
    distance: str = "distance_km"
    duration: str = "duration_normal_min"
    duration_actual: str = "duration_traffic_min"
    target: str = "delay_min"
    temperature: str = "temperature"
    wind: str = "wind"
    rain: str = "rain"
    hour: str = "hour"
    day_of_week: str = "day_of_week"
    is_weekend: str = "is_weekend"
    is_rush_hour: str = "is_rush_hour"
    is_bad_weather: str = "is_bad_weather"
    route: str = "route"
    speed: str = "speed_normal"
    hour_sin: str = "hour_sin"
    hour_cos: str = "hour_cos"
    label: str = LABEL_COLUMN


def raw_schema(roles: Roles = Roles()) -> T.StructType:
    """Schema of the raw observation file; the timestamp stays text until parsed leniently."""
    text, number, whole = T.StringType(), T.DoubleType(), T.IntegerType()
    fields = [
        (roles.timestamp, text),
        (roles.origin, text),
        (roles.destination, text),
        (roles.distance, number),
        (roles.duration, number),
        (roles.duration_actual, number),
        (roles.target, number),
        (roles.hour, whole),
        (roles.day_of_week, whole),
        (roles.is_weekend, whole),
        (roles.temperature, number),
        (roles.wind, number),
        (roles.rain, number),
    ]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def role_groups(roles: Roles = Roles()) -> dict[str, list[str]]:
    """Columns expected per kind of data; the base of the type audit."""
    return {
        "numeric": [
            roles.distance,
            roles.duration,
            roles.duration_actual,
            roles.target,
            roles.temperature,
            roles.wind,
        ],
        "categorical": [roles.origin, roles.destination],
        "temporal": [roles.timestamp],
        "binary": [roles.is_weekend, roles.rain],
        "discrete": [roles.hour, roles.day_of_week],
    }


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def require_column(df: DataFrame, name: str, why: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column {name!r} is required {why}")


def require_numeric(df: DataFrame, name: str, why: str) -> None:
    require_column(df, name, why)
    if not isinstance(df.schema[name].dataType, T.NumericType):
        raise ValueError(f"column {name!r} must be numeric {why}")
