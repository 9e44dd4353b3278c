"""Encoding and column selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import col, flag, sanitised, small
from millrace.roles import LABEL_COLUMN, ROUTE_PREFIX, Roles, non_numeric_columns, numeric_columns
from millrace.session import staged

MAX_WIDE = 5_000  # columns a schema should not exceed; the vector has no such limit
# Roles that a routing classifier may see.
CONTEXT_FEATURES = ("hour_sin", "hour_cos", "day_of_week", "is_weekend", "is_rush_hour",
                    "is_bad_weather", "temperature", "wind", "rain")


def categories(df: DataFrame, name: str, limit: int = MAX_WIDE) -> list[str]:
    """Sorted distinct values of a column that is to become columns; refuses what no table can hold."""
    rows = df.select(col(name).alias("v")).where(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{name!r} has more than {limit} values: use fit_one_hot_vector")
    return sorted(r["v"] for r in rows)


def one_hot(df: DataFrame, name: str, values: Sequence[str] | None = None, prefix: str | None = None) -> DataFrame:
    """Wide 0/1 columns ``<prefix>_<value>`` for every value but the first in order; a missing value is all zeros."""
    values = list(values) if values is not None else categories(df, name)
    prefix = name if prefix is None else prefix
    new = [flag(col(name) == F.lit(v)).cast("tinyint").alias(f"{prefix}_{v}") for v in values[1:]]
    return df.select("*", *new)


@dataclass(frozen=True)
class CategoryVector:
    """Sparse indicator vectors from a table of values and slots; as many values as there are rows will do."""

    column: str
    output: str
    index: DataFrame
    slots: int

    def transform(self, df: DataFrame) -> DataFrame:
        known = self.index.select(F.col("value").alias("_value"), F.col("slot").cast("double").alias("_slot"))
        joined = df.join(small(known), col(self.column) == F.col("_value"), "left")
        # missing, unseen and the first value take the place behind the last slot, which the encoder leaves out
        placed = joined.withColumn("_place", F.coalesce(F.when(F.col("_slot") >= 0, F.col("_slot")), F.lit(float(self.slots))))
        ends = df.sparkSession.createDataFrame([(0.0,), (float(self.slots),)], "_place double")
        hot = OneHotEncoder(inputCol="_place", outputCol=self.output, dropLast=True).fit(ends)
        return hot.transform(placed).select(*[col(c) for c in df.columns if c != self.output], self.output)

    def save(self, path: str) -> None:
        self.index.withColumns({"column": F.lit(self.column), "output": F.lit(self.output), "slots": F.lit(self.slots)}).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> CategoryVector:
        table = spark.read.parquet(path)
        row = table.first()
        return CategoryVector(row["column"], row["output"], table.select("value", "slot"), row["slots"])


def fit_one_hot_vector(df: DataFrame, name: str, output: str | None = None, stage=staged) -> CategoryVector:
    """The same encoding as one sparse vector, for any number of values.

    The first value in order is the one left out; a missing value becomes all
    zeros too, and so does a value that was not there when the encoding was
    fitted. Values are numbered in order without a single task or the driver
    holding them: they are sorted by ranges, and a value's number is its place in
    its range plus the sizes of the ranges before.
    """
    values = df.select(col(name).alias("value")).where(F.col("value").isNotNull()).distinct()
    ranged = values.repartitionByRange("value").sortWithinPartitions("value").withColumn("id", F.monotonically_increasing_id())
    ranged = stage(ranged.select("value", F.shiftright("id", 33).cast("int").alias("range"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place")), "categories")
    sizes = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        raise ValueError(f"column {name!r} has no values to encode")
    before, offsets = 0, []
    for i in range(max(sizes) + 1):
        offsets.append(before)
        before += sizes.get(i, 0)
    starts = F.array(*[F.lit(x).cast("bigint") for x in offsets])
    index = ranged.select("value", (F.get(starts, F.col("range")) + F.col("place") - 1).alias("slot"))
    return CategoryVector(name, output or f"{name}_vector", index, before - 1)


def unused_columns(roles: Roles = Roles(), keep_label: bool = False) -> list[str]:
    """Raw text, already encoded and target-leaking columns."""
    names = [roles.timestamp, roles.origin, roles.destination, roles.route, roles.hour, roles.rain, roles.duration_actual]
    return names if keep_label else [*names, roles.label]


def prune(df: DataFrame, roles: Roles = Roles(), keep_label: bool = False) -> DataFrame:
    return df.drop(*[c for c in unused_columns(roles, keep_label) if c in df.columns])


def feature_columns(df: DataFrame, roles: Roles = Roles(), include_label_features: bool = False,
                    exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns but the target, the key and whatever was made from the target."""
    out = {roles.target, roles.key, "sample_weight", "label", *exclude}
    if not include_label_features:
        out |= {"target_class", LABEL_COLUMN}
    names = [c for c in numeric_columns(df) if c not in out]
    if not names:
        raise ValueError("no numeric feature columns")
    return names


def context_columns(df: DataFrame, roles: Roles = Roles()) -> list[str]:
    """Columns with a contextual role, under whatever name the table has them, and route indicators."""
    names = [c for c in (getattr(roles, role) for role in CONTEXT_FEATURES) if c in df.columns]
    names += [c for c in numeric_columns(df) if c.startswith(ROUTE_PREFIX)]
    if not names:
        raise ValueError("no contextual feature columns")
    return names


def assembled(df: DataFrame, features: Sequence[str], target: str, carry: Sequence[str] = ()) -> DataFrame:
    """``features`` vector and ``label``, with the columns to carry along."""
    known = df.where(col(target).isNotNull())
    carry = [c for c in carry if c in df.columns]
    out = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(known)
    return out.select("features", col(target).cast("double").alias("label"), *[col(c) for c in carry])


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitised(df.columns))


def column_plan(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """``(column, numeric, feature, contextual, safe_name)``: what each column will be used for; metadata only."""
    features, context = set(feature_columns(df, roles)), set(context_columns(df, roles))
    text = set(non_numeric_columns(df))
    rows = [(c, c not in text, c in features, c in context, s) for c, s in zip(df.columns, sanitised(df.columns))]
    return df.sparkSession.createDataFrame(
        rows, "column string, numeric boolean, feature boolean, contextual boolean, safe_name string")
