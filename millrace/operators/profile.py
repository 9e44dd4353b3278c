"""Type audit, completeness and quality profiles, shape report."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, percent
from millrace.operators.clean import duplicate_rows
from millrace.roles import Roles, role_groups


def type_audit(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None, roles: Roles = Roles()) -> DataFrame:
    """``(group, column, present, dtype)`` for the expected columns and for unexpected ones; metadata only."""
    groups = groups or role_groups(roles)
    kinds = dict(df.dtypes)
    rows = [(g, c, c in kinds, kinds.get(c)) for g, cs in groups.items() for c in cs]
    expected = {c for cs in groups.values() for c in cs}
    rows += [("other", c, True, t) for c, t in df.dtypes if c not in expected]
    return df.sparkSession.createDataFrame(rows, "group string, column string, present boolean, dtype string")


def completeness(df: DataFrame) -> DataFrame:
    """``(column, rows, nulls, complete_pct)`` from one aggregate."""
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls"),
                        (F.lit(100.0) - percent(F.col(f"n{i}"), F.col("rows"))).alias("complete_pct"))
               for i, c in enumerate(df.columns)]
    return row.select(F.inline(F.array(*entries)))


def completeness_totals(df: DataFrame) -> DataFrame:
    """One row: rows, columns, cells, complete and null cells."""
    width = len(df.columns)
    nulls = sum((F.count_if(col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(F.count("*").alias("rows"), nulls.cast("bigint").alias("null_cells")).select(
        "rows", F.lit(width).cast("bigint").alias("columns"), (F.col("rows") * width).alias("total_cells"),
        (F.col("rows") * width - F.col("null_cells")).alias("complete_cells"), "null_cells")


def quality(df: DataFrame, determined: Collection[str] = ()) -> DataFrame:
    """One row: missing cells, duplicate rows and the score ``100 - share of missing cells``.

    ``determined`` are columns that cannot tell rows apart, as in ``duplicate_rows``.
    """
    totals = completeness_totals(df)
    score = F.lit(100.0) - percent(F.col("null_cells"), F.col("total_cells"))
    return totals.select(F.col("null_cells").alias("total_missing"), duplicate_rows(df, determined).scalar().alias("duplicate_rows"),
                         score.alias("quality_score"))


def shape_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: shapes before and after processing and the columns that are left."""
    rows = [t.agg(F.count("*").alias("rows")) for t in (before, after)]
    return rows[0].select(
        F.col("rows").alias("original_rows"), F.lit(len(before.columns)).alias("original_columns"),
        rows[1].scalar().alias("processed_rows"), F.lit(len(after.columns)).alias("processed_columns"),
        F.array(*[F.lit(c) for c in after.columns]).alias("processed_column_names"))
