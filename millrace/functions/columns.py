"""Column expressions shared by the operators; all of them stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SPACE = 1 << 52


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def true_or_false(cond: Column) -> Column:
    """Three-valued logic closed to two: an unknown comparison counts as false."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    return true_or_false(cond).cast("int")


def one_row(table: DataFrame) -> Column:
    """A one-row table as a struct column of another query: a scalar subquery, not a join."""
    return table.select(F.struct(*[col(c) for c in table.columns]).alias("_row")).scalar()


def finite(c: str | Column) -> Column:
    """NaN and both infinities become NULL."""
    c = col(c)
    return F.when(~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))), c)


def finite_table(df: DataFrame) -> DataFrame:
    """Apply ``finite`` to every floating point column of the table."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[finite(c).alias(c) if c in real else col(c) for c in df.columns])


def ratio(a: str | Column, b: str | Column, epsilon: float = 1e-5) -> Column:
    return F.try_divide(col(a).cast("double"), col(b).cast("double") + F.lit(float(epsilon)))


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``; 0 where the whole is 0."""
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole.cast("double")), F.lit(0.0))


def hash52(key: str | Column, seed: int) -> Column:
    """52-bit integer from md5 of ``key:seed``; independent of partitioning and exact as a double."""
    text = F.concat(col(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def lookup(c: str | Column, table: dict[str, float], default: float) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), F.coalesce(col(c).cast("string"), F.lit(""))), F.lit(default))


def relabel(c: str | Column, names: dict) -> Column:
    """Value to display name; values without a name become NULL."""
    out = None
    for value, name in names.items():
        out = F.when(col(c) == F.lit(value), name) if out is None else out.when(col(c) == F.lit(value), name)
    return out


def clip(c: str | Column, low: float, high: float) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def sanitised(names: Iterable[str], pattern: str = r"[^0-9A-Za-z_\-]") -> list[str]:
    """Names safe for features and artefacts; clashes get a numeric suffix."""
    used: set[str] = set()
    out = []
    for name in names:
        base = clean = re.sub(pattern, "_", name)
        n = 1
        while clean in used:
            n += 1
            clean = f"{base}_{n}"
        used.add(clean)
        out.append(clean)
    return out


SMALL_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    """A table of figures by group as the side of a join that goes to all tasks, if it is seen to have few rows; else as it is.

    Its size can't be estimated from its input, so it is counted. The wide side is then not dealt by a key of few values.
    """
    rows = df.limit(SMALL_ROWS + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= SMALL_ROWS else df
