"""Descriptive and robust statistics, fused into as few passes as possible."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col
from millrace.operators.clean import MAX_DISCRETE, distinct_at_most, fence_counts, listed_distinct, rough_distinct
from millrace.operators.quantiles import order_stats
from millrace.roles import ROUTE_PREFIX, numeric_columns

LISTED = 1_000
GRAM_SALTS = 32


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``(column, distinct_values, distinct_with_null)`` per column.

    Columns with few values are listed together in one pass. The others share
    one pass too, whatever their number: their values go through one distinct of
    (column, value). ``exact=False`` returns the sketched counts.
    """
    columns = list(columns or df.columns)
    rough = rough_distinct(df, columns)
    if exact:
        known = listed_distinct(df, [c for c in columns if rough[c][0] <= LISTED])
    else:
        known = {c: n for c, (n, _) in rough.items()}
    many = [c for c in columns if c not in known]
    if many:
        real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
        texts = [(col(c) + F.lit(0.0) if c in real else col(c)).cast("string") for c in many]  # no negative zero
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("at"), t.alias("value")) for i, t in enumerate(texts)])).alias("p")).select("p.*")
        found = pairs.where(F.col("value").isNotNull()).distinct().groupBy("at").agg(F.count(F.lit(1)).alias("n"))
        known |= dict.fromkeys(many, 0) | {many[r["at"]]: r["n"] for r in found.collect()}
    rows = [(c, known[c], known[c] + (1 if rough[c][1] else 0)) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, distinct_values bigint, distinct_with_null bigint")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)`` with the sample deviation and exact quartiles."""
    columns = list(columns)
    found = order_stats(df, {c: [0.25, 0.5, 0.75] for c in columns}).get((), {})
    quartiles = [(c, *[s.value for s in found[c].values()]) for c in columns]
    spark = df.sparkSession
    table = spark.createDataFrame(quartiles, "column string, q25 double, q50 double, q75 double")
    entries = [F.struct(F.lit(c).alias("column"), F.count(col(c)).alias("count"), F.avg(col(c)).alias("mean"),
                        F.stddev_samp(col(c).cast("double")).alias("std"), F.min(col(c).cast("double")).alias("min"),
                        F.max(col(c).cast("double")).alias("max")) for c in columns]
    moments = df.agg(*[e.alias(f"c{i}") for i, e in enumerate(entries)]).select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])))
    # one row per column
    return moments.join(F.broadcast(table), "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def indicator_columns(df: DataFrame) -> list[str]:
    """Numeric columns with at most two distinct values."""
    names = numeric_columns(df)
    few = distinct_at_most(df, names, 2)
    return [c for c in names if c in few]


def class_distribution(df: DataFrame, name: str) -> DataFrame:
    """``(class, n, pct)`` with missing counted as a class; the total comes from the few class rows."""
    counts = df.groupBy(col(name).alias("class")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select("class", "n", (F.lit(100.0) * F.col("n") / total).alias("pct"))


@dataclass(frozen=True)
class _Profile:
    rows: int
    values: int
    low: float | None
    high: float | None
    total: float

    @property
    def varies(self) -> bool:
        """More than one value, NULL being a value of its own."""
        return 0 < self.values < self.rows or (self.values > 0 and self.low < self.high)

    def __add__(self, other: _Profile) -> _Profile:
        ends = [x for x in (self.low, other.low) if x is not None], [x for x in (self.high, other.high) if x is not None]
        return _Profile(self.rows + other.rows, self.values + other.values, min(ends[0], default=None), max(ends[1], default=None),
                        self.total + other.total)


def _profiles(df: DataFrame, names: Sequence[str], part: Column) -> dict[bool, dict[str, _Profile]]:
    """Count, range and sum of every column, for the rows in and outside of ``part``; one pass."""
    base = df.select(part.alias("part"), *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    aggs = [F.expr(f"struct(count(x{i}) n, min(x{i}) lo, max(x{i}) hi, sum(x{i}) s) as c{i}") for i in range(len(names))]
    out = {}
    for row in base.groupBy("part").agg(F.count("*").alias("rows"), *aggs).collect():
        cells = [row[f"c{i}"] for i in range(len(names))]
        out[row["part"]] = {c: _Profile(row["rows"], s["n"], s["lo"], s["hi"], s["s"] or 0.0) for c, s in zip(names, cells)}
    return out


def _add_grams(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's masked Gram matrices by part: for each pair of columns the moments over the rows that have both."""
    p = len(centre)
    held: dict[bool, np.ndarray] = {}
    for batch in batches:
        part = np.asarray(batch.column("part").to_pylist(), bool)
        columns = [batch.column(f"x{i}") for i in range(p)]
        here = np.stack([np.asarray(c.is_valid()) for c in columns], 1)
        x = np.where(here, np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns], 1) - centre, 0.0)
        for which in (True, False):
            rows = part if which else ~part
            if rows.any():
                m, v = here[rows].astype(float), x[rows]
                sums = np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
                held[which] = held[which] + sums if which in held else sums
    task = TaskContext.get().partitionId()
    for which, sums in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([which]), pa.array([task], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["part", "task", "sums"])


def _merge_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the same part, which come one after the other, to one row, numbered by the first task."""

    def row(part, task, sums):
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([task], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["part", "task", "sums"])

    now, first, sums = None, 0, None
    for batch in batches:
        for part, task, data in zip(*[batch.column(n).to_pylist() for n in ("part", "task", "sums")], strict=True):
            if part != now:
                if now is not None:
                    yield row(now, first, sums)
                now, first, sums = part, task, np.zeros(len(data) // 8)
            sums = sums + np.frombuffer(data)
    if now is not None:
        yield row(now, first, sums)


def _products(df: DataFrame, names: Sequence[str], centre: dict[str, float], part: Column) -> dict[bool, np.ndarray]:
    """Per part the sums (n, a, a squared, a b) over the rows that have both columns, around the centre; they add up across parts.

    One pass whatever the number of columns: a task sends one set of matrices, and these are added in two levels.
    """
    p = len(names)
    base = df.select(part.alias("part"), *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).where(F.col("part").isNotNull())
    kind = "part boolean, task int, sums binary"
    middle = np.array([centre[c] for c in names])
    tasks = base.mapInArrow(lambda batches: _add_grams(batches, middle), kind).withColumn("salt", F.col("task") % GRAM_SALTS)
    level = tasks.repartition("part", "salt").sortWithinPartitions("part", "salt", "task").mapInArrow(_merge_grams, kind)
    whole = level.repartition("part").sortWithinPartitions("part", "task").mapInArrow(_merge_grams, kind)
    return {r["part"]: np.frombuffer(r["sums"]).reshape(4, p, p) for r in whole.collect()}


def _moments(sums: np.ndarray, i: int, j: int) -> tuple[float, ...]:
    n, one, two, both = sums
    return float(n[i, j]), float(one[i, j]), float(one[j, i]), float(two[i, j]), float(two[j, i]), float(both[i, j])


def _pearson(moments) -> float | None:
    n, sa, sb, qa, qb, p = moments
    if n < 2:
        return None
    va, vb = qa - sa * sa / n, qb - sb * sb / n
    return (p - sa * sb / n) / (va * vb) ** 0.5 if va > 0 and vb > 0 else None


def correlation_candidates(df: DataFrame) -> list[str]:
    """Numeric columns without indicator blocks; the names of a pair come in alphabetical order."""
    return sorted(c for c in numeric_columns(df) if not c.startswith(ROUTE_PREFIX))


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Upper triangle of the Pearson matrix as ``(feature_a, feature_b, corr)``, pairwise complete.

    Without a list, all numeric columns that vary. Two passes, however many
    columns: means, then the masked Gram matrices of the centred columns.
    """
    names = sorted(columns) if columns is not None else correlation_candidates(df)
    whole = _profiles(df, names, F.lit(True)).get(True, {}) if names else {}
    names = [c for c in names if c in whole and (columns is not None or whole[c].varies)]
    centre = {c: whole[c].total / max(whole[c].values, 1) for c in names}
    sums = _products(df, names, centre, F.lit(True)).get(True) if len(names) > 1 else None
    rows = [(a, b, _pearson(_moments(sums, i, j))) for (i, a), (j, b) in combinations(enumerate(names), 2)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def correlation_shift(df: DataFrame, part: Column, k: int = 10) -> DataFrame:
    """Pairs whose correlation among the rows of ``part`` differs most from that of the whole table.

    Considers the columns that vary in both. Whole and part come from the same
    two passes, as the moments of the part and of the rest add up.
    """
    names = correlation_candidates(df)
    split = _profiles(df, names, part)
    if True not in split:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, full_corr double, outlier_corr double, abs_delta double")
    whole = {c: split[True][c] + split[False][c] if False in split else split[True][c] for c in names}
    names = [c for c in names if whole[c].varies and split[True][c].varies]
    centre = {c: whole[c].total / max(whole[c].values, 1) for c in names}
    sums = _products(df, names, centre, part) if len(names) > 1 else {}
    rows = []
    for (i, a), (j, b) in combinations(enumerate(names), 2):
        rows.append((a, b, _pearson(_moments(sums[True] + sums.get(False, 0.0), i, j)), _pearson(_moments(sums[True], i, j))))
    table = df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, full_corr double, outlier_corr double")
    table = table.withColumn("abs_delta", F.abs(F.col("outlier_corr") - F.col("full_corr"))).where(F.col("abs_delta").isNotNull())
    return table.orderBy(F.desc("abs_delta"), "feature_a", "feature_b").limit(k)


def skewness(c: str | Column) -> Column:
    """Bias-corrected skewness; NULL for fewer than three values or no spread."""
    n = F.count(col(c)).cast("double")
    factor = F.when(n > 2, F.sqrt(n * (n - 1.0)) / F.when(n > 2, n - 2.0))
    return F.nanvl(F.skewness(col(c)), F.lit(None).cast("double")) * factor


def skew_ranking(df: DataFrame, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` most skewed columns, with the unguarded fence count of each.

    Candidates are continuous columns; where there are none, all numeric ones.
    """
    if columns is None:
        names = [c for c in numeric_columns(df)]
        plain = [c for c in names if not c.startswith(ROUTE_PREFIX)]
        few = distinct_at_most(df, plain, MAX_DISCRETE)
        columns = [c for c in plain if c not in few] or names
    columns = list(columns)
    row = df.agg(*[skewness(c).alias(f"s{i}") for i, c in enumerate(columns)])
    table = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("skewness"))
                                          for i, c in enumerate(columns)])))
    top = table.where(F.col("skewness").isNotNull()).orderBy(F.desc(F.abs("skewness")), "column").limit(k)
    return top.join(fence_counts(df, columns, guarded=False), "column")


def ols_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` in one aggregate."""
    a, b = col(y).cast("double"), col(x).cast("double")
    return df.agg(F.regr_slope(a, b).alias("slope"), F.regr_intercept(a, b).alias("intercept"),
                  F.regr_r2(a, b).alias("r2"), F.regr_count(a, b).alias("n"))
