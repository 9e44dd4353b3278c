"""Cleaning: median imputation, de-duplication, fence counts, winsorizing, readiness clean-up.

Everything that is learned from data is learned by ``fit_*`` and frozen, so the
same numbers can be applied to a hold-out or to a stream.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import clip, col, true_or_false
from millrace.operators.quantiles import SALTS, Rank, medians, order_stats
from millrace.roles import numeric_columns

FENCE = 1.5
MAX_DISCRETE = 10


@dataclass(frozen=True)
class MedianImputer:
    rows: int
    nulls: dict[str, int]
    values: dict[str, float | None]
    columns: tuple[str, ...] = ()

    @property
    def imputed(self) -> list[str]:
        return [c for c in self.values if self.values[c] is not None]

    def transform(self, df: DataFrame, only: Collection[str] | None = None) -> DataFrame:
        """Candidate columns become DOUBLE whether or not they had gaps, so the schema does not depend on data."""
        new = {}
        for c in self.columns if only is None else [c for c in self.columns if c in only]:
            x = col(c).cast("double")
            fill = self.values.get(c)
            new[c] = x if fill is None else F.coalesce(x, F.lit(float(fill)))
        return df.withColumns(new) if new else df


def fit_median_imputer(df: DataFrame, exclude: Sequence[str] = ()) -> MedianImputer:
    """Exact medians of the numeric columns that have NULLs; one counting pass finds those."""
    candidates = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, T.NumericType) and f.nullable and f.name not in exclude]
    row = df.agg(F.count("*").alias("n"), *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    nulls = {c: row["n"] - row[f"c{i}"] for i, c in enumerate(df.columns)}
    gaps = [c for c in candidates if nulls[c]]
    return MedianImputer(row["n"], nulls, medians(df, gaps, at_most=row["n"]) if gaps else {}, tuple(candidates))


def dedup(df: DataFrame, subset: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """Whole-row distinct, NULL equal to NULL. Copies collapse on the map side before the shuffle.

    A row ``key`` takes no part in the comparison: of rows that are equal but for it the smallest key stays.
    """
    if key is None or key not in df.columns:
        return df.dropDuplicates(list(subset) if subset else df.columns)
    compared = [c for c in df.columns if c != key]
    smallest = df.groupBy(*[col(c) for c in compared]).agg(F.min(col(key)).alias(key))
    return smallest.select(*[col(c) for c in df.columns])


def duplicate_rows(df: DataFrame, determined: Collection[str] = ()) -> DataFrame:
    """Number of rows beyond the first of each set of equal rows, as one row.

    ``determined`` are columns that need not be compared: the row key, and what follows from the others.
    """
    keys = [col(c) for c in df.columns if c not in determined]
    copies = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def _salted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as ``v0..``, with a salt by task: combined in two levels, no reducer reads the partial results of all tasks."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    values = [(col(c) + F.lit(0.0) if c in real else col(c)).alias(f"v{i}") for i, c in enumerate(columns)]  # no negative zero
    return df.select(*values, (F.spark_partition_id() % SALTS).alias("_salt"))


def rough_distinct(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, int]]:
    """``{column: (estimated distinct values, NULLs)}`` from bounded sketches in one pass."""
    if not columns:
        return {}
    salted = _salted(df, columns)
    sketches = salted.groupBy("_salt").agg(*[
        F.struct(F.hll_sketch_agg(F.when(F.col(f"v{i}").isNotNull(), F.xxhash64(f"v{i}"))).alias("h"),
                 F.count_if(F.col(f"v{i}").isNull()).alias("n")).alias(f"c{i}") for i in range(len(columns))])
    row = sketches.agg(*[F.struct(F.hll_sketch_estimate(F.hll_union_agg(f"c{i}.h")).alias("d"), F.sum(f"c{i}.n").alias("n")).alias(f"c{i}")
                         for i in range(len(columns))]).first()
    return {c: (row[f"c{i}"]["d"] or 0, row[f"c{i}"]["n"] or 0) for i, c in enumerate(columns)}


def listed_distinct(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact distinct counts of columns known to have few values: every task lists them."""
    if not columns:
        return {}
    lists = _salted(df, columns).groupBy("_salt").agg(*[F.collect_set(f"v{i}").alias(f"l{i}") for i in range(len(columns))])
    row = lists.agg(*[F.size(F.array_distinct(F.flatten(F.collect_list(f"l{i}")))).alias(f"d{i}") for i in range(len(columns))]).first()
    return {c: max(row[f"d{i}"] or 0, 0) for i, c in enumerate(columns)}


def distinct_at_most(df: DataFrame, columns: Sequence[str], limit: int) -> set[str]:
    """Columns with at most ``limit`` distinct non-null values, decided exactly.

    A bounded sketch clears the columns that are far above the limit; the
    doubtful ones have so few values that each task can list them.
    """
    doubtful = [c for c, (n, _) in rough_distinct(df, columns).items() if n <= 4 * limit + 10]
    return {c for c, n in listed_distinct(df, doubtful).items() if n <= limit}


@dataclass(frozen=True)
class Fence:
    q1: float | None
    q3: float | None
    low: float | None
    high: float | None

    @classmethod
    def around(cls, q1: float | None, q3: float | None, width: float = FENCE) -> Fence:
        if q1 is None or q3 is None:
            return cls(q1, q3, None, None)
        return cls(q1, q3, q1 - width * (q3 - q1), q3 + width * (q3 - q1))

    @property
    def iqr(self) -> float | None:
        return None if self.q1 is None else self.q3 - self.q1

    def outside(self, c):
        if self.low is None:
            return F.lit(False)
        return true_or_false((col(c) < F.lit(self.low)) | (col(c) > F.lit(self.high)))

    def inside(self, c):
        if self.low is None:
            return F.lit(False)
        return true_or_false((col(c) >= F.lit(self.low)) & (col(c) <= F.lit(self.high)))


def fit_fences(df: DataFrame, columns: Sequence[str], width: float = FENCE) -> dict[str, Fence]:
    found = order_stats(df, {c: [0.25, 0.75] for c in columns}).get((), {})
    return {c: Fence.around(found[c][Rank(0.25)].value, found[c][Rank(0.75)].value, width) for c in columns}


def fence_counts(df: DataFrame, columns: Sequence[str], guarded: bool = True, width: float = FENCE,
                 fences: dict[str, Fence] | None = None) -> DataFrame:
    """``(column, outlier_count)``: values strictly outside the fences.

    Guarded, a column with few distinct values or no spread counts 0; the skew
    report counts unguarded.
    """
    columns = [c for c in columns if c in df.columns]
    fences = fences or fit_fences(df, columns, width)
    skip = set()
    if guarded:
        skip = distinct_at_most(df, columns, MAX_DISCRETE)
        skip |= {c for c in columns if fences[c].iqr is None or fences[c].iqr <= 0}
    counts = df.agg(*[(F.lit(0) if c in skip else F.count_if(fences[c].outside(c))).cast("bigint").alias(c)
                      for c in columns])
    return counts.unpivot([], columns, "column", "outlier_count")


@dataclass(frozen=True)
class Winsorizer:
    """Frozen clip bounds, with the order statistics they came from."""

    bounds: dict[str, tuple[float | None, float | None]]
    stats: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in self.bounds.items() if lo is not None and c in df.columns})

    def summary(self, df: DataFrame) -> DataFrame:
        """``(column, p01, p99, values_clipped)`` over the table before clipping."""
        names = [c for c in self.bounds if self.bounds[c][0] is not None]
        changed = [F.count_if(true_or_false(col(c) != clip(c, *self.bounds[c]))).alias(c) for c in names]
        counts = df.agg(*changed).unpivot([], names, "column", "values_clipped")
        low = F.element_at(F.create_map(*[F.lit(x) for c in names for x in (c, float(self.bounds[c][0]))]), F.col("column"))
        high = F.element_at(F.create_map(*[F.lit(x) for c in names for x in (c, float(self.bounds[c][1]))]), F.col("column"))
        return counts.select("column", low.alias("p01"), high.alias("p99"), "values_clipped")

    def quantile_after(self, c: str, p: float) -> float | None:
        """Quantile of the clipped column, from the pass that found the bounds."""
        return self.stats[c][Rank(p)].clipped(*self.bounds[c])


def fit_winsorizer(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99,
                   also: Sequence[float] = (0.25, 0.75), at_most: int | None = None) -> Winsorizer:
    """Exact clip bounds; ``also`` are further quantiles read off in the same passes."""
    columns = [c for c in columns if c in df.columns]
    ps = sorted({lower, upper, *also})
    found = order_stats(df, {c: ps for c in columns}, at_most=at_most).get((), {})
    bounds = {c: (found[c][Rank(lower)].value, found[c][Rank(upper)].value) for c in columns}
    return Winsorizer(bounds, found)


def constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> list[str]:
    """Columns with one value only, NULL counted as a value: one aggregate, no distinct."""
    names = [c for c in df.columns if c not in keep]
    aggs = [F.struct(F.count(col(c)).alias("n"), F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias("same")).alias(f"c{i}")
            for i, c in enumerate(names)]
    row = df.agg(F.count("*").alias("rows"), *aggs).first()
    return [c for i, c in enumerate(names) if row[f"c{i}"]["same"] and row[f"c{i}"]["n"] in (0, row["rows"])]


def drop_constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*constant_columns(df, keep))


@dataclass(frozen=True)
class Cleaned:
    """Result of the cleaning chain: the table after each step and the frozen numbers."""

    imputer: MedianImputer
    deduped: DataFrame
    winsorizer: Winsorizer
    table: DataFrame

    def summary(self, before: DataFrame, targets: Sequence[str]) -> DataFrame:
        """Long table ``(measure, column, value)`` of the cleaning run."""
        spark = self.table.sparkSession
        counts = self.deduped.agg(
            F.count("*").cast("double").alias("rows_after_impute_dedup"),
            sum((F.count_if(col(c).isNull()) for c in self.deduped.columns), F.lit(0)).cast("double").alias("null_after"),
        ).unpivot([], ["rows_after_impute_dedup", "null_after"], "measure", "value").select("measure", F.lit("").alias("column"), "value")
        known = [("rows_before", "", float(self.imputer.rows)), ("null_before", "", float(sum(self.imputer.nulls.values())))]
        known += [("median_imputed", c, float(self.imputer.values[c])) for c in self.imputer.imputed]
        fixed = spark.createDataFrame(known, "measure string, column string, value double")
        fences = {c: Fence.around(self.winsorizer.stats[c][Rank(0.25)].value, self.winsorizer.stats[c][Rank(0.75)].value) for c in targets}
        iqr = fence_counts(self.deduped, targets, fences=fences).select(
            F.lit("iqr_outliers").alias("measure"), "column", F.col("outlier_count").cast("double").alias("value"))
        wins = self.winsorizer.summary(self.deduped).withColumn("values_clipped", F.col("values_clipped").cast("double"))
        wins = wins.unpivot(["column"], ["p01", "p99", "values_clipped"], "measure", "value").select("measure", "column", "value")
        return fixed.unionByName(counts).unionByName(iqr).unionByName(wins)


def clean(df: DataFrame, targets: Sequence[str], key: str | None = None, stage=None,
          recompute: Mapping[str, Column] | None = None) -> Cleaned:
    """Impute, then de-duplicate (but for the ``key``), then winsorize ``targets``, in that order.

    ``recompute`` names columns that are functions of the remaining raw ones
    (``features.recomputable``): they cannot tell rows apart, so they are left
    out of the de-duplicating shuffle and derived again behind it.

    ``stage`` (e.g. ``session.staged``) writes the de-duplicated table once, so
    the quantile passes and the consumers do not repeat its shuffle.
    """
    imputer = fit_median_imputer(df, exclude=[key] if key else [])
    recompute = {c: e for c, e in (recompute or {}).items() if c in df.columns}
    deduped = dedup(imputer.transform(df.drop(*recompute), [c for c in df.columns if c not in recompute]), key=key)
    if recompute:
        deduped = imputer.transform(deduped.withColumns(recompute), recompute).select(*[col(c) for c in df.columns])
    if stage is not None:
        deduped = stage(deduped)
    wins = fit_winsorizer(deduped, targets, at_most=imputer.rows)
    return Cleaned(imputer, deduped, wins, wins.transform(deduped))


def ready_for_learning(df: DataFrame, target: str, stage=None) -> tuple[DataFrame, list[str]]:
    """Last clean-up: rows equal after pruning are merged, constant columns dropped (never the target)."""
    unique = dedup(df)
    if stage is not None:
        unique = stage(unique)
    gone = constant_columns(unique, keep=[target])
    return unique.drop(*gone), gone


def continuous_columns(df: DataFrame, exclude_prefix: str = "route_") -> list[str]:
    """Numeric columns with more than ten distinct values, without indicator blocks."""
    names = [c for c in numeric_columns(df) if not c.startswith(exclude_prefix)]
    few = distinct_at_most(df, names, MAX_DISCRETE)
    return [c for c in names if c not in few]
