"""Reproducible samples, hold-outs and folds from a hash of the row key.

Membership depends on key and seed alone: not on partitioning, order or retries.
Rows that share a key stay on the same side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import HASH_SPACE, col, hash52, small
from millrace.operators.quantiles import Rank, group_quantiles, order_stats

SEED = 42
TOP_N = 100_000


def exact_sample(df: DataFrame, key: str, n: int = 5_000, seed: int = SEED, columns: Sequence[str] | None = None) -> DataFrame:
    """``min(n, rows)`` rows with the smallest key hashes.

    Small samples are a bounded top-n. For large ones the n-th smallest hash is
    found by distributed selection and the sample is a filter, so that it never
    passes through one task.
    """
    out = df if columns is None else df.select(*[col(c) for c in dict.fromkeys([key, *columns])])
    if n <= TOP_N:
        return out.orderBy(hash52(key, seed), col(key)).limit(n)
    rank = Rank(0.0, smallest=n)
    cut = order_stats(out.select(hash52(key, seed).alias("_h")), {"_h": [rank]}).get((), {})["_h"][rank].value
    if cut is None:
        return out
    below = out.where(hash52(key, seed) < int(cut))
    ties = out.where(hash52(key, seed) == int(cut)).orderBy(col(key)).limit(n - below.count())
    return below.unionByName(ties)


def scope(df: DataFrame, key: str, sample_n: int | None = None, seed: int = SEED) -> DataFrame:
    """The whole table, or a reproducible sample when a size is asked for."""
    return df if sample_n is None else exact_sample(df, key, sample_n, seed)


def in_test(key: str, share: float = 0.2, seed: int = SEED):
    """Hold-out predicate by hash range: a projection, so no pass over the data is needed."""
    return hash52(key, seed) < F.lit(int(share * HASH_SPACE))


def holdout(df: DataFrame, key: str, share: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    test = in_test(key, share, seed)
    return df.where(~test), df.where(test)


def stratified_flag(df: DataFrame, key: str, stratum: str, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: per stratum the ``ceil(share * n)`` smallest hashes.

    The cut-offs are exact order statistics, found as a table that is joined
    back: there may be any number of strata, and one may hold most of the table.
    """
    hashed = df.withColumn("_h", hash52(key, seed).cast("double"))
    counts = hashed.groupBy(col(stratum).alias("_s"), "_h").agg(F.count(F.lit(1)).alias("copies"))
    cuts = group_quantiles(counts, ["_s"], "_h", [Rank(share, interpolated=False)])
    cuts = small(cuts.select("_s", F.col("q")[0].alias("_cut")))
    joined = hashed.join(cuts, col(stratum).eqNullSafe(F.col("_s")), "left")
    return joined.withColumn("is_test", F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))).drop("_h", "_s", "_cut")


def stratified_holdout(df: DataFrame, key: str, stratum: str, share: float = 0.2, seed: int = SEED):
    flagged = stratified_flag(df, key, stratum, share, seed)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")


def with_fold(df: DataFrame, key: str, k: int, seed: int = SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, F.pmod(hash52(key, seed + 1), F.lit(k)).cast("int"))
