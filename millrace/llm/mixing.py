"""Mixing sources to target weights by Poisson replication.

Source s has the target weight w_s (as a share of all weights) and n_s documents
of N, so its mean repetition rate is r_s = w_s N / n_s. Each document draws its
own number of copies by inverting the Poisson distribution of that rate at a
number in [0, 1) made from a hash of seed and key: no state, no order, the same
on every retry. Copies are then shuffled globally: a second hash of seed, key
and copy is the place in [0, 1) at which a copy stands in the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import partitions

#: Hex digits of an MD5 hash that make a number in [0, 1): 52 bits.
DIGITS = 13
#: Sources up to which the small table of rates is sent to all tasks; beyond, Spark joins it by exchange and splits hot sources.
BROADCAST_SOURCES = 20_000
SEED = "mix-1"


def unit_hash(*parts: Column | str) -> Column:
    """A number in [0, 1) from the MD5 hash of the parts, joined by ':'; null parts read as empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_steps(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2, ... until it no longer grows.

    ``rate + 12 sqrt(rate) + 40`` terms leave less than 2^-53 above them. Large rates start from a
    log term, so that exp(-rate) does not vanish.
    """
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(40.0)).cast("int")
    log_terms = F.transform(F.sequence(F.lit(1), last), lambda i: F.log(rate) - F.log(i.cast("double")))
    start = F.array(F.struct((-rate).alias("log"), F.exp(-rate).alias("cdf")))
    steps = F.aggregate(
        log_terms,
        start,
        lambda done, term: F.concat(
            done,
            F.array(F.struct((F.element_at(done, -1)["log"] + term).alias("log"), (F.element_at(done, -1)["cdf"] + F.exp(F.element_at(done, -1)["log"] + term)).alias("cdf"))),
        ),
    )
    return F.when(rate > 0, F.transform(steps, lambda s: s["cdf"])).otherwise(F.array(F.lit(1.0)))


def rates(df: DataFrame, source: str = "source", weights: Mapping[str, float] | None = None, default: float = 1.0, power: float = 0.0) -> DataFrame:
    """One row for each source present: ``source``, ``n_docs``, ``rate``.

    ``weights`` are the target weights by source (a null source is called by
    the key ''); sources that it does not name have the weight ``default`` times
    their number of documents to the power ``power``: 0 makes them equal, 1 leaves them as they are.
    Sources without documents take no share.
    """
    if any(not (w >= 0 and math.isfinite(w)) for w in [*(weights or {}).values(), default]):
        raise ValueError("weights are finite and not negative")
    counts = df.groupBy(F.col(source).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    named = F.coalesce(F.col("source"), F.lit(""))
    weight = F.lit(float(default)) * F.pow(F.col("n_docs").cast("double"), F.lit(float(power)))
    for name, w in (weights or {}).items():
        weight = F.when(named == name, F.lit(float(w))).otherwise(weight)
    counts = counts.withColumn("weight", weight)
    docs, weights_sum = counts.agg(F.sum("n_docs"), F.sum("weight")).first()
    shared = F.col("weight") * F.lit(float(docs)) / (F.lit(float(weights_sum)) * F.col("n_docs")) if docs and weights_sum else F.lit(0.0)
    return counts.select("source", "n_docs", shared.alias("rate"))


def mix(df: DataFrame, source: str = "source", key: str = "doc_id", weights: Mapping[str, float] | None = None, default: float = 1.0, power: float = 0.0, seed: str = SEED) -> DataFrame:
    """Every row as often as its draw says, in global random order; new columns ``copy`` (from 1) and ``place``.

    ``place`` is the position in [0, 1); partitions and the rows in them follow
    it. A null source is a source of its own; a null key draws like the empty
    key; rows with one key draw alike, with its source's rate. Texts are not looked at. An
    empty table stays empty; input columns called ``copy`` or ``place`` are replaced.
    """
    kept = [c for c in df.columns if c not in ("copy", "place")]
    table = rates(df, source, weights, default, power)
    small = table.select(F.col("source").alias("__source"), poisson_steps(F.col("rate")).alias("__steps"))
    if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        small = F.broadcast(small)
    draw = unit_hash(F.lit(seed), F.col(key))
    copies = df.select(*[F.col(f"`{c}`") for c in kept]).join(small, F.col(source).cast("string").eqNullSafe(F.col("__source")))
    copies = copies.withColumn("__n", F.size(F.filter("__steps", lambda c: c <= draw)))
    copies = copies.filter("__n > 0").select(*[F.col(f"`{c}`") for c in kept], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    copies = copies.withColumn("place", unit_hash(F.lit(seed + "-place"), F.col(key), F.col("copy")))
    n = partitions(df)
    return copies.repartitionById(n, F.floor(F.col("place") * n).cast("int")).sortWithinPartitions("place", key, "copy")
