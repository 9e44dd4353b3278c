"""Connected components of links, as Spark joins that end after a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

_MOST_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) to ``node``, ``root``: the smallest node reachable, for each node that has a link.

    Alternating star contraction: in turn every node's larger and smaller
    neighbours are tied to its least neighbour. Each round is written to the
    shared folder, so lineage stays short. Minima are combined before the
    exchange, and a node with very many neighbours is only the wide side of a
    join whose other side has one row, which Spark splits.
    """
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(_MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        close = wide.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = staged(close.select("e.*").filter("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
