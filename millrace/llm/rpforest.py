"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: a node is split half way between two of
its vectors. Every vector of the table is then dealt to one leaf of each tree. A
query goes through all trees with one priority queue, nearest branch
first, until the leaves it has opened hold a share of all vectors, each counted
once whatever the number of trees that bring it; the sample stands for the table. All vectors of
these leaves are compared exactly, in double precision, on the original values.

Equal vectors are one entry with their least ids, so a vector that a third of the table
shares fills no leaf. A leaf is compared in blocks of bounded size, whatever its size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import staged

#: Numbers (rows times size) that trees are fitted on at most; trees; rows of the sample in a leaf.
FIT_VALUES, TREES, LEAF = 2_000_000, 10, 64
#: Distinct vectors that a query's leaves hold before it stops, as a share of all and at least.
#: Vectors without any structure (64 normal numbers) need the share for 0.9 of the neighbours; those in clusters need less.
SEARCH_SHARE, SEARCH_LEAST = 0.6, 4_000
#: Distinct vectors in a block of a leaf.
BLOCK, SALTS = 4096, 64


@dataclass(frozen=True)
class Tree:
    """Inner node i goes to ``below[i, 0]`` if normal[i] . v < offset[i], else to ``below[i, 1]``; a negative entry is leaf -1 - entry."""

    normal: np.ndarray
    offset: np.ndarray
    below: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64) if len(self.normal) else np.full(len(vectors), -1, np.int64)
        while (inner := at >= 0).any():
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.normal[node]) >= self.offset[node]
            at[inner] = self.below[node, side.astype(np.int64)]
        return -1 - at


def grow(sample: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    r = np.random.default_rng(seed)
    normal, offset, below, leaves = [], [], [], 0
    todo: list[tuple[np.ndarray, tuple[int, int] | None]] = [(np.arange(len(sample)), None)]
    while todo:
        rows, link = todo.pop()
        split = _halves(sample, rows, r) if len(rows) > leaf else None
        if split is None:
            name, leaves = -1 - leaves, leaves + 1
        else:
            name = len(normal)
            normal.append(split[0])
            offset.append(split[1])
            below.append([0, 0])
            todo += [(split[2], (name, 0)), (split[3], (name, 1))]
        if link:
            below[link[0]][link[1]] = name
    d = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normal).reshape(-1, d), np.array(offset), np.array(below, np.int64).reshape(-1, 2), leaves)


def _halves(sample: np.ndarray, rows: np.ndarray, r: np.random.Generator):
    """A plane half way between the means of two random parts that are drawn to two random vectors; None if nothing is split."""
    for _ in range(5):
        a, b = sample[r.choice(rows, 2, replace=False)]
        few = sample[r.choice(rows, min(len(rows), 256), replace=False)]
        for _ in range(3):
            near = ((few - a) ** 2).sum(1) < ((few - b) ** 2).sum(1)
            if near.all() or not near.any():
                break
            a, b = few[near].mean(0), few[~near].mean(0)
        plane = b - a
        length = np.sqrt(plane @ plane)
        if length == 0 or not np.isfinite(length):
            continue
        plane = plane / length
        at = float(plane @ (a + b) / 2)
        right = sample[rows] @ plane >= at
        if 0 < right.sum() < len(rows):
            return plane, at, rows[~right], rows[right]
    return None


def members_of(trees: list[Tree], sample: np.ndarray) -> list[list[np.ndarray]]:
    """Rows of the sample in each leaf of each tree."""
    out = []
    for tree in trees:
        leaf = tree.leaf_of(sample)
        out.append(np.split(np.argsort(leaf, kind="stable"), np.cumsum(np.bincount(leaf, minlength=tree.leaves))[:-1]))
    return out


def leaves_of(trees: list[Tree], inside: list[list[np.ndarray]], n: int, query: np.ndarray, enough: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(tree, leaf) that a query opens: one queue for all trees, the branch with the least violated plane first.

    It stops when the leaves hold ``enough`` different ones of the ``n`` rows that ``inside`` deals to them; also which these are.
    """
    queue, out, held, turn, seen = [], [], 0, 0, np.zeros(n, bool)
    for t, tree in enumerate(trees):
        queue.append((0.0, turn, t, 0 if len(tree.normal) else -1))
        turn += 1
    heapq.heapify(queue)
    margins = [tree.normal @ query - tree.offset for tree in trees]
    while queue and held < enough:
        crossed, _, t, at = heapq.heappop(queue)
        if at < 0:
            out.append((t, -1 - at))
            rows = inside[t][-1 - at]
            held += len(rows) - int(np.count_nonzero(seen[rows]))
            seen[rows] = True
            continue
        margin = float(margins[t][at])
        side = int(margin >= 0)
        for s in (0, 1):
            heapq.heappush(queue, (crossed if s == side else max(crossed, abs(margin)), turn, t, int(trees[t].below[at, s])))
            turn += 1
    return out, seen


def within(sample: np.ndarray, query: np.ndarray, k: int) -> float:
    """A distance within which ``k`` of the sample's vectors lie: what is farther is none of the ``k`` nearest of a table that holds them."""
    if len(sample) < k:
        return float("inf")
    return float(np.partition(np.sqrt(((sample - query) ** 2).sum(axis=1)), k - 1)[k - 1]) * (1 + 1e-9)  # sums may round in another way


def usable(vector: Column) -> Column:
    """Not null, some component, all of them finite and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stacked(column) -> np.ndarray:
    return np.stack(column.to_numpy() if hasattr(column, "to_numpy") else column).astype(np.float64)


def nearest(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", seed: int = 5, trees: int = TREES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key``, ``score``: the ``k`` nearest found of each query row, by Euclidean distance, ties to the smaller id.

    All rows but the query's own are candidates; fewer than ``k`` come back if
    there are fewer. Rows that are not ``usable``, have a null id, or a size other than the
    commonest one, take no part. Rows with one id and vector count once. An empty table gives an empty result.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    commonest = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if commonest is None:
        return df.sparkSession.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    size = commonest["d"]
    rows = rows.filter(F.size("v") == size)
    salted = Window.partitionBy("v", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy("id")
    least = rows.select("id", "v").withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k + 1)
    entries = least.groupBy("v").agg(F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("ids"))  # SALTS * (k + 1) ids for each at most
    entries = entries.withColumn("name", F.col("ids")[0])
    sample = np.array([r["v"] for r in entries.orderBy(F.xxhash64("name"), "name").limit(max(2, FIT_VALUES // size)).select("v").collect()])
    forest = [grow(sample, seed + t) for t in range(trees)]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, size)
                found = np.stack([t.leaf_of(v) for t in forest], axis=1)
                leaves = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(forest), pa.int32()), pa.array(found.reshape(-1), pa.int32()))
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("name", "ids", "v")], leaves], names=["name", "ids", "v", "leaves"])

    indexed = staged(entries.select("name", "ids", "v").mapInArrow(index, "name long, ids array<bigint>, v array<double>, leaves array<int>"), "forest")
    in_leaf = indexed.select("name", "ids", "v", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    for r in in_leaf.groupBy("tree", "leaf").count().collect():  # as many rows as the forest has leaves
        sizes[r["tree"]][r["leaf"]] = r["count"]
    share = max(SEARCH_SHARE, SEARCH_LEAST / int(sizes[0].sum()))
    inside, enough = members_of(forest, sample), math.ceil(min(share, 1.0) * len(sample))
    blocks = [np.maximum(1, -(-s // BLOCK)) for s in sizes]

    queries = rows.filter("q").select("id", "v").distinct()
    alike = queries.groupBy("v").agg(F.min("id").alias("search"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, v in zip(batch.column("search").to_pylist(), batch.column("v").to_pylist(), strict=True):
                opened, seen = leaves_of(forest, inside, len(sample), np.array(v), enough)
                cells = [(t, leaf, b) for t, leaf in opened for b in range(blocks[t][leaf])]
                n = len(cells)
                columns = [pa.array([name] * n, pa.int64()), pa.array([v] * n, pa.list_(pa.float64())), pa.array([within(sample[seen], np.array(v), k + 1)] * n, pa.float64()), *[pa.array([c[i] for c in cells], pa.int32()) for i in range(3)]]
                yield pa.RecordBatch.from_arrays(columns, names=["search", "v", "bound", "tree", "leaf", "block"])

    visits = alike.select("search", "v").mapInArrow(visit, "search long, v array<double>, bound double, tree int, leaf int, block int")
    block_of = F.element_at(F.element_at(F.lit([b.tolist() for b in blocks]), F.col("tree") + 1), F.col("leaf") + 1)
    members = in_leaf.withColumn("block", F.pmod(F.xxhash64("name"), block_of).cast("int"))

    def rerank(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(members):
            v, ids = _stacked(members["v"]), list(members["ids"])
            for search, q, bound in zip(queries["search"], queries["v"], queries["bound"], strict=True):
                distance = np.sqrt(((v - np.asarray(q, np.float64)) ** 2).sum(axis=1))
                near = np.flatnonzero(distance <= min(bound, np.partition(distance, min(k, len(distance) - 1))[min(k, len(distance) - 1)]))
                found = sorted((distance[i], int(x)) for i in near for x in ids[i])[: k + 1]
                out += [(search, x, d) for d, x in found]
        return pd.DataFrame(out, columns=["search", "found", "score"]).astype({"search": "int64", "found": "int64", "score": "float64"})

    place = ["tree", "leaf", "block"]
    pairs = visits.groupBy(*place).cogroup(members.select(*place, "ids", "v").groupBy(*place)).applyInPandas(rerank, "search long, found long, score double")
    best = Window.partitionBy("search").orderBy("score", "found")
    pairs = pairs.groupBy("search", "found").agg(F.min("score").alias("score")).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    answers = queries.join(alike.select("v", "search"), "v").select("id", "search").join(pairs.drop("r"), "search").filter("id <> found")
    final = Window.partitionBy("id").orderBy("score", "found")
    return answers.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", F.col("found").alias(key), "score")
