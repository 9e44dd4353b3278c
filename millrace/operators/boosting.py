"""Boosted trees grown leaf by leaf.

A tree is grown best first: of all leaves the one whose best cut takes off most of
the squared error is split next, until the tree has its number of leaves. On the
cluster a pass over the rows adds up one histogram for each wanted node; of two
siblings only the one with fewer rows is counted, the other is its parent less
its sibling. As it isn't known beforehand which leaves will be split, a pass
counts for every leaf that still can be among the next ones, so a tree takes
about as many passes as it has levels, not as it has leaves; which of the splits
are used is then decided in the exact order of their gains.

Rows keep what they have been told so far; the trees of the last rounds are
evaluated on the way and written down every `CHAIN` rounds. A table that fits one
task goes through the same rounds there, without passes.
"""

from __future__ import annotations

import copy
import heapq
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.forest import BINS, UNLIMITED, Binned, Spec, _best_of_histogram, _binned, _opened, bin_table
from millrace.session import staged

#: Cells (rows x features) of a table that is boosted in one task. Rounds after which what the trees say is written down.
TASK_CELLS, CHAIN = 24_000_000, 16


@dataclass(frozen=True)
class Rounds:
    """How to boost: rounds, step, leaves (None: as many as the depth allows), depth, least rows of a leaf."""

    rounds: int
    step: float = 0.05
    leaves: int | None = None
    depth: int = UNLIMITED
    min_leaf: int = 1

    @property
    def splits(self) -> int:
        return (self.leaves or 2 ** min(self.depth, 20)) - 1


class Tree:
    """A tree as it grows; of every node its histogram's totals and best cut are known once it has been counted."""

    def __init__(self) -> None:
        self.feature, self.bin, self.left, self.value, self.gain, self.depth = [-1], [0], [0], [0.0], [0.0], [0]
        #: Of a finished tree: its nodes by their numbers in the tentative one.
        self.names: dict[int, int] = {}

    def split(self, node: int, cut: tuple) -> tuple[int, int]:
        feature, bin_, worth, _, _, low, high = cut
        left = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin_, left, worth
        for value in (low, high):
            self.feature.append(-1), self.bin.append(0), self.left.append(0), self.value.append(value), self.gain.append(0.0), self.depth.append(self.depth[node] + 1)
        return left, left + 1

    def arrays(self) -> dict[str, np.ndarray]:
        return {"feature": np.array(self.feature, np.int16), "bin": np.array(self.bin, np.uint8), "left": np.array(self.left, np.int32), "value": np.array(self.value), "gain": np.array(self.gain)}


def reach(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The leaf each row ends at."""
    at = np.zeros(len(bins), np.int64)
    inner = np.arange(len(bins)) if tree["feature"][0] >= 0 else np.zeros(0, int)
    while len(inner):
        node = at[inner]
        at[inner] = tree["left"][node] + (bins[inner, tree["feature"][node]] > tree["bin"][node])
        inner = inner[tree["feature"][at[inner]] >= 0]
    return at


def told(trees: Sequence[dict[str, np.ndarray]], bins: np.ndarray, step: float) -> np.ndarray:
    out = np.zeros(len(bins))
    for tree in trees:
        out += step * tree["value"][reach(tree, bins)]
    return out


def histogram(bins: np.ndarray, w: np.ndarray, wr: np.ndarray) -> np.ndarray:
    """(rows, weights, weighted residuals) x features x bins."""
    p, width = bins.shape[1], BINS + 1
    where = (bins + np.arange(p, dtype=np.int32) * width).ravel()
    return np.stack([np.bincount(where, minlength=p * width), *[np.bincount(where, np.repeat(x, p), p * width) for x in (w, wr)]]).reshape(3, p, width).astype(float)


def _grow(how: Rounds, counted: Callable[[Tree, list[int], dict[int, int]], dict[int, np.ndarray]], root: np.ndarray) -> Tree:
    """Best-first growth; ``counted`` gives the histograms of nodes of a tentative tree.

    The tentative tree is split ahead of the final one: its nodes are those for which a pass has been made.
    """
    limits = Spec(1, how.min_leaf, 0, how.depth)

    def best(sums: np.ndarray, depth: int) -> tuple | None:
        cut = _best_of_histogram(sums, limits, np.uint64(0), depth)
        # a gain that is nothing but rounding is none
        scale = float(np.abs(sums[2, 0]).sum()) ** 2 / max(1e-300, float(sums[1, 0].sum()))
        return cut if cut and cut[2] > 1e-12 * scale else None

    ahead = Tree()
    known = {0: root}
    cuts = {0: best(root, 0)}
    children: dict[int, tuple[int, int]] = {}
    while True:
        # replay the exact order with what is known
        final, names = Tree(), {0: 0}
        queue = [(-cuts[0][2], 0)] if cuts[0] else []
        left, open_ = how.splits, []
        while queue and left:
            _, node = queue[0]
            if node not in children:
                open_ = [n for _, n in heapq.nsmallest(left, queue) if n not in children]
                break
            heapq.heappop(queue)
            left -= 1
            for mine, other in zip(final.split(names[node], cuts[node]), children[node]):
                names[other] = mine
                if cuts[other]:
                    heapq.heappush(queue, (-cuts[other][2], other))
        if not open_:
            final.names = names
            return final
        few: dict[int, int] = {}
        for node in open_:
            children[node] = ahead.split(node, cuts[node])
            low, high = cuts[node][3], cuts[node][4]
            few[node] = children[node][0] if low <= high else children[node][1]
        sums = counted(ahead, sorted(few.values()), few)
        for node, less in few.items():
            a, b = children[node]
            more = b if less == a else a
            known[less] = sums[less]
            known[more] = known.pop(node) - sums[less]
            known[more][:2] = np.maximum(known[more][:2], 0)
            for child in (a, b):
                cuts[child] = best(known[child], ahead.depth[child])


def boost_rows(bins: np.ndarray, y: np.ndarray, w: np.ndarray, how: Rounds) -> Iterator[dict[str, np.ndarray]]:
    """The rounds over rows at hand, from a start of 0."""
    columns, said = np.ascontiguousarray(bins.T), np.zeros(len(y))
    plain = bool((w == 1).all())

    def sums_of(some: np.ndarray | None, wr: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """The histogram of some rows (None: all); ``known`` has rows and weights already."""
        out = np.empty((3, len(columns), BINS + 1))
        ww, rr = (w, wr) if some is None else (w.take(some), wr.take(some))
        for j, column in enumerate(columns):
            where = (column if some is None else column.take(some)).astype(np.intp)
            if known is None:
                out[0, j] = np.bincount(where, minlength=BINS + 1)
                out[1, j] = out[0, j] if plain else np.bincount(where, ww, BINS + 1)
            out[2, j] = np.bincount(where, rr, BINS + 1)
        if known is not None:
            out[:2] = known
        return out

    first = None
    for _ in range(how.rounds):
        wr = w * (y - said)
        rows, tentative = {0: np.arange(len(y))}, Tree()

        def counted(ahead: Tree, nodes: list[int], few: dict[int, int]) -> dict[int, np.ndarray]:
            nonlocal tentative
            tentative, out = ahead, {}
            for parent, less in few.items():
                mine = rows.pop(parent)
                left = columns[ahead.feature[parent]].take(mine) <= ahead.bin[parent]
                a = ahead.left[parent]
                rows[a], rows[a + 1] = mine.take(np.flatnonzero(left)), mine.take(np.flatnonzero(~left))
                out[less] = sums_of(rows[less], wr)
            return out

        root = sums_of(None, wr, first)
        first = root[:2].copy()
        tree = _grow(how, counted, root)
        for node, mine in tree.names.items():
            if tree.feature[mine] < 0:  # its rows may have been split ahead of it
                below = [node]
                for at in below:
                    if at in rows:
                        said[rows[at]] += how.step * tree.value[mine]
                    else:
                        below += [tentative.left[at], tentative.left[at] + 1]
        yield tree.arrays()


# ---- on the cluster ----------------------------------------------------------------------


def _counts(tree: dict | None, recent: list[dict], step: float, nodes: list[int], p: int):
    """A task's histograms of the wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, np.ndarray] = {}
        for _, _, _, bins, y, w, _ in _opened(batches, p):
            wr = w * (y - told(recent, bins, step))
            at = reach(tree, bins) if tree else np.zeros(len(y), np.int64)
            for node in nodes:
                mine = np.flatnonzero(at == node)
                if len(mine):
                    sums = histogram(bins[mine].astype(np.int32), w[mine], wr[mine])
                    held[node] = held[node] + sums if node in held else sums
        part = TaskContext.get().partitionId()
        for node, sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["node", "part", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a node's histogram, in the order of tasks, to one."""
    now, sums = None, None
    for batch in batches:
        for node, _, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if node != now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["node", "sums"])
                now, sums = node, np.zeros(len(data) // 8)
            sums += np.frombuffer(data)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["node", "sums"])


def _written_down(recent: list[dict], step: float, p: int):
    """Blocks whose target is what the trees leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [(y - told(recent, bins, step)).tobytes() for _, _, _, bins, y, _, _ in _opened(iter([batch]), p)]
            yield batch.set_column(batch.schema.get_field_index("y"), "y", pa.array(rest, pa.binary()))

    return run


def boost_table(table: Binned, how: Rounds) -> Iterator[dict[str, np.ndarray]]:
    """The rounds by passes over the blocks of a table of any size."""
    p, blocks = table.size, table.blocks
    recent: list[dict] = []

    def passed(tree: Tree | None, nodes: list[int]) -> dict[int, np.ndarray]:
        parts = blocks.mapInArrow(_counts(tree.arrays() if tree else None, list(recent), how.step, nodes, p), "node int, part int, sums binary")
        added = parts.repartition("node").sortWithinPartitions("node", "part").mapInArrow(_added, "node int, sums binary")
        return {r["node"]: np.frombuffer(r["sums"]).reshape(3, p, BINS + 1) for r in added.collect()}  # at most a node for each leaf

    for i in range(how.rounds):
        tree = _grow(how, lambda ahead, nodes, few: passed(ahead, nodes), passed(None, [0])[0].copy()).arrays()
        yield tree
        recent.append(tree)
        if len(recent) == CHAIN and i + 1 < how.rounds:
            blocks = staged(blocks.mapInArrow(_written_down(recent, how.step, p), blocks.schema), "residuals")
            recent = []


def _in_one_task(table: Binned, how: Rounds) -> list[dict[str, np.ndarray]]:
    names, p = ("feature", "bin", "left", "value", "gain"), table.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x[3:6] for x in _opened(batches, p)]
        if parts:
            bins, y, w = (np.concatenate(c) for c in zip(*parts))
            for i, tree in enumerate(boost_rows(bins, y, w, how)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([tree[n].tobytes()], pa.binary()) for n in names]], names=["round", *names])

    sorted_ = table.blocks.repartition(1).sortWithinPartitions("part", "number")
    rows = sorted_.mapInArrow(run, "round int, " + ", ".join(f"{n} binary" for n in names)).orderBy("round").collect()
    kinds = {n: a.dtype for n, a in Tree().arrays().items()}
    return [{n: np.frombuffer(r[n], kinds[n]) for n in names} for r in rows]


class Boosted:
    """A boosted model: ``transform`` adds the start and what all trees say; the trees are bounded by the rounds and leaves."""

    def __init__(self, how: Rounds, edges: list[list[float]], start: float, trees: list[dict[str, np.ndarray]]) -> None:
        self.how, self.edges, self.start, self.trees = how, edges, start, trees
        self.prediction_column = "prediction"

    def copy(self, extra=None) -> Boosted:
        return copy.copy(self)

    def setPredictionCol(self, name: str) -> Boosted:
        self.prediction_column = name
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        edges, trees, step, start = self.edges, self.trees, self.how.step, self.start

        @F.pandas_udf("double")
        def said(x: pd.Series) -> pd.Series:
            return pd.Series(start + told(trees, _binned(np.stack(x.to_numpy()), edges), step)) if len(x) else pd.Series([], dtype=float)

        return df.withColumn(self.prediction_column, said(vector_to_array("features")))

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import DenseVector

        total = np.zeros(len(self.edges))
        for tree in self.trees:
            inner = tree["feature"] >= 0
            np.add.at(total, tree["feature"][inner], tree["gain"][inner])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def save(self, spark: SparkSession, path: str) -> None:
        about = {"how": asdict(self.how), "edges": self.edges, "start": self.start, "trees": [{n: a.tolist() for n, a in t.items()} for t in self.trees]}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        about = json.loads(spark.read.schema("about string").json(path).first()[0])
        kinds = {n: a.dtype for n, a in Tree().arrays().items()}
        trees = [{n: np.array(t[n], kinds[n]) for n in kinds} for t in about["trees"]]
        return Boosted(Rounds(**about["how"]), about["edges"], about["start"], trees)


def fit_boosted(df: DataFrame, how: Rounds, weight: str | None = None) -> Boosted:
    """Least-squares boosting on ``features`` and ``label`` from the weighted mean on."""
    table = bin_table(df, weight=weight)
    if not table.n:
        raise ValueError("no training rows")
    mean = table.rows.agg(F.sum(F.col("__y") * F.col("__w")) / F.sum("__w")).first()[0]
    if not math.isfinite(mean):
        raise ValueError("labels must be finite")
    shifted = Binned(table.blocks.mapInArrow(_shifted(mean - table.middle, table.size), table.blocks.schema), table.rows, table.edges, mean, table.n)
    if table.n * max(1, table.size) <= TASK_CELLS:
        trees = _in_one_task(shifted, how)
    else:
        trees = list(boost_table(Binned(staged(shifted.blocks, "residuals"), table.rows, table.edges, mean, table.n), how))
    return Boosted(how, table.edges, mean, trees)


def _shifted(by: float, p: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [(y - by).tobytes() for _, _, _, _, y, _, _ in _opened(iter([batch]), p)]
            yield batch.set_column(batch.schema.get_field_index("y"), "y", pa.array(y, pa.binary()))

    return run
