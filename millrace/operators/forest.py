"""Forests of unlimited depth, grown in two phases.

A table is binned once and written as blocks of rows. While a node of a tree
holds more rows than a task should, it is split on the cluster: every task adds
its rows to one histogram per node, the histograms are added up where the node
was dealt, and the best split comes back. When a node is small enough its rows
are dealt to one task that grows the rest of the tree below it. Which rows a tree
draws is a Poisson count from a hash of the row and the tree, so neither phase
moves or keeps a bootstrap sample. Every task is given a whole table of a bounded
size, and rows are not dealt at all.

Trees don't depend on each other or on the wanted depth: the first 450 of 800
trees are the forest of 450, and a tree of depth 20 is an unlimited one read down
to level 20. So several forests are grown as one, each tree once, and a whole grid
of numbers of trees and depths is read off it (`Cell`).

Scoring goes the same way: the subtrees and the rows that reach them are dealt to
the same tasks, and what the trees say is added up by row.
"""

from __future__ import annotations

import copy
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import staged

#: Most bins of a feature; cells (rows x features) of a node that one task grows (at 4 bytes each); rows of a block; nodes split at once.
BINS, TASK_CELLS, BLOCK_ROWS, NODES_AT_ONCE = 255, 24_000_000, 16_384, 2_000
#: Bytes of blocks, and of sums over their rows, up to which every task is given the whole table.
HELD_BYTES = 100_000_000
#: Sums by row that a task holds before it hands them on.
HELD_SUMS = 500_000
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
_U = np.uint64
UNLIMITED = 1 << 30


@dataclass(frozen=True)
class Spec:
    """One forest: its trees, leaf size, features tried per node (0: all), depth, seed, and the fold it must not see."""

    trees: int
    min_leaf: int = 1
    tried: int = 0
    depth: int = UNLIMITED
    seed: int = 42
    without_fold: int = -1


@dataclass(frozen=True)
class Cell:
    """A forest that is read off a grown one: its first ``trees`` trees, down to ``depth``."""

    spec: int
    trees: int
    depth: int = UNLIMITED


def _mix(x):
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _seed_of(spec: Spec, tree: int) -> np.uint64:
    return _mix(np.array([(spec.seed * 1_000_003 + tree) % 2**64], _U))[0]


def drawn(rows: np.ndarray, seed: np.uint64) -> np.ndarray:
    """How often a tree draws each row."""
    with np.errstate(over="ignore"):
        u = (_mix(rows.astype(_U) * _U(0x9E3779B97F4A7C15) + seed) >> _U(11)).astype(np.float64) * 2.0**-53
    return np.searchsorted(_POISSON, u, side="right")


def _child(path: np.ndarray, side: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(path * _U(2) + _U(side + 1))


def _tried(paths: np.ndarray, varying: np.ndarray, tried: int) -> np.ndarray:
    """Features by nodes: the ``tried`` features of a node, by hash among those that vary in it."""
    with np.errstate(over="ignore"):
        key = _mix(paths[None, :] + (np.arange(len(varying), dtype=_U) + _U(1))[:, None] * _U(0xD1342543DE82EF95)) >> _U(1)
    key = np.where(varying, key, _U(2**64 - 1))
    last = np.sort(key, axis=0)[min(tried, len(varying)) - 1]
    return varying & (key <= last)


def _best(gain: np.ndarray, before: float) -> tuple[int, int, float]:
    """The first feature, and of it the first bin, whose gain is the greatest but for rounding, and what it is worth; features by bins."""
    top = gain.max()
    worth = top - before
    near = gain >= _least(top, worth, before)
    feature = int(near.any(1).argmax())
    return feature, int(near[feature].argmax()), float(worth)


def _least(top, worth, before):
    """Gains that differ from the greatest by no more than rounding count as equal to it."""
    return top - 1e-9 * np.abs(worth) - 1e-13 * np.abs(before)


@dataclass
class Cells:
    """Of one feature the (node, bin) that hold rows, in this order: where each node's begin, their bins, sums of weights and targets, and rows if asked for."""

    begin: np.ndarray
    bins: np.ndarray
    w: np.ndarray
    s: np.ndarray
    rows: np.ndarray | None


def _summed(at: np.ndarray, n: int, w: np.ndarray, wy: np.ndarray, rows: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    return np.bincount(at, w, n), np.bincount(at, wy, n), np.bincount(at, minlength=n) if rows else None


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, min_leaf: int, depth: int, tried: int, path: np.uint64) -> dict[str, np.ndarray]:
    """A regression tree over binned rows by greatest decrease of the weighted squared error, all nodes of a level at once.

    Nodes in the order of levels: ``feature`` (-1: leaf), ``bin`` (rows at or below it go left), ``left`` (its neighbour is
    the right one), ``value``, ``gain``. Weights are positive. Of each feature every row knows its cell, the rows of its
    node and bin; cuts are found by running sums over the cells, and a split turns each cell into one for either side,
    of which the empty ones go. Nothing is sorted, so a level costs a few passes over the rows that are left. The nodes
    at work are all left children before all right ones; ``place`` tells where a node stands in its level.
    """
    n, p = bins.shape
    centre = float(np.average(y, weights=w))
    y = y - centre
    wy = w * y
    least = max(2, 2 * min_leaf)
    at = np.empty((p, n), np.int32)
    cells = []
    for j in range(p):
        column = np.ascontiguousarray(bins[:, j])
        there = np.bincount(column, minlength=BINS + 1) > 0
        np.take(np.cumsum(there, dtype=np.int32) - np.int32(1), column, out=at[j], mode="clip")
        held = np.flatnonzero(there)
        cells.append(Cells(np.zeros(1, np.intp), held.astype(np.uint8), *_summed(at[j], len(held), w, wy, min_leaf > 1)))
    made = {k: [] for k in ("feature", "bin", "left", "value", "gain")}
    here, value, total, level = 1, np.array([wy.sum() / w.sum() + centre]), 1, 0
    some = int(n >= least and y.max() > y.min())
    size, paths, place = np.array([n] * some, np.intp), np.array([path] * some, _U), np.zeros(some, np.intp)
    while True:
        feature, bin_, left, gain = np.full(here, -1, np.int16), np.zeros(here, np.uint8), np.zeros(here, np.int32), np.zeros(here)
        found = np.zeros(0, np.intp)
        if len(size) and level < depth:
            start = np.cumsum(size) - size
            f, cell, b, worth = _cuts(cells, size, paths, np.add.reduceat(w, start), np.add.reduceat(wy, start), min_leaf, tried)
            found = np.flatnonzero(f >= 0)
            mine = place[found]
            feature[mine], bin_[mine], gain[mine], left[mine] = f[found], b[found], worth[found], total + 2 * np.arange(len(found))
        for name, values in (("feature", feature), ("bin", bin_), ("left", left), ("value", value), ("gain", gain)):
            made[name].append(values)
        if not len(found):
            return {name: np.concatenate(values) for name, values in made.items()}
        # rows to the children
        goes = at.ravel().take(np.repeat(f * at.shape[1], size) + np.arange(len(y)), mode="clip") <= np.repeat(cell, size)
        lefts = np.add.reduceat(goes.astype(np.intp), start)[found]
        inside = np.repeat(f >= 0, size)
        rows = np.concatenate([np.flatnonzero(goes & inside), np.flatnonzero(~goes & inside)])
        size = np.concatenate([lefts, size[found] - lefts])
        y, w, wy = y[rows], w[rows], wy[rows]
        start = np.cumsum(size) - size
        place = np.concatenate([2 * np.arange(len(found)), 2 * np.arange(len(found)) + 1])
        here = len(place)
        value = np.empty(here)
        value[place] = np.add.reduceat(wy, start) / np.add.reduceat(w, start) + centre
        total += here
        level += 1
        # children that go on
        live = (size >= least) & (np.maximum.reduceat(y, start) > np.minimum.reduceat(y, start)) & (level < depth)
        keep = np.flatnonzero(np.repeat(live, size))
        rows, y, w, wy = rows[keep], y[keep], w[keep], wy[keep]
        on_the_left = int(size[: len(found)][live[: len(found)]].sum())
        size, place, paths = size[live], place[live], np.concatenate([_child(paths[found], 0), _child(paths[found], 1)])[live]
        if not len(size):
            continue
        new = np.empty(len(rows), np.int32)
        for j, old in enumerate(cells):
            n = len(old.bins)
            np.take(at[j], rows, out=new, mode="clip")
            new[on_the_left:] += n
            sums = _summed(new, 2 * n, w, wy, min_leaf > 1)
            there = sums[0] > 0
            number = np.cumsum(there, dtype=np.int32)
            begin = np.concatenate([old.begin[found], old.begin[found] + n])[live]
            begin = number[begin] - there[begin]
            number -= 1
            np.take(number, new, out=at[j, : len(rows)], mode="clip")
            held = np.flatnonzero(there)
            cells[j] = Cells(begin, np.concatenate([old.bins, old.bins])[held], *[x if x is None else x[held] for x in sums])


def _cuts(cells: list[Cells], size, paths, tw, ts, min_leaf: int, tried: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each node of a level the feature of its best cut (-1: none), the last cell on the left and its bin, and what it is worth.

    Of cuts that are equal but for rounding the first counts, by feature and bin.
    """
    wide = np.stack([np.diff(c.begin, append=len(c.bins)) for c in cells])
    asked = wide > 1
    if tried:
        asked &= _tried(paths, asked, tried)
    best, kept = np.full(wide.shape, -np.inf), []
    for j, c in enumerate(cells):
        who = np.flatnonzero(asked[j])
        if not len(who):
            kept.append(None)
            continue
        n = wide[j][who]
        first = np.cumsum(n) - n
        mine = np.flatnonzero(np.repeat(asked[j], wide[j]))
        gain = _gains(c.w[mine], c.s[mine], tw[who], ts[who], first, n)
        if min_leaf > 1:
            rows = _running(c.rows[mine], first, n)
            gain[(rows < min_leaf) | (np.repeat(size[who], n) - rows < min_leaf)] = -np.inf
        best[j, who] = np.maximum.reduceat(gain, first)
        kept.append((gain, mine, who, first, n))
    top, before = best.max(0), ts * ts / tw
    good = np.isfinite(top)
    worth = np.where(good, top - before, 0.0)
    least = _least(top, worth, before)
    feature = np.where(good, (best >= least).argmax(0), -1)
    cell, bin_ = np.zeros(len(size), np.intp), np.zeros(len(size), np.uint8)
    for j, found in enumerate(kept):
        if found is None:
            continue
        gain, mine, who, first, n = found
        chosen = feature[who] == j
        near = np.flatnonzero(gain >= np.repeat(np.where(chosen, least[who], np.inf), n))
        node = np.searchsorted(first, near, side="right") - 1
        place = mine[near[np.flatnonzero(np.diff(node, prepend=-1))]]
        cell[who[chosen]], bin_[who[chosen]] = place, cells[j].bins[place]
    return feature, cell, bin_, worth


def _running(x: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each ``first``."""
    out = np.cumsum(x)
    out -= np.repeat(out[first] - x[first], n)
    return out


def _gains(w, s, tw, ts, first, n) -> np.ndarray:
    """What is squared on both sides of a cut after each cell; after a node's last one there is none."""
    lw, ls = _running(w, first, n), _running(s, first, n)
    rw, rs = np.repeat(tw, n), np.repeat(ts, n)
    rw -= lw
    rs -= ls
    with np.errstate(divide="ignore", invalid="ignore"):
        ls *= ls
        ls /= lw
        rs *= rs
        rs /= rw
    ls += rs
    ls[first + n - 1] = -np.inf
    return ls


# ---- the table ---------------------------------------------------------------------------


def fit_edges(df: DataFrame, features: str, size: int, bins: int = BINS) -> list[list[float]]:
    """Per feature the upper ends of its bins but the last: midpoints of its values if they are few, else values at even ranks."""
    if not size:
        return []
    x = vector_to_array(features)
    rough = df.agg(*[F.approx_count_distinct(x[i], 0.02) for i in range(size)]).first()
    few = [i for i in range(size) if rough[i] <= bins * 0.9]
    ranks = [(j + 1) / bins for j in range(bins - 1)]
    row = df.agg(*[F.collect_set(x[i]) if i in few else F.percentile_approx(x[i], ranks, 20 * bins) for i in range(size)]).first()
    out = []
    for i, values in enumerate(row):
        v = np.unique(np.array(values or [], float))
        out.append((((v[1:] + v[:-1]) / 2) if i in few and len(v) <= bins else v[: bins - 1]).tolist())
    return out


def _binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(np.asarray(e), x[:, i], side="left") for i, e in enumerate(edges)], 1).astype(np.uint8)


_BLOCK = "part int, number int, row binary, bins binary, y binary, w binary, fold binary"


def _blocks(edges: Sequence[Sequence[float]], middle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                x = np.asarray(some.column("x").flatten()).reshape(some.num_rows, -1)
                columns = [np.asarray(some.column("row")), _binned(x, edges), np.asarray(some.column("y")) - middle, np.asarray(some.column("w")), np.asarray(some.column("fold")).astype(np.int16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([number], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                    names=["part", "number", "row", "bins", "y", "w", "fold"],
                )
                number += 1

    return run


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of Python values to record batches of a bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= most or len(held) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


def _opened(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part, number, row, bins, y, w, fold in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield part, number, np.frombuffer(row, np.int64), np.frombuffer(bins, np.uint8).reshape(-1, p), np.frombuffer(y), np.frombuffer(w), np.frombuffer(fold, np.int16)


@dataclass
class Top:
    """The part of a tree that was split on the cluster; the nodes without a feature continue as subtrees."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    parent: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [0])

    def reach(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends at."""
        at = np.zeros(len(bins), np.int64)
        feature, bin_, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        while True:
            f = feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = left[node] + (bins[inner, f[inner]] > bin_[node])


@dataclass(frozen=True)
class Binned:
    """A table ready for growing or scoring: blocks of binned rows, and the rows they came from by their number (and how many, if fitted)."""

    blocks: DataFrame
    rows: DataFrame
    edges: list[list[float]]
    middle: float
    n: int | None

    @property
    def size(self) -> int:
        return len(self.edges)


def bin_table(df: DataFrame, features: str = "features", label: str | None = "label", weight: str | None = None, fold: str | None = None, edges: list[list[float]] | None = None, middle: float = 0.0, bins: int = BINS) -> Binned:
    """Number the rows, bin them and write both; rows with a null label or a weight that isn't positive are left out."""
    asked = {"__row": F.monotonically_increasing_id(), "__y": F.col(label).cast("double") if label else F.lit(0.0)}
    asked["__w"] = F.col(weight).cast("double") if weight else F.lit(1.0)
    asked["__fold"] = F.col(fold).cast("int") if fold else F.lit(-2)
    rows = staged(df.withColumns(asked).filter((F.col("__w") > 0) & F.col("__y").isNotNull()), "numbered")
    n = None
    if edges is None:
        head = rows.select(features).first()
        n, total = rows.agg(F.count(F.lit(1)), F.avg("__y")).first()
        edges, middle = fit_edges(rows, features, len(head[0]) if head else 0, bins), total or 0.0
    plain = rows.select(F.col("__row").alias("row"), vector_to_array(features).alias("x"), F.col("__y").alias("y"), F.col("__w").alias("w"), F.col("__fold").alias("fold"))
    return Binned(staged(plain.mapInArrow(_blocks(edges, middle), _BLOCK), "binned"), rows, edges, middle, n)


# ---- growing -----------------------------------------------------------------------------


def _in_bag(spec: Spec, tree: int, row, fold) -> tuple[np.ndarray, np.ndarray]:
    count = drawn(row, _seed_of(spec, tree))
    if spec.without_fold >= 0:
        count = np.where(fold == spec.without_fold, 0, count)
    inside = np.flatnonzero(count)
    return inside, count[inside]


def _numbered(specs: Sequence[Spec]) -> list[tuple[int, int]]:
    """Spec and number in the forest of each tree, by its number over all forests."""
    return [(s, t) for s, spec in enumerate(specs) for t in range(spec.trees)]


def _histograms(specs, tops: dict[int, Top], wanted: dict[int, list[int]], p: int):
    """A task's sums by (tree, node): rows, weights and weighted targets by (feature, bin), least and greatest target."""
    trees = _numbered(specs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[tuple[int, int], list[np.ndarray]] = {}
        width = BINS + 1
        for _, _, row, bins, y, w, fold in _opened(batches, p):
            for t, nodes in wanted.items():
                s, i = trees[t]
                inside, count = _in_bag(specs[s], i, row, fold)
                at = tops[t].reach(bins[inside])
                for node in nodes:
                    mine = at == node
                    rows = inside[mine]
                    if not len(rows):
                        continue
                    ww = w[rows] * count[mine]
                    where = (bins[rows].astype(np.int64) + np.arange(p) * width).ravel()
                    sums = np.stack([np.bincount(where, np.repeat(x, p), p * width) for x in (np.ones(len(rows)), ww, ww * y[rows])])
                    ends = np.array([y[rows].min(), y[rows].max()])
                    if (t, node) in held:
                        old = held[t, node]
                        old[0] += sums
                        old[1][:] = min(old[1][0], ends[0]), max(old[1][1], ends[1])
                    else:
                        held[t, node] = [sums, ends]
        part = TaskContext.get().partitionId()
        for (t, node), (sums, ends) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), pa.array([node], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.tobytes() + ends.tobytes()], pa.binary())], names=["tree", "node", "part", "sums"]
            )

    return run


def _best_of_histogram(sums: np.ndarray, spec: Spec, path: np.uint64, depth: int) -> tuple | None:
    """(feature, bin, worth, rows left, rows right) or None; ``sums``: (rows, weights, targets) x features x bins."""
    c, w, s = np.cumsum(sums, 2)
    tc, tw, ts = c[:, -1:], w[:, -1:], s[:, -1:]
    if depth >= spec.depth:
        return None
    cut = (sums[0] > 0) & (c < tc)
    if spec.tried:
        cut &= _tried(np.array([path], _U), cut.any(1)[:, None], spec.tried)
    cut &= (c >= spec.min_leaf) & (tc - c >= spec.min_leaf)
    if not cut.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(cut, s * s / w + (ts - s) ** 2 / (tw - w), -np.inf)
    f, b, worth = _best(gain, float(ts[0, 0] ** 2 / tw[0, 0]))
    return f, b, worth, int(c[f, b]), int(tc[0, 0] - c[f, b]), float(s[f, b] / w[f, b]), float((ts[f, 0] - s[f, b]) / (tw[f, 0] - w[f, b]))


def _added(specs, paths: dict[tuple[int, int], tuple[int, int]], p: int):
    """The parts of a node's histogram, in the order of tasks, to its split."""
    trees = _numbered(specs)

    def finished(key, sums, ends) -> pa.RecordBatch:
        path, depth = paths[key]
        found = _best_of_histogram(sums, specs[trees[key[0]][0]], _U(path), depth) if ends[0] < ends[1] else None
        rows = float(sums[0, 0].sum())
        values = [*key, rows, float(sums[2, 0].sum() / sums[1, 0].sum()), *(found or (-1, 0, 0.0, 0, 0, 0.0, 0.0))]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=_SPLIT.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, ends = None, None, None
        for batch in batches:
            for t, node, _, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                figures = np.frombuffer(data)
                if (t, node) != now:
                    if now is not None:
                        yield finished(now, sums, ends)
                    now, sums, ends = (t, node), np.zeros((3, p, BINS + 1)), [math.inf, -math.inf]
                sums += figures[:-2].reshape(sums.shape)
                ends = [min(ends[0], figures[-2]), max(ends[1], figures[-1])]
        if now is not None:
            yield finished(now, sums, ends)

    return run


_SPLIT = T.StructType()
for _name in ("tree", "node", "rows", "value", "feature", "bin", "worth", "left_rows", "right_rows", "left_value", "right_value"):
    _SPLIT.add(_name, "double" if _name in ("rows", "value", "worth", "left_value", "right_value") else "long")


def _grow_tops(table: Binned, specs: Sequence[Spec]) -> dict[int, Top]:
    """Level by level the nodes that hold more rows than a task grows."""
    trees = _numbered(specs)
    tops = {t: Top(path=[int(_seed_of(specs[s], i))]) for t, (s, i) in enumerate(trees)}
    room = max(2, TASK_CELLS // max(1, table.size))
    # a tree draws about 0.63 of the rows; which of a table near the limit do is seen from the histograms
    open_ = [(t, 0) for t in tops] if table.n * 0.64 + 4 * math.sqrt(table.n) > room else []
    while open_:
        some, open_ = open_[:NODES_AT_ONCE], open_[NODES_AT_ONCE:]
        wanted: dict[int, list[int]] = {}
        for t, node in some:
            wanted.setdefault(t, []).append(node)
        paths = {(t, node): (tops[t].path[node], tops[t].depth[node]) for t, node in some}
        now = {t: tops[t] for t in wanted}
        parts = table.blocks.mapInArrow(_histograms(specs, now, wanted, table.size), "tree int, node int, part int, sums binary")
        found = parts.repartition("tree", "node").sortWithinPartitions("tree", "node", "part").mapInArrow(_added(specs, paths, table.size), _SPLIT)
        for r in found.collect():
            top, node = tops[r["tree"]], r["node"]
            top.value[node] = r["value"]
            if r["rows"] <= room or r["feature"] < 0:
                continue
            top.feature[node], top.bin[node], top.gain[node], top.left[node] = r["feature"], r["bin"], r["worth"], len(top.feature)
            path = np.array([top.path[node]], _U)
            for side, (rows, value) in enumerate([(r["left_rows"], r["left_value"]), (r["right_rows"], r["right_value"])]):
                if rows > room:
                    open_.append((r["tree"], len(top.feature)))
                top.feature.append(-1), top.bin.append(0), top.left.append(0), top.gain.append(0.0)
                top.value.append(value), top.depth.append(top.depth[node] + 1), top.parent.append(node), top.path.append(int(_child(path, side)[0]))
    return tops


_ROWS = "tree int, node int, part int, number int, bins binary, y binary, w binary"


def _dealt(specs, tops: dict[int, Top], p: int):
    """The drawn rows of each block by (tree, node)."""
    trees = _numbered(specs)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, number, row, bins, y, w, fold in _opened(batches, p):
            for t, (s, i) in enumerate(trees):
                inside, count = _in_bag(specs[s], i, row, fold)
                at = tops[t].reach(bins[inside])
                for node in np.unique(at):
                    mine = at == node
                    rows = inside[mine]
                    yield t, int(node), part, number, bins[rows].tobytes(), y[rows].tobytes(), (w[rows] * count[mine]).tobytes()

    i, b = pa.int32(), pa.binary()
    return lambda batches: _batched(rows_of(batches), _schema(tree=i, node=i, part=i, number=i, bins=b, y=b, w=b))


_TREE = "tree int, node int, feature binary, bin binary, left binary, value binary, gain binary, weight double"
_KINDS = {"feature": np.int16, "bin": np.uint8, "left": np.int32, "value": np.float64, "gain": np.float64}


def _grown(specs, tops: dict[int, Top], p: int):
    """The rows of each (tree, node), in the order of blocks, to its subtree."""
    trees = _numbered(specs)
    room = max(2, TASK_CELLS // p)

    def finished(t: int, node: int, parts: list[tuple[bytes, bytes, bytes]]) -> tuple:
        bins, y, w = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*parts), (np.uint8, np.float64, np.float64)))
        spec, top = specs[trees[t][0]], tops[t]
        # a node that is still large has nothing left to split
        depth = 0 if len(y) > room and len(top.feature) > 1 else spec.depth - top.depth[node]
        tree = grow(bins.reshape(-1, p), y, w, spec.min_leaf, depth, spec.tried, _U(top.path[node]))
        return t, node, *[tree[k].astype(kind).tobytes() for k, kind in _KINDS.items()], float(w.sum())

    def trees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, parts = None, []
        for batch in batches:
            for t, node, _, _, *data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (t, node) != now:
                    if now is not None:
                        yield finished(*now, parts)
                    now, parts = (t, node), []
                parts.append(tuple(data))
        if now is not None:
            yield finished(*now, parts)

    kinds = _schema(tree=pa.int32(), node=pa.int32(), **dict.fromkeys(_KINDS, pa.binary()), weight=pa.float64())
    return lambda batches: _batched(trees_of(batches), kinds)


@dataclass(frozen=True)
class Held:
    """The blocks of a table, in their order, that every task can read."""

    parts: list[tuple[bytes, ...]]

    def columns(self, p: int) -> tuple[np.ndarray, ...]:
        """``row``, ``bins``, ``y``, ``w``, ``fold`` of all rows."""
        row, bins, y, w, fold = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*self.parts), (np.int64, np.uint8, np.float64, np.float64, np.int16)))
        return row, bins.reshape(-1, p), y, w, fold

    def blocks(self) -> Iterator[tuple[int, slice, bytes]]:
        """Number, place and row numbers of each block."""
        at = 0
        for i, (row, *_) in enumerate(self.parts):
            yield i, slice(at, at := at + len(row) // 8), row


def _held(table: Binned, sums: int = 0):
    """A broadcast of the table's blocks, or None if they, or ``sums`` figures for each row, are more than a task holds."""
    columns = [n.split()[0] for n in _BLOCK.split(", ")]
    size, rows = table.blocks.agg(F.sum(sum(F.octet_length(c) for c in columns[2:])), F.sum(F.octet_length("row") / 8)).first()
    if not size or size > HELD_BYTES or rows * 8 * sums > HELD_BYTES:
        return None
    parts = [tuple(map(bytes, r)) for r in table.blocks.orderBy("part", "number").select(*columns[2:]).collect()]
    return table.blocks.sparkSession.sparkContext.broadcast(Held(parts))


def _trees_dealt(spark: SparkSession, trees: int) -> tuple[DataFrame, int]:
    """A row, ``id``, for each task that is to grow every so-many-th tree."""
    tasks = max(1, min(trees, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, tasks, 1, tasks), tasks


def _grown_of(held, specs: Sequence[Spec], p: int, numbers: Sequence[int]) -> Iterator[tuple[int, dict[str, np.ndarray] | None, float]]:
    """Some trees over the whole table, and the weight of their rows; None for a tree that drew no row."""
    row, bins, y, w, fold = held.value.columns(p)
    trees = _numbered(specs)
    for t in numbers:
        s, i = trees[t]
        spec, (inside, count) = specs[s], _in_bag(specs[s], i, row, fold)
        weight = w[inside] * count
        tree = grow(bins[inside], y[inside], weight, spec.min_leaf, spec.depth, spec.tried, _seed_of(spec, i)) if len(inside) else None
        yield t, tree, float(weight.sum())


def grow_forests(table: Binned, specs: Sequence[Spec]) -> Grown:
    """All trees of all ``specs`` over one binned table."""
    tops = _grow_tops(table, specs)
    if all(len(top.feature) == 1 for top in tops.values()) and (held := _held(table)):
        p, kinds = table.size, _schema(tree=pa.int32(), node=pa.int32(), **dict.fromkeys(_KINDS, pa.binary()), weight=pa.float64())
        dealt, tasks = _trees_dealt(table.blocks.sparkSession, len(tops))

        def trees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in batch.column("id").to_pylist():
                    made = _grown_of(held, specs, p, range(first, len(_numbered(specs)), tasks))
                    yield from _batched(((t, 0, *[tree[k].astype(kind).tobytes() for k, kind in _KINDS.items()], weight) for t, tree, weight in made if tree), kinds)

        out = Grown(list(specs), table.edges, table.middle, tops, staged(dealt.mapInArrow(trees_of, _TREE), "trees"))
        held.destroy()
        return out
    rows = table.blocks.mapInArrow(_dealt(specs, tops, table.size), _ROWS)
    many = max(1, int(table.blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = rows.repartition(many, "tree", "node").sortWithinPartitions("tree", "node", "part", "number")
    return Grown(list(specs), table.edges, table.middle, tops, staged(sorted_.mapInArrow(_grown(specs, tops, table.size), _TREE), "trees"))


# ---- reading -----------------------------------------------------------------------------


def _read(tree: dict[str, np.ndarray], bins: np.ndarray, levels: Sequence[int]) -> np.ndarray:
    """Rows by levels: the value at the node a row has reached there."""
    at = np.zeros(len(bins), np.int64)
    out = np.empty((len(bins), len(levels)))
    level, i = 0, 0
    while i < len(levels):
        inner = np.flatnonzero(tree["feature"][at] >= 0)
        while i < len(levels) and (levels[i] <= level or not len(inner)):
            out[:, i] = tree["value"][at]
            i += 1
        node = at[inner]
        at[inner] = tree["left"][node] + (bins[inner, tree["feature"][node]] > tree["bin"][node])
        level += 1
    return out


def _said(tree: dict[str, np.ndarray], top: Top, node: int, bins: np.ndarray, asked: Sequence[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """For each asked (number, depth) the number and what the tree says of rows that reach ``node``."""
    levels = sorted({d - top.depth[node] for _, d in asked})
    values = _read(tree, bins, levels)
    for k, depth in asked:
        up, v = node, values[:, levels.index(depth - top.depth[node])]
        while top.depth[up] > depth:
            up = top.parent[up]
        yield k, v if up == node else np.full(len(bins), top.value[up])


_PART_SUMS = "block int, part int, row binary, total binary, squares binary"


def _sums_by_block(held, sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sums for all rows, a record batch for each block."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    i, b = pa.int32(), pa.binary()
    for block, rows, row in held.value.blocks():
        figures = [x[rows].tobytes() for x in sums] + [b""] * (2 - len(sums))
        yield pa.RecordBatch.from_arrays([pa.array([block], i), pa.array([part], i), pa.array([row], b), *[pa.array([x], b) for x in figures]], names=["block", "part", "row", "total", "squares"])


def _added_by_block(parts: DataFrame, cells: int, squares: bool) -> DataFrame:
    """The tasks' sums, added in the order of tasks, by row."""
    names = ["total", "squares"][: 1 + squares]

    def finished(row: bytes, sums: list[np.ndarray]) -> pa.RecordBatch:
        numbers = np.frombuffer(row, np.int64)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * cells), pa.array(x)) for x in sums]
        return pa.RecordBatch.from_arrays([pa.array(numbers), *lists], names=["row", *names])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, sums = None, None, None
        for batch in batches:
            for block, _, row, *figures in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                figures = [np.frombuffer(x) for x in figures[: len(names)]]
                if block == now:
                    sums = [a + b for a, b in zip(sums, figures)]
                    continue
                if now is not None:
                    yield finished(at, sums)
                now, at, sums = block, row, figures
        if now is not None:
            yield finished(at, sums)

    dealt = parts.repartition("block").sortWithinPartitions("block", "part")
    return dealt.mapInArrow(add, f"row long, {', '.join(f'{x} array<double>' for x in names)}")


@dataclass(frozen=True)
class Grown:
    """Grown forests: the tops of their trees, and a table with one row for each subtree."""

    specs: list[Spec]
    edges: list[list[float]]
    middle: float
    tops: dict[int, Top]
    subtrees: DataFrame

    def sums(self, table: Binned, cells: Sequence[Cell], squares: bool = False) -> DataFrame:
        """``row``, ``total`` (one sum over the trees for each cell), ``squares`` likewise; rows of a fold meet only forests that did not see it.

        A forest that saw all folds meets all rows.
        """
        held = _held(table, len(cells) * (1 + squares))
        return self._sums_of_held(held, cells, squares) if held else self._sums_of_dealt(table, cells, squares)

    def _sums_of_held(self, held, cells: Sequence[Cell], squares: bool) -> DataFrame:
        """The trees stay where they are, and each task adds up what its trees say of the whole table."""
        specs, tops, p, middle = self.specs, self.tops, len(self.edges), self.middle
        trees, first = _numbered(specs), np.cumsum([0, *[s.trees for s in specs]]).tolist()
        asked = sorted({first[c.spec] + i for c in cells for i in range(c.trees)})
        subtrees = self.subtrees.select("tree", "node", *[k for k in _KINDS if k != "gain"])
        there = {r["tree"] for r in subtrees.select("tree").distinct().collect()}
        without = [t for t in asked if t not in there]  # they drew no row

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            row, bins, _, _, fold = held.value.columns(p)
            sums = [np.zeros((len(row), len(cells))) for _ in range(1 + squares)]
            now, mine, reached = None, None, None

            def met(t: int) -> np.ndarray:
                out = specs[trees[t][0]].without_fold
                return np.arange(len(row)) if out < 0 else np.flatnonzero(fold == out)

            def add(t: int, node: int, rows: np.ndarray, tree: dict[str, np.ndarray]) -> None:
                s, number = trees[t]
                for k, v in _said(tree, tops[t], node, bins[rows], [(k, c.depth) for k, c in enumerate(cells) if c.spec == s and number < c.trees]):
                    v = v + middle
                    sums[0][rows, k] += v
                    if squares:
                        sums[1][rows, k] += v * v

            if TaskContext.get().partitionId() == 0:
                for t in without:
                    add(t, 0, met(t), {k: np.array([-1 if k == "feature" else 0], kind) for k, kind in _KINDS.items()})
            wanted = set(asked)
            for batch in batches:
                for t, node, *data in zip(*[batch.column(n).to_pylist() for n in batch.schema.names], strict=True):
                    if t not in wanted:
                        continue
                    if t != now:
                        now, mine = t, met(t)
                        reached = tops[t].reach(bins[mine])
                    names = batch.schema.names[2:]
                    add(t, node, mine[reached == node], {k: np.frombuffer(x, _KINDS[k]) for k, x in zip(names, data)})
            yield from _sums_by_block(held, sums)

        return _added_by_block(subtrees.mapInArrow(read, _PART_SUMS), len(cells), squares)

    def _sums_of_dealt(self, table: Binned, cells: Sequence[Cell], squares: bool) -> DataFrame:
        specs, tops, p, middle = self.specs, self.tops, len(self.edges), self.middle
        trees = _numbered(specs)
        by_spec: dict[int, list[tuple[int, Cell]]] = {}
        for k, cell in enumerate(cells):
            by_spec.setdefault(cell.spec, []).append((k, cell))
        most = {s: max(c.trees for _, c in asked) for s, asked in by_spec.items()}

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for part, number, row, bins, _, _, fold in _opened(batches, p):
                for t, (s, i) in enumerate(trees):
                    if i >= most.get(s, 0):
                        continue
                    mine = np.arange(len(row)) if specs[s].without_fold < 0 else np.flatnonzero(fold == specs[s].without_fold)
                    at = tops[t].reach(bins[mine])
                    for node in np.unique(at):
                        rows = mine[at == node]
                        yield t, int(node), 1, part, number, bins[rows].tobytes(), row[rows].tobytes()

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[bytes, list[np.ndarray]] = {}
            size, now, tree = 0, None, None

            def handed_on() -> Iterator[pa.RecordBatch]:
                for key, sums in held.items():
                    lists = [pa.array(list(x), pa.list_(pa.float64())) for x in sums]
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(key, np.int64)), *lists], names=["row", "total", "squares"][: 1 + len(sums)])

            for batch in batches:
                columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
                for i in range(batch.num_rows):
                    key = columns["tree"][i], columns["node"][i]
                    if columns["kind"][i] == 0:
                        now, tree = key, {k: np.frombuffer(columns[f"t_{k}"][i], kind) for k, kind in _KINDS.items()}
                        continue
                    t, node = key
                    if key != now:
                        if len(tops[t].feature) > 1:
                            raise RuntimeError(f"no subtree for {key}")
                        now, tree = key, {k: np.array([-1 if k == "feature" else 0], kind) for k, kind in _KINDS.items()}  # the tree drew no row
                    s, number = trees[t]
                    bins = np.frombuffer(columns["bins"][i], np.uint8).reshape(-1, p)
                    rows = columns["row"][i]
                    if rows not in held:
                        held[rows] = [np.zeros((len(bins), len(cells))) for _ in range(1 + squares)]
                        size += len(bins)
                    for k, v in _said(tree, tops[t], node, bins, [(k, c.depth) for k, c in by_spec[s] if number < c.trees]):
                        v = v + middle
                        held[rows][0][:, k] += v
                        if squares:
                            held[rows][1][:, k] += v * v
                    if size >= HELD_SUMS:
                        yield from handed_on()
                        held, size = {}, 0
            yield from handed_on()

        names = ["tree", "node", "kind", "part", "number", "bins", "row"]
        i, b = pa.int32(), pa.binary()
        kinds = _schema(tree=i, node=i, kind=i, part=i, number=i, bins=b, row=b)
        rows = table.blocks.mapInArrow(lambda batches: _batched(dealt(batches), kinds), "tree int, node int, kind int, part int, number int, bins binary, row binary")
        some = self.subtrees.withColumns({"kind": F.lit(0), "part": F.lit(0), "number": F.lit(0), "bins": F.lit(None).cast("binary"), "row": F.lit(None).cast("binary")})
        some = some.select(*names, *[F.col(k).alias(f"t_{k}") for k in _KINDS])
        both = some.unionByName(rows, allowMissingColumns=True)
        many = max(1, int(table.blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        both = both.repartition(many, "tree", "node").sortWithinPartitions("tree", "node", "kind", "part", "number")
        out = ["total", "squares"][: 1 + squares]
        parts = both.mapInArrow(read, f"row long, {', '.join(f'{x} array<double>' for x in out)}")
        added = [F.array(*[F.sum(F.col(x)[k]) for k in range(len(cells))]).alias(x) for x in out]
        return parts.groupBy("row").agg(*added)

    def importance(self, cell: Cell) -> np.ndarray:
        """Mean over the trees of each feature's share of the decrease of the squared error; the shares of a tree sum to 1."""
        p = len(self.edges)
        first = sum(s.trees for s in self.specs[: cell.spec])
        wanted = range(first, first + cell.trees)
        tops = self.tops

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t, node, feature, gain, left in zip(*[batch.column(n).to_pylist() for n in ("tree", "node", "feature", "gain", "left")], strict=True):
                    f, g, child = np.frombuffer(feature, np.int16), np.frombuffer(gain), np.frombuffer(left, np.int32)
                    inner = np.flatnonzero(f >= 0)
                    depth = np.zeros(len(f), np.int64)
                    for i in inner:  # a parent stands before its children
                        depth[child[i]] = depth[child[i] + 1] = depth[i] + 1
                    inner = inner[depth[inner] + tops[t].depth[node] < cell.depth]
                    total = np.bincount(f[inner], g[inner], p).astype(np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array([t] * p, pa.int32()), pa.array(range(p), pa.int32()), pa.array(total)], names=["tree", "feature", "gain"])

        below = self.subtrees.filter(F.col("tree").between(wanted.start, wanted.stop - 1)).select("tree", "node", "feature", "gain", "left")
        rows = below.mapInArrow(shares, "tree int, feature int, gain double").groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect()
        gains = np.zeros((cell.trees, p))
        for r in rows:
            gains[r["tree"] - first, r["feature"]] += r["gain"]
        for t in wanted:
            for f, g, d in zip(tops[t].feature, tops[t].gain, tops[t].depth):
                if f >= 0 and d < cell.depth:
                    gains[t - first, f] += g
        whole = gains.sum(1, keepdims=True)
        shares_of = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).mean(0)
        return shares_of / shares_of.sum() if shares_of.sum() > 0 else shares_of


class DeepForest:
    """A forest as a model: ``transform`` adds the mean of its trees, or for a classifier of 0 and 1 whether that is over a half."""

    def __init__(self, grown: Grown, cell: Cell, classifier: bool = False) -> None:
        self.grown, self.cell, self.classifier = grown, cell, classifier
        self.features_column, self.prediction_column = "features", "prediction"

    def copy(self, extra=None) -> DeepForest:
        return copy.copy(self)

    def setPredictionCol(self, name: str) -> DeepForest:
        self.prediction_column = name
        return self

    def setProbabilityCol(self, name: str) -> DeepForest:
        return self

    setRawPredictionCol = setProbabilityCol

    def _table(self, df: DataFrame) -> Binned:
        return bin_table(df, self.features_column, None, edges=self.grown.edges)

    def transform(self, df: DataFrame) -> DataFrame:
        table = self._table(df)
        mean = F.col("total")[0] / F.lit(float(self.cell.trees))
        said = self.grown.sums(table, [self.cell]).select(F.col("row").alias("__row"), (mean > 0.5).cast("double").alias("__said") if self.classifier else mean.alias("__said"))
        said = staged(said, "scored")  # the trees are read once, whatever is made of it
        joined = table.rows.join(said, "__row")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != self.prediction_column], F.col("__said").alias(self.prediction_column))

    def spread(self, df: DataFrame, trees: int) -> DataFrame:
        """``df`` with the population deviation of the first trees' predictions."""
        table = self._table(df)
        n = min(trees, self.cell.trees)
        mean = F.col("total")[0] / n
        deviation = F.sqrt(F.greatest(F.col("squares")[0] / n - mean * mean, F.lit(0.0)))
        said = self.grown.sums(table, [Cell(self.cell.spec, n, self.cell.depth)], squares=True).select(F.col("row").alias("__row"), deviation.alias("tree_std"))
        return table.rows.join(said, "__row").select(*[F.col(f"`{c}`") for c in df.columns], "tree_std")

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.grown.importance(self.cell))

    def save(self, path: str) -> None:
        """The subtrees as Parquet, everything else as one row of JSON; an existing folder is overwritten."""
        g = self.grown
        first = sum(s.trees for s in g.specs[: self.cell.spec])
        keep = range(first, first + self.cell.trees)
        g.subtrees.filter(F.col("tree").between(keep.start, keep.stop - 1)).withColumn("tree", F.col("tree") - first).write.mode("overwrite").parquet(f"{path}/subtrees")
        spec = asdict(g.specs[self.cell.spec]) | {"trees": self.cell.trees}
        about = {"spec": spec, "edges": g.edges, "middle": g.middle, "depth": self.cell.depth, "classifier": self.classifier, "tops": [asdict(g.tops[t]) for t in keep]}
        g.subtrees.sparkSession.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").json(f"{path}/about")

    def write(self) -> DeepForest:
        return self

    def overwrite(self) -> DeepForest:
        return self

    @staticmethod
    def load(spark: SparkSession, path: str) -> DeepForest:
        about = json.loads(spark.read.schema("about string").json(f"{path}/about").first()[0])
        tops = {t: Top(**x) for t, x in enumerate(about["tops"])}
        subtrees = spark.read.parquet(f"{path}/subtrees").select(*[n.split()[0] for n in _TREE.split(", ")])
        return DeepForest(Grown([Spec(**about["spec"])], about["edges"], about["middle"], tops, subtrees), Cell(0, about["spec"]["trees"], about["depth"]), about["classifier"])


def fit_deep_forest(df: DataFrame, spec: Spec, weight: str | None = None, classifier: bool = False, bins: int = BINS) -> DeepForest:
    """A forest on ``features`` and ``label``; labels of a classifier are 0 and 1, whose squared error is half their Gini impurity."""
    if classifier and df.filter(~F.col("label").isin(0.0, 1.0)).limit(1).count():
        raise ValueError("a classifier's labels are 0 and 1")
    table = bin_table(df, weight=weight, bins=bins)
    if not table.n:
        raise ValueError("no training rows")
    return DeepForest(grow_forests(table, [spec]), Cell(0, spec.trees, spec.depth), classifier)


def cross_predictions(table: Binned, specs: Sequence[Spec], cells: Sequence[tuple[int, int, int]], folds: int) -> DataFrame:
    """Out-of-fold predictions: ``fold``, ``label`` and ``predictions`` (one for each cell) of every row.

    ``specs``: the forests without a fold; each is grown once for every fold, without its rows. ``cells``: (number of the
    spec, trees, depth).
    """
    forests = [Spec(**(asdict(s) | {"without_fold": f})) for s in specs for f in range(folds)]
    if table.n * 0.64 * table.size <= TASK_CELLS and (held := _held(table, len(cells))):
        mine, sums = F.col("total"), _cross_sums(table, held, forests, cells, folds)
    else:
        asked = [Cell(s * folds + f, trees, depth) for f in range(folds) for s, trees, depth in cells]
        mine, sums = F.slice("total", F.col("__fold") * len(cells) + 1, F.lit(len(cells))), grow_forests(table, forests).sums(table, asked)
    sums = staged(sums, "scored").withColumnRenamed("row", "__row")
    said = F.transform(mine, lambda x, i: x / F.element_at(F.array(*[F.lit(float(t)) for _, t, _ in cells]), (i + 1).cast("int")))
    return table.rows.join(sums, "__row").select(F.col("__fold").alias("fold"), F.col("__y").alias("label"), said.alias("predictions"))


def _cross_sums(table: Binned, held, forests: Sequence[Spec], cells: Sequence[tuple[int, int, int]], folds: int) -> DataFrame:
    """For each row the sums over the trees that did not see its fold; each tree is read by the task that grew it and is not kept."""
    p, middle, top = table.size, table.middle, Top()
    dealt, tasks = _trees_dealt(table.blocks.sparkSession, sum(s.trees for s in forests))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, bins, _, _, fold = held.value.columns(p)
        trees, total = _numbered(forests), np.zeros((len(row), len(cells)))
        for batch in batches:
            for first in batch.column("id").to_pylist():
                for t, tree, _ in _grown_of(held, forests, p, range(first, len(trees), tasks)):
                    s, number = trees[t]
                    rows = np.flatnonzero(fold == forests[s].without_fold)
                    tree = tree or {k: np.array([-1 if k == "feature" else 0], kind) for k, kind in _KINDS.items()}
                    for k, v in _said(tree, top, 0, bins[rows], [(k, depth) for k, (of, most, depth) in enumerate(cells) if of == s // folds and number < most]):
                        total[rows, k] += v + middle
        yield from _sums_by_block(held, [total])

    return _added_by_block(dealt.mapInArrow(read, _PART_SUMS), len(cells), False)
