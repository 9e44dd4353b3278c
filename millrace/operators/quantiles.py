"""Exact quantiles by distributed selection.

Spark's exact ``percentile`` gathers every distinct value in one reducer, which
does not survive a continuous column of a very large table. Here the wanted
ranks are bracketed by a small mergeable sketch (built per task, merged in two
levels so that no single reducer reads the sketches of all tasks), the brackets
are narrowed by counting passes, and only the values inside a bracket small
enough for one task are sorted. The sketch decides where to look, never what
the result is: a bracket is used only after counting shows that it holds the
rank. What reaches the driver is a few numbers per (group, column, rank).

Passes over the data: 2 for small tables, 3 up to about a hundred million rows,
one more for each further factor of some hundred.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions.columns import col
from millrace.session import staged

GRID = 1000
SKETCH = 4000
SORTABLE = 250_000
SALTS = 256
MAX_GROUPS = 10_000


@dataclass(frozen=True)
class Rank:
    """A wanted position: interpolated at ``p * (n - 1)``, the ``ceil(p * n)``-th or the ``smallest``-th value."""

    p: float
    interpolated: bool = True
    smallest: int | None = None

    def position(self, n: int) -> tuple[int, int, float]:
        if self.smallest is not None:
            k = min(n, self.smallest) - 1
            return k, k, 0.0
        if self.interpolated:
            at = self.p * (n - 1)
            low = min(n - 1, math.floor(at))
            part = at - low
            return low, (low + 1 if part > 0 else low), part
        k = min(n, max(1, math.ceil(round(self.p * n, 9)))) - 1
        return k, k, 0.0


@dataclass(frozen=True)
class OrderStat:
    """The two neighbouring order statistics of a rank and the place between them."""

    n: int
    low: float | None
    high: float | None
    part: float

    @property
    def value(self) -> float | None:
        return self._between(self.low, self.high)

    def clipped(self, lower: float, upper: float) -> float | None:
        """The same quantile after clipping the column.

        Clipping is monotone, so it commutes with order statistics: no second
        pass over the clipped column is needed.
        """
        if self.low is None:
            return None
        return self._between(min(max(self.low, lower), upper), min(max(self.high, lower), upper))

    def _between(self, low, high):
        if low is None:
            return None
        return low if low == high else low + (high - low) * self.part


@dataclass
class _Bracket:
    """Closed range of values; ``between`` counts the rows strictly inside its ends."""

    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    between: int = 0
    grid: list[float] | None = None

    @property
    def whole(self) -> bool:
        return self.low == -math.inf and self.high == math.inf


def _even_grid(cells: int) -> Column:
    """Array ``0, 1/cells .. 1`` as one foldable literal; thousands of literal nodes would slow the planner down."""
    return F.split(F.lit(",".join(repr(i / cells) for i in range(cells + 1))), ",").cast("array<double>")


def _narrow(outer: _Bracket, first: int, last: int, margin: int) -> _Bracket:
    """Sub-range of ``outer`` around local ranks, from its sketch; ``inside`` is what the sketch expects there."""
    grid = outer.grid
    if not grid:
        return outer
    cells = len(grid) - 1
    a = math.floor((first - outer.below) / outer.inside * cells) - margin
    b = math.ceil((last - outer.below + 1) / outer.inside * cells) + margin
    low = outer.low if a <= 0 else max(outer.low, grid[a])
    high = outer.high if b >= cells else min(outer.high, grid[b])
    share = (min(b, cells) - max(a, 0)) / cells
    return _Bracket(low, high, inside=math.ceil(share * outer.inside))


def order_stats(
    df: DataFrame,
    wanted: Mapping[str, Sequence[Rank | float]],
    by: Sequence[str] = (),
    sortable: int = SORTABLE,
    grid: int = GRID,
    at_most: int | None = None,
) -> dict[tuple, dict[str, dict[Rank, OrderStat]]]:
    """Exact order statistics per group: ``{group: {column: {rank: stat}}}``.

    ``by`` must have few values (flags, labels); without it the only group is ``()``. For any number of groups see `group_quantiles`.
    NULL and NaN are ignored. ``at_most`` is a known upper bound of the number
    of rows; below the sortable size the first pass then only counts.
    """
    by = list(by)
    wanted = {c: [r if isinstance(r, Rank) else Rank(float(r)) for r in rs] for c, rs in wanted.items() if len(rs)}
    if not wanted:
        return {}
    columns = list(wanted)
    number = [F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in columns]
    base = df.select(*[col(b).alias(f"g{i}") for i, b in enumerate(by)], *[x.alias(f"v{i}") for i, x in enumerate(number)])
    keys = [f"g{i}" for i in range(len(by))]
    probs = _even_grid(grid)

    rows = _two_level(base, keys, [(f"s{i}", F.lit(None), F.col(f"v{i}"), F.lit(None)) for i in range(len(columns))],
                      None if at_most is not None and at_most <= sortable else probs, limit=MAX_GROUPS + 1)
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"exact quantiles by {by}: more than {MAX_GROUPS} groups; use group_quantiles")

    groups = [tuple(r[k] for k in keys) for r in rows]
    # one bracket per (group, column, rank); they start as the whole column
    state: dict[tuple[int, int, int], _Bracket] = {}
    need: dict[tuple[int, int, int], tuple[int, int, float]] = {}
    for g, row in enumerate(rows):
        for i, c in enumerate(columns):
            s = row[f"s{i}"]
            for j, rank in enumerate(wanted[c]):
                if s["inside"]:
                    need[g, i, j] = rank.position(s["inside"])
                    state[g, i, j] = _Bracket(inside=s["inside"], between=s["inside"], grid=s["grid"])
    totals = {t: b.inside for t, b in state.items()}

    margins = dict.fromkeys(state, 2)
    outer = dict(state)
    open_ = {t for t, b in state.items() if b.between > sortable}
    again: dict[tuple[int, int, int], _Bracket] = {}
    while open_:
        trial = {t: again.get(t) or _narrow(outer[t], need[t][0], need[t][1], margins[t]) for t in open_}
        # brackets that should turn out small are only counted; a sketch is made where one more step is expected
        deep = {t: trial[t] for t in open_ if t in again or trial[t].inside > sortable // 2}
        flat = {t: trial[t] for t in open_ if t not in deep}
        found = _measure(base, keys, groups, deep, probs) | _measure(base, keys, groups, flat, None)
        again = {}
        for t in list(open_):
            inner = found[t]
            if not (inner.below <= need[t][0] and need[t][1] < inner.below + inner.inside):
                margins[t] *= 4
                if margins[t] > 4 * grid:
                    open_.discard(t)
                continue
            if inner.between > sortable and t in flat:
                again[t] = inner
                continue
            shrunk = inner.inside < outer[t].inside
            state[t] = outer[t] = inner
            margins[t] = 2
            if inner.between <= sortable or not shrunk:
                open_.discard(t)

    picked = _select(base, keys, groups, state, need, sortable)
    out: dict[tuple, dict[str, dict[Rank, OrderStat]]] = {}
    for g, group in enumerate(groups):
        per_col = out.setdefault(group, {})
        for i, c in enumerate(columns):
            per_rank = per_col.setdefault(c, {})
            for j, rank in enumerate(wanted[c]):
                t = (g, i, j)
                if t not in need:
                    per_rank[rank] = OrderStat(0, None, None, 0.0)
                else:
                    k, k2, part = need[t]
                    per_rank[rank] = OrderStat(totals[t], picked[t, k], picked[t, k2], part)
    return out


def _bounds(base: DataFrame, keys: list[str], groups: list[tuple], brackets: dict) -> tuple[DataFrame, dict]:
    """Give every row the bracket limits of its group: literals, or a tiny equi-join on the group key."""
    slots = sorted({(i, j) for _, i, j in brackets})
    if not keys:
        edges = {(i, j): (F.lit(brackets[0, i, j].low), F.lit(brackets[0, i, j].high)) for i, j in slots}
        return base, edges
    rows = []
    for g, group in enumerate(groups):
        edge_values = []
        for i, j in slots:
            b = brackets.get((g, i, j))
            # an empty range for groups that are already done
            edge_values += [b.low, b.high] if b else [math.inf, -math.inf]
        rows.append((*group, *edge_values))
    fields = [T.StructField(f"k{n}", base.schema[k].dataType) for n, k in enumerate(keys)]
    names = [f"{e}_{i}_{j}" for i, j in slots for e in ("lo", "hi")]
    schema = T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in names])
    table = base.sparkSession.createDataFrame(rows, schema)
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"k{n}"))
    # at most MAX_GROUPS rows, checked above
    joined = base.join(F.broadcast(table), same, "inner")
    return joined, {(i, j): (F.col(f"lo_{i}_{j}"), F.col(f"hi_{i}_{j}")) for i, j in slots}


def _two_level(df: DataFrame, keys: list[str], ranges, probs: Column | None, limit: int | None = None) -> list:
    """Per group and range ``(name, is_below, value_inside, is_between)``: counts and a sketch of the values inside.

    Tasks are first combined in up to ``SALTS`` reducers, those in one; a reducer
    thus merges a bounded share of the sketches. Without ``probs`` there are only counts.
    """
    if probs is None:
        counts = [F.struct(F.count_if(below).alias("below"), F.count(inside).alias("inside"), F.count_if(between).alias("between"),
                           F.lit(None).cast("array<double>").alias("grid")).alias(name) for name, below, inside, between in ranges]
        out = df.groupBy(*keys).agg(*counts)
        return (out.limit(limit) if limit else out).collect()
    salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    first, second = [], []
    for name, below, inside, between in ranges:
        first += [F.count_if(below).alias(f"{name}_b"), F.count(inside).alias(f"{name}_i"), F.count_if(between).alias(f"{name}_s"),
                  F.kll_sketch_agg_double(inside, SKETCH).alias(f"{name}_k")]
        n = F.sum(f"{name}_i")
        merged = F.kll_merge_agg_double(F.when(F.col(f"{name}_i") > 0, F.col(f"{name}_k")), SKETCH)
        second.append(F.struct(
            F.sum(f"{name}_b").alias("below"), n.alias("inside"), F.sum(f"{name}_s").alias("between"),
            F.when(n > 0, F.kll_sketch_get_quantile_double(merged, probs)).alias("grid")).alias(name))
    out = salted.groupBy(*keys, "_salt").agg(*first).groupBy(*keys).agg(*second)
    return (out.limit(limit) if limit else out).collect()


def _measure(base, keys, groups, brackets, probs) -> dict:
    if not brackets:
        return {}
    joined, edges = _bounds(base, keys, groups, brackets)
    ranges = []
    for (i, j), (low, high) in edges.items():
        v = F.col(f"v{i}")
        ranges.append((f"m_{i}_{j}", v < low, F.when(v.between(low, high), v), (v > low) & (v < high)))
    index = {group: g for g, group in enumerate(groups)}
    out = {}
    for row in _two_level(joined, keys, ranges, probs):
        g = index[tuple(row[k] for k in keys)]
        for i, j in edges:
            b = brackets.get((g, i, j))
            if b is not None:
                m = row[f"m_{i}_{j}"]
                out[g, i, j] = _Bracket(b.low, b.high, m["below"], m["inside"], m["between"], m["grid"])
    return out


def _select(base, keys, groups, state, need, sortable) -> dict:
    """Sort the brackets, by ranges if one is larger than a task sorts, and read the values at the wanted ranks."""
    if not state:
        return {}
    # ranks that share the same bracket in every group share one sorted list
    shared: dict[tuple, tuple[int, int]] = {}
    slot_of: dict[tuple[int, int], tuple[int, int]] = {}
    for i, j in sorted({(i, j) for _, i, j in state}):
        sig = (i, tuple((state[g, i, j].low, state[g, i, j].high) if (g, i, j) in state else None for g in range(len(groups))))
        slot_of[i, j] = shared.setdefault(sig, (i, j))
    brackets = {t: b for t, b in state.items() if slot_of[t[1], t[2]] == (t[1], t[2])}
    joined, edges = _bounds(base, keys, groups, brackets)

    slots = list(edges)
    entries = [
        F.when(F.col(f"v{i}").between(*edges[i, j]), F.struct(F.lit(n).alias("slot"), F.col(f"v{i}").alias("value")))
        for n, (i, j) in enumerate(slots)
    ]
    if not keys and not any(b.whole for b in brackets.values()):
        # stated on the plain column so that it reaches the scan
        near = F.lit(False)
        for (_, i, _j), b in brackets.items():
            near = near | F.col(f"v{i}").between(F.lit(b.low), F.lit(b.high))
        joined = joined.where(near)
    values = joined.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("e")).select(*keys, "e.slot", "e.value")
    counts = values.groupBy(*keys, "slot", "value").agg(F.count("*").alias("copies"))
    if all(b.between <= sortable for b in brackets.values()):
        window = Window.partitionBy(*keys, "slot").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = counts.withColumn("upto", F.sum("copies").over(window))
    else:  # a bracket between two hot ends that narrowing can't part
        ranked = running_counts(counts, [*keys, "slot"], "value")

    index = {slot: n for n, slot in enumerate(slots)}
    asked = sorted({
        (g, index[slot_of[i, j]], k - state[g, i, j].below)
        for (g, i, j), (k1, k2, _) in need.items() for k in (k1, k2)
    })
    fields = [T.StructField(f"k{n}", base.schema[k].dataType) for n, k in enumerate(keys)]
    schema = T.StructType([T.StructField("gid", T.IntegerType()), *fields,
                           T.StructField("want_slot", T.IntegerType()), T.StructField("at", T.LongType())])
    table = base.sparkSession.createDataFrame([(g, *groups[g], s, k) for g, s, k in asked], schema)
    match = (F.col("slot") == F.col("want_slot")) & (F.col("upto") > F.col("at")) & (F.col("upto") - F.col("copies") <= F.col("at"))
    for n, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"k{n}"))
    # a handful of ranks per (group, column)
    hits = ranked.join(F.broadcast(table), match, "inner").select("gid", "slot", "at", "value").collect()
    values_at = {(h["gid"], h["slot"], h["at"]): h["value"] for h in hits}
    return {
        ((g, i, j), k): values_at[g, index[slot_of[i, j]], k - state[g, i, j].below]
        for (g, i, j), (k1, k2, _) in need.items() for k in (k1, k2)
    }


def running_counts(counts: DataFrame, by: Sequence[str], value: str, copies: str = "copies", stage=staged) -> DataFrame:
    """``counts`` (one row for each group and value) with ``upto``, the copies up to and with the value in its group, and ``n``, those of the group.

    For any number of groups of any size: rows are sorted by ranges of (group, value), so a large group lies in several
    ranges; the running counts within a range are moved on by the sizes of the group's pieces in the ranges before.
    """
    by = list(by)
    ranged = counts.repartitionByRange(*by, value).sortWithinPartitions(*by, value)
    ranged = stage(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    pieces = ranged.groupBy("_range", *by).agg(F.sum(copies).alias("_piece"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a row for each range
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.select(F.col("_range").alias("_r"), *[F.col(b).alias(f"_{b}") for b in by], (F.sum("_piece").over(before) - F.col("_piece")).alias("_before"), F.sum("_piece").over(group).alias("n"))
    within = Window.partitionBy("_range", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col("_range") == F.col("_r")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    joined = ranged.withColumn("_upto", F.sum(copies).over(within)).join(pieces, same)
    return joined.select(*by, value, copies, (F.col("_before") + F.col("_upto")).alias("upto"), "n")


def group_quantiles(counts: DataFrame, by: Sequence[str], value: str, ranks: Sequence[Rank | float], copies: str = "copies", stage=staged) -> DataFrame:
    """``by``, ``n`` and ``q`` (one value for each rank) of every group, as a table: the groups may be any number.

    ``counts`` has one row for each group and value.
    """
    by, ranks = list(by), [r if isinstance(r, Rank) else Rank(float(r)) for r in ranks]
    running = running_counts(counts, by, value, copies, stage)
    n, found = F.col("n"), []
    for r in ranks:
        if r.smallest is not None:
            low = F.least(n, F.lit(r.smallest)) - 1
            high, part = low, F.lit(0.0)
        elif r.interpolated:
            at = F.lit(r.p) * (n - 1)
            low = F.least(n - 1, F.floor(at))
            part = at - low
            high = F.when(part > 0, low + 1).otherwise(low)
        else:
            low = F.least(n, F.greatest(F.lit(1), F.ceil(F.round(F.lit(r.p) * n, 9)))) - 1
            high, part = low, F.lit(0.0)
        ends = [F.max(F.when((F.col("upto") > k) & (F.col("upto") - F.col(copies) <= k), F.col(value))) for k in (low, high)]
        found.append((*ends, F.max(part)))
    names = [(f"_l{i}", f"_h{i}", f"_p{i}") for i in range(len(ranks))]
    flat = [c.alias(x) for f, x3 in zip(found, names) for c, x in zip(f, x3)]
    values = [F.when(F.col(lo) == F.col(hi), F.col(lo)).otherwise(F.col(lo) + (F.col(hi) - F.col(lo)) * F.col(p)) for lo, hi, p in names]
    return running.groupBy(*by).agg(F.max("n").alias("n"), *flat).select(*by, "n", F.array(*values).alias("q"))


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], **kw) -> dict[str, dict[float, float | None]]:
    """Interpolated exact quantiles of whole columns: ``{column: {p: value}}``."""
    found = order_stats(df, wanted, **kw).get((), {})
    return {c: {r.p: s.value for r, s in per.items()} for c, per in found.items()}


def medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float | None]:
    return {c: per[0.5] for c, per in quantiles(df, {c: [0.5] for c in columns}, **kw).items()}
