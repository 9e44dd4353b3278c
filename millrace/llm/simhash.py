"""SimHash near-duplicates by a self-join of a binary trie.

A fingerprint has 64 bits. The trie's levels are its bits, the most balanced
first. A pair of nodes is traversed together; bits in which the paths differ add
up, and a pair is dropped once they exceed the budget. The top levels are dealt
out: cells are the nodes of a certain depth (cut further into chunks of bounded
size), and each task traverses below one pair of cells whose prefixes are within
the budget. A task returns links that span what it found to be connected, never
all pairs of a group of near copies; components follow from the links of all tasks.

Sixty-four bits tell similarities apart only roughly: texts with 0.8 of their
shingles in common differ in about ten bits, and a budget of ten prunes nothing.
``one_of_each`` therefore takes several words of 64 bits. Each word has a trie
of its own with a small budget, which counts only down to where few values are
left below a pair of nodes; those are compared in the bits of all words.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import add_columns
from millrace.llm.components import connected
from millrace.session import staged

SHINGLE, BUDGET, SEED = 3, 3, 42
#: Fingerprints of a cell's chunk: bounds the memory of a task. Least and most depth of cells.
CELL, LEAST_DEPTH, MOST_DEPTH = 32_768, 4, 18
#: Node pairs expanded at once.
_FRONT = 1 << 17
#: A node pair with so many pairs of values or fewer is compared value by value.
_COMPARED = 16
_PIECE = 1 << 15
#: Near copies by similarity: words in a shingle, fingerprint words of 64 bits, budget of each word's trie, and bits that may differ in all.
#: Sets of shingles of similarity s differ in acos(2s / (1 + s)) / pi of the bits: 0.152 at 0.8, with a spread of 6 of 256 bits,
#: so 45 of 256 take in six of seven pairs at exactly 0.8, nearly all above 0.85, and one in fifty at 0.6.
WIDE_SHINGLE, WIDE_WORDS, WIDE_BUDGET, WIDE_MOST = 5, 4, 2, 45


def _hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, in order; none for a text without a word."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (ends - sizes)[:n], ends[-n:]
    digest, out = xxhash.xxh64_intdigest, np.empty(n, np.uint64)
    for at in range(0, n, _PIECE):
        s = slice(at, at + _PIECE)
        out[s] = [digest(joined[a:b], SEED) for a, b in zip(first[s].tolist(), last[s].tolist(), strict=True)]
    return out


def _majority(values: np.ndarray) -> int:
    """Bits set in more than half of the values."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), _PIECE):
        bits = np.unpackbits(values[at : at + _PIECE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        even = len(bits) // 255 * 255  # sums of 255 bits fit in a byte
        ones += bits[even:].sum(axis=0, dtype=np.int64) + np.add.reduce(bits[:even].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values)).tobytes(), "big")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in more than half of the shingles' XXH64 values; 0 without a word.

    Words are the runs between ASCII white space after lower-casing A-Z;
    shingles count as often as they occur; fewer words make one shingle.
    """
    return _majority(_hashes(text, shingle))


def wide_fingerprint(text: str, shingle: int = WIDE_SHINGLE, words: int = WIDE_WORDS) -> tuple[int, ...]:
    """``words`` fingerprints of the set of shingles, each by another hash (splitmix64 of the XXH64); zeros without a word."""
    base, out = np.unique(_hashes(text, shingle)), []
    for t in range(words):
        z = base + np.uint64((t + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(_majority(z ^ (z >> np.uint64(31))))
    return tuple(out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``fp``, the fingerprint as a signed long; no exchange."""
    return add_columns(df, text, T.StructType([T.StructField("fp", T.LongType())]), lambda: lambda texts: [(_signed(fingerprint(t, shingle)),) for t in texts])


# Trie -------------------------------------------------------------------------------------------------------------


def permuted(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Unsigned values with their bits in another order; ``order[0]`` (counted from the lowest bit) becomes the highest."""
    out = np.zeros_like(values)
    for bit in order:
        out = (out << np.uint64(1)) | ((values >> np.uint64(bit)) & np.uint64(1))
    return out


class Trie:
    """Levels of a binary trie over sorted distinct values: where each node's values lie, and its children."""

    def __init__(self, values: np.ndarray) -> None:
        self.values, n = values, len(values)
        self.starts, self.zero, self.one = [], [], []
        start = np.array([0], np.int64)
        for level in range(65):
            self.starts.append(np.append(start, n))
            if level == 64:
                break
            new = np.flatnonzero(np.diff(values >> np.uint64(63 - level))) + 1
            below = np.unique(np.concatenate([start, new]))
            first = np.searchsorted(below, start)
            count = np.diff(np.append(first, len(below)))
            bit = ((values[below[first]] >> np.uint64(63 - level)) & np.uint64(1)).astype(bool)
            self.zero.append(np.where(bit, -1, first))
            self.one.append(np.where(bit, first, np.where(count == 2, first + 1, -1)))
            start = below


class Links:
    """Union of positions; ``label`` is the least position known to be connected."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.label[x]
            if (up == x).all():
                return x
            x = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        here = np.arange(len(self.label))
        roots = self.find(here)
        tied = roots != here
        return here[tied], roots[tied]


def trie_join(left: np.ndarray, right: np.ndarray | None, budget: int, close: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among sorted distinct values, of ``left`` with itself or with ``right``; positions in both, one after the other.

    Paths may differ in ``budget`` bits. Values are linked if they differ in no more, or if ``close`` says so of their positions.
    """
    a = Trie(left)
    b = a if right is None else Trie(right)
    shift = 0 if right is None else len(left)
    links = Links(len(left) + (0 if right is None else len(right)))
    if not len(left) or right is not None and not len(right):
        return links.spanning()
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int8))]
    while stack:
        level, x, y, cost = stack.pop()
        if not len(x):
            continue
        if len(x) > _FRONT:
            half = len(x) // 2
            stack += [(level, x[:half], y[:half], cost[:half]), (level, x[half:], y[half:], cost[half:])]
            continue
        sa, sb = a.starts[level], b.starts[level]
        nx, ny = sa[x + 1] - sa[x], sb[y + 1] - sb[y]
        few = nx * ny <= _COMPARED
        if level == 64:
            few[:] = True
        if few.any():
            i0, j0, wide, total = sa[x[few]], sb[y[few]], ny[few], (nx * ny)[few]
            which = np.repeat(np.arange(len(total)), total)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
            i, j = i0[which] + inner // wide[which], j0[which] + inner % wide[which]
            near = np.bitwise_count(left[i] ^ b.values[j]) <= budget if close is None else close(i, j)
            if right is None:
                near &= i < j
            links.add(i[near], j[near] + shift)
            if few.all():
                continue
            x, y, cost = x[~few], y[~few], cost[~few]
        x0, x1, y0, y1 = a.zero[level][x], a.one[level][x], b.zero[level][y], b.one[level][y]
        more = cost + np.int8(1)
        sides = [(x0, y0, cost, None), (x1, y1, cost, None), (x0, y1, more, None), (x1, y0, more, x != y if right is None else None)]
        parts = []
        for p, q, c, only in sides:
            ok = (p >= 0) & (q >= 0) & (c <= budget)
            if only is not None:
                ok &= only
            parts.append((p[ok], q[ok], c[ok]))
        stack.append((level + 1, *(np.concatenate(z) for z in zip(*parts, strict=True))))
    return links.spanning()


def _cells(counts: dict[int, int], cell: int) -> list[tuple[int, int, int]]:
    """(prefix, chunk, chunks of the prefix) of each cell."""
    return [(p, c, k) for p, n in sorted(counts.items()) for k in [max(1, math.ceil(n / cell))] for c in range(k)]


def trie_links(values: DataFrame, budget: int = BUDGET, cell: int = CELL, words: tuple[str, ...] = (), most: int = 0) -> DataFrame:
    """``values`` (fp long, distinct) to links ``a``, ``b`` that connect whatever is within the budget.

    With ``words``, long columns of the values, the trie only finds pairs: those
    whose words differ in ``most`` bits at most are linked, by their column ``node``.
    """
    carried = ["node", *words] if words else []
    n, *ones = values.agg(F.count(F.lit(1)), *[F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1))) for b in range(64)]).first()
    order = sorted(range(64), key=lambda b: abs(2 * (ones[b] or 0) - n))
    depth = min(MOST_DEPTH, max(LEAST_DEPTH, math.ceil(math.log2(max(1, n) / cell))))

    def prefixes(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = permuted(fps, order)
        return own, (own >> np.uint64(64 - depth)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << depth, np.int64)
        for batch in batches:
            total += np.bincount(prefixes(batch.column("fp").to_numpy().view(np.uint64))[1], minlength=1 << depth)
        (seen,) = total.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["p", "n"])

    counts = {r["p"]: r["n"] for r in values.mapInArrow(count, "p long, n long").groupBy("p").agg(F.sum("n").alias("n")).collect()}  # 2^depth numbers at most
    cells = _cells(counts, cell)
    first, chunks = {}, {}
    for i, (p, c, k) in enumerate(cells):
        if c == 0:
            first[p], chunks[p] = i, k
    masks = [m for m in range(1 << depth) if m.bit_count() <= budget]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each value to the tasks of all pairs of its cell with cells within the budget."""
        partners = {p: [first[q] + c for m in masks if (q := p ^ m) in first for c in range(chunks[q])] for p in first}
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            own, prefix = prefixes(fps)
            mixed = (own * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for p in np.unique(prefix).tolist():
                here = prefix == p
                mine = first[p] + (mixed[here] % np.uint64(chunks[p])).astype(np.int64)
                other = np.array(partners[p], np.int64)
                cell_of, with_cell = np.repeat(mine, len(other)), np.tile(other, len(mine))
                low, high = np.minimum(cell_of, with_cell), np.maximum(cell_of, with_cell)
                for at in range(0, len(low), 1 << 18):
                    s = slice(at, at + (1 << 18))
                    rows = pa.array(np.repeat(np.flatnonzero(here), len(other))[s])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(low[s] * len(cells) + high[s]), pa.array((cell_of == low)[s]), *[batch.column(c).take(rows) for c in ("fp", *carried)]],
                        names=["pair", "lower", "fp", *carried],
                    )

    def join(table: pa.Table) -> pa.Table:
        pair = table.column("pair")[0].as_py()
        fps, lower = table.column("fp").to_numpy().view(np.uint64), table.column("lower").to_numpy(zero_copy_only=False)
        alone = pair // len(cells) == pair % len(cells)
        sides = [np.arange(len(fps))] if alone else [lower.nonzero()[0], (~lower).nonzero()[0]]
        sides = [s[np.argsort(permuted(fps[s], order))] for s in sides]
        close = None
        if words:
            bits = [np.stack([table.column(w).to_numpy()[s].view(np.uint64) for w in words]) for s in (sides[0], sides[-1])]

            def close(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                """Word by word, so that most pairs are out after the first."""
                within, differ = np.arange(len(i)), np.zeros(len(i), np.int64)
                for x, y in zip(*bits, strict=True):
                    differ[within] += np.bitwise_count(x[i[within]] ^ y[j[within]])
                    within = within[differ[within] <= most]
                return differ <= most

        a, b = trie_join(*[permuted(fps[s], order) for s in sides], *([None] if alone else []), budget, close)
        names = table.column("node" if words else "fp").to_numpy()[np.concatenate(sides)]
        return pa.table({"a": names[a], "b": names[b]})

    fields = "".join(f", {c} long" for c in carried)
    return values.mapInArrow(deal, f"pair long, lower boolean, fp long{fields}").groupBy("pair").applyInArrow(join, "a long, b long")


def _classes(prints: DataFrame, budget: int) -> DataFrame:
    """``fp``, ``first``, ``component`` of each distinct fingerprint: its least id, and that of its component."""
    values = staged(prints.groupBy("fp").agg(F.min("__key").alias("first")), "prints")
    found = staged(connected(trie_links(values.select("fp"), budget)), "components")
    tied = values.join(found, F.col("fp") == F.col("node"))
    least = tied.groupBy("root").agg(F.min("first").alias("component"))
    linked = found.join(least, "root").select(F.col("node").alias("fp"), "component")
    return values.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row for every input row: ``key``, ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints are linked when at most ``budget`` bits differ; the component is
    called by the least key in it. Texts without a word (null, empty, white space) have the fingerprint zero
    and are linked like any other. Repeated rows repeat; rows with a null key are members but give no name.
    """
    prints = staged(with_fingerprint(df.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text")), "__text", shingle).drop("__text"), "fingerprints")
    out = prints.join(_classes(prints, budget), "fp")
    return out.select(F.col("__key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def _wide_links(values: DataFrame, words: tuple[str, ...], budget: int, most: int) -> DataFrame:
    """Links between the nodes of ``values`` (node long, and the words, distinct together) whose words differ in ``most`` bits at most.

    Values that agree in a whole word are as good as equal: they are tied to the least node among them, and that one goes into the word's trie.
    """
    parts = []
    for w in words:
        one = staged(values.groupBy(w).agg(F.min(F.struct("node", *words)).alias("one"), F.count(F.lit(1)).alias("n")), "words")
        parts.append(trie_links(one.select(F.col(w).alias("fp"), "one.node", *[f"one.{x}" for x in words]), budget, words=words, most=most))
        several = one.filter("n > 1").select(w, F.col("one.node").alias("b"))
        parts.append(values.join(several, w).filter("node <> b").select(F.col("node").alias("a"), "b"))
    return reduce(DataFrame.union, parts)


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = WIDE_SHINGLE, words: int = WIDE_WORDS, budget: int = WIDE_BUDGET, most: int = WIDE_MOST
) -> DataFrame:
    """The rows of ``df`` without near copies: of each component the row with the least key stays (nulls last; of equal keys any one).

    Texts are linked when at most ``most`` bits of their ``words`` fingerprints differ; each word's trie finds the pairs that differ in ``budget``
    bits where it parts. Texts without a word (null, empty, white space) are one component. Columns may have any name.
    The rows are staged once with a number, so that the decision and the rows it is taken on are the same after a retry.
    """
    columns, names = df.columns, tuple(f"w{t}" for t in range(words))
    inner = df.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)], F.col(key).cast("long").alias("__key"))
    fields = T.StructType([T.StructField(w, T.LongType()) for w in names])
    marked = add_columns(inner, f"__c{columns.index(text)}", fields, lambda: lambda texts: [tuple(map(_signed, wide_fingerprint(t, shingle, words))) for t in texts])
    rows = staged(marked.withColumn("__row", F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col("__key").isNull(), F.coalesce("__key", F.lit(0)), "__row")
    values = staged(rows.groupBy(*names).agg(F.min("__row").alias("node"), F.min(place).alias("place")), "prints")
    found = connected(_wide_links(values.select("node", *names), names, budget, most)).withColumnRenamed("node", "linked")
    classed = values.join(found, F.col("node") == F.col("linked"), "left").groupBy(F.coalesce("root", "node").alias("component"))
    kept = classed.agg(F.min("place").alias("place")).select(F.col("place.__row").alias("__row"))
    out = rows.join(kept, "__row", "left_semi")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)])
