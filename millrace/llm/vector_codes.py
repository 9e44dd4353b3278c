"""Vector codes by product quantisation, with Hilbert-sorted blocks.

Vectors become integers, floor(1024 x), and are cut into parts. The pieces of a
part are sorted along a Hilbert curve and cut into flat blocks of ``BLOCK``
pieces, written once with the least and greatest value of each component (a box)
and the sums. A round gives each block a shortlist: an entry whose least distance
to the box exceeds the smallest greatest distance of any entry is nearest to
nothing in the block. A block with one entry left is settled by its sums; the
others are compared with their shortlist only. All figures are integers and
exact, so neither the blocks nor the order of adding can change a result.

Each round sends out the codebooks (parts x entries x components, bounded by the
parameters and the length of a vector) and adds up one row for each component of
an entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import small
from millrace.llm.common import partitions
from millrace.session import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Pieces of a block, and blocks whose boxes are worked on at once.
BLOCK, AT_ONCE = 64, 128
#: From here on a double does not hold every integer.
WHOLE = 2**53
_SUM = "decimal(38,0)"


def usable(vector: str) -> Column:
    """Whether all components are there, finite and, scaled, below 2^53; an empty vector isn't usable."""
    each = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < WHOLE // SCALE), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & each, F.lit(False))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer cells (rows by dimensions, ``bits`` each) on the Hilbert curve, as signed 64-bit numbers in the same order."""
    x = cells.astype(np.uint64).T.copy()
    top, one = 1 << (bits - 1), np.uint64(1)
    q = top
    while q > 1:
        low = np.uint64(q - 1)
        for row in x:
            set_ = (row & np.uint64(q)) > 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ row) & low)
            x[0] ^= np.where(set_, low, np.uint64(0))
            x[0] ^= swap
            row ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & np.uint64(q)) > 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = (place << one) | ((row >> np.uint64(b)) & one)
    return (place ^ np.uint64(2**63)).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch], parts: int, middle: float, spread: float) -> Iterator[pa.RecordBatch]:
    """(row, ints) to one row for each part: its place on the curve and its components."""
    for batch in batches:
        if not batch.num_rows:
            continue
        row, ints = batch.column(0), _matrix(batch.column(1))
        wide = -(-ints.shape[1] // parts)
        ints = np.pad(ints, ((0, 0), (0, wide * parts - ints.shape[1])))
        bits = min(8, max(1, 64 // wide))
        for part in range(parts):
            piece = np.ascontiguousarray(ints[:, part * wide : (part + 1) * wide])
            cells = np.clip((piece[:, : 64 // bits] - middle) / spread * 2 ** (bits - 1) + 2 ** (bits - 1), 0, 2**bits - 1)
            data = [x.tobytes() for x in piece]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(data), part, np.int32)), pa.array(hilbert(cells, bits)), row, pa.array(data, pa.binary())], names=["part", "place", "row", "piece"])


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to blocks of one part."""

    def closed(part: int, rows: list[int], pieces: list[bytes]) -> dict:
        values = np.frombuffer(b"".join(pieces), np.int64).reshape(len(rows), -1)
        total = values.sum(0) if np.abs(values).max() < 2**50 else values.astype(object).sum(0)
        return {"part": part, "rows": rows, "pieces": values.ravel(), "low": values.min(0), "high": values.max(0), "total": [Decimal(int(x)) for x in total]}

    kinds = pa.schema([("part", pa.int32()), ("rows", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())), ("total", pa.list_(pa.decimal128(38, 0)))])
    now, rows, pieces, out = None, [], [], []
    for batch in batches:
        for part, row, piece in zip(*[batch.column(n).to_pylist() for n in ("part", "row", "piece")], strict=True):
            if rows and (part != now or len(rows) == size):
                out.append(closed(now, rows, pieces))
                rows, pieces = [], []
                if len(out) == AT_ONCE:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
                    out = []
            now = part
            rows.append(row)
            pieces.append(piece)
    if rows:
        out.append(closed(now, rows, pieces))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=kinds)


_BLOCK_TYPE = f"part int, rows array<long>, pieces array<long>, low array<long>, high array<long>, total array<{_SUM}>"


def _fits(width: int, largest: int, bits: int) -> bool:
    """Whether sums of squared differences of such values stay below 2^bits."""
    return 4 * width * largest * largest < 2**bits


def _largest(*arrays: np.ndarray) -> int:
    return max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)


def distances(pieces: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exactly: in doubles while they hold the integers, else in 64 bits, else in Python's integers."""
    largest = _largest(pieces, entries)
    if _fits(entries.shape[1], largest, 53):
        a, b = pieces.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    if not _fits(entries.shape[1], largest, 63):
        pieces, entries = pieces.astype(object), entries.astype(object)
    return np.stack([((pieces - e) ** 2).sum(1) for e in entries], 1)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Blocks by entries: whether an entry can be nearest to something in the block's box."""
    low, high = low[:, None, :], high[:, None, :]
    largest = _largest(low, high, entries)
    kind = np.float64 if _fits(entries.shape[1], largest, 53) else np.int64 if _fits(entries.shape[1], largest, 63) else object
    low, high, entries = low.astype(kind), high.astype(kind), entries.astype(kind)[None]
    below, above = low - entries, entries - high
    gap = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(high - entries, entries - low)
    return (gap * gap).sum(2) <= (far * far).sum(2).min(1)[:, None]


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
    """Block by block: part, rows, pieces, shortlist, code of each piece among the shortlist and its distance (None if it has one entry), total."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.asarray(batch.column("part"))
        low, high = _matrix(batch.column("low")), _matrix(batch.column("high"))
        rows, pieces = batch.column("rows"), batch.column("pieces")
        totals = batch.column("total")
        for p in np.unique(part):
            mine = np.flatnonzero(part == p)
            for at in range(0, len(mine), AT_ONCE):
                some = mine[at : at + AT_ONCE]
                for i, listed in zip(some.tolist(), shortlists(low[some], high[some], books[p]), strict=True):
                    entries = np.flatnonzero(listed)
                    row = np.asarray(rows[i].values)
                    piece = np.asarray(pieces[i].values).reshape(len(row), -1)
                    code = far = None
                    if len(entries) > 1:
                        away = distances(piece, books[p][entries])
                        code = away.argmin(1)
                        far = away[np.arange(len(code)), code]
                    yield int(p), row, piece, entries, code, far, totals[i]


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sums: (part, entry, place, figure), with the number of pieces at place -1."""
    count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, object)
    for p, row, piece, entries, code, _, whole in _assigned(batches, books):
        if code is None:
            count[p, entries[0]] += len(row)
            total[p, entries[0]] += np.array([int(x) for x in whole.as_py()], object)
        else:
            chosen, inverse = np.unique(code, return_inverse=True)
            safe = piece if _largest(piece) < 2**50 else piece.astype(object)
            add = np.zeros((len(chosen), piece.shape[1]), safe.dtype)
            np.add.at(add, inverse, safe)
            count[p, entries[chosen]] += np.bincount(inverse)
            total[p, entries[chosen]] += add
    for p, e in zip(*np.nonzero(count), strict=True):
        figures = [int(count[p, e]), *[int(x) for x in total[p, e]]]
        n = len(figures)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(p)] * n, pa.int32()), pa.array([int(e)] * n, pa.int32()), pa.array(range(-1, n - 1), pa.int32()), pa.array([Decimal(x) for x in figures], pa.decimal128(38, 0))],
            names=["part", "entry", "place", "figure"],
        )


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    found = []

    def written() -> pa.RecordBatch:
        row, part, code, error = (np.concatenate(c) for c in zip(*found))
        exact = pa.array(error).cast(pa.decimal128(38, 0)) if error.dtype != object else pa.array([Decimal(int(x)) for x in error], pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(part), pa.array(code), exact], names=["row", "part", "code", "error"])

    for p, row, piece, entries, code, far, _ in _assigned(batches, books):
        if code is None:
            code, far = np.zeros(len(row), int), distances(piece, books[p][entries])[:, 0]
        found.append((row, np.full(len(row), p, np.int32), entries[code].astype(np.int32), far))
        if len(found) == AT_ONCE:
            yield written()
            found = []
    if found:
        yield written()


def _means(books: np.ndarray, sums: list) -> np.ndarray:
    """The entries after a round: floored means, or as they were where nothing was nearest."""
    out, figures = books.copy(), {}
    for r in sums:
        figures.setdefault((r["part"], r["entry"]), {})[r["place"]] = int(r["figure"])
    for (p, e), f in figures.items():
        out[p, e] = [f[i] // f[-1] for i in range(books.shape[2])]
    return out


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``key``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` for every usable row.

    Rows drop out whose vector is null or empty, holds null, NaN or infinity, or a
    component of 2^53 / 1024 or more. All vectors are expected to be of one
    length; the commonest length (of several, the greatest) stays, and a length
    that the number of parts does not divide is filled up with zeros. The
    codebooks start from the rows with the smallest keys (null keys last, equal
    keys by their vectors); with fewer rows than entries there are as many
    entries as rows. Rows with equal keys are rows of their own, null labels are
    one label, an empty table has no result. Errors beyond 64 bits are null.
    Columns other than the three play no part.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v")).filter(usable("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    out = f"{key} {dict(vectors.dtypes)[key]}, code string, error long, label_error long, codebooks_sha256 string"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], out)
    ints = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("ints")
    rows = staged(rows.filter(F.size("v") == sizes["n"]).select(F.monotonically_increasing_id().alias("row"), "key", "label", ints), "vectors")

    def added(power: int) -> Column:
        return F.sum(F.aggregate("ints", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double"), F.lit(power))))

    n, one, two = rows.agg(F.count(F.lit(1)) * sizes["n"], added(1), added(2)).first()
    middle = one / n
    spread = max(1.0, 2.5 * max(0.0, two / n - middle * middle) ** 0.5)
    first = rows.orderBy(F.col("key").asc_nulls_last(), "ints").limit(entries).collect()
    wide = -(-sizes["n"] // parts)
    start = np.pad(np.array([r["ints"] for r in first], np.int64), ((0, 0), (0, wide * parts - sizes["n"])))
    books = np.ascontiguousarray(start.reshape(len(first), parts, wide).transpose(1, 0, 2))

    pieces = rows.select("row", "ints").mapInArrow(lambda b: _pieces(b, parts, middle, spread), "part int, place long, row long, piece binary")
    order = ["part", "place", "row"]
    dealt = pieces.repartitionByRange(partitions(vectors), *order).sortWithinPartitions(*order)
    blocks = staged(dealt.mapInArrow(lambda b: _blocks(b, BLOCK), _BLOCK_TYPE), "blocks")

    for _ in range(rounds):
        sums = blocks.mapInArrow(lambda b, now=books: _sums(b, now), f"part int, entry int, place int, figure {_SUM}")
        books = _means(books, sums.groupBy("part", "entry", "place").agg(F.sum("figure").cast(_SUM).alias("figure")).collect())
    coded = blocks.mapInArrow(lambda b: _codes(b, books), f"row long, part int, code int, error {_SUM}")
    hexed = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("code"))).cast("long"))), 2, "0") for p in range(parts)]
    by_row = coded.groupBy("row").agg(F.concat(*hexed).alias("code"), F.sum("error").cast(_SUM).alias("error"))
    done = staged(rows.select("row", "key", "label").join(by_row, "row"), "codes")
    by_label = small(done.groupBy("label").agg(F.sum("error").cast(_SUM).alias("label_error")).withColumnRenamed("label", "same"))
    joined = done.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    return joined.select(F.col("key").alias(key), "code", *[F.expr(f"try_cast({c} as long)").alias(c) for c in ("error", "label_error")], F.lit(books_sha256(books)).alias("codebooks_sha256"))
