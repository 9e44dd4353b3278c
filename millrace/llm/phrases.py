"""Phrase collocations by SON partitioning.

The documents' partitions are dealt into ``SHARDS`` shards. Each shard is mined
completely: all its word sequences of 1 to 4 words are counted, and those that
reach the local support, least / SHARDS, are kept. What is frequent in the whole
reaches that in some shard, so the union over the shards misses nothing. The
union then is counted over all documents, exactly and by text.

Mining only has to name candidates, so it counts 48-bit hashes: each task sorts
them, cuts them into buckets of the hash and writes the differences, about four
bytes for each distinct sequence. The candidates leave it as a Bloom filter of
at most ``FILTER_BITS`` bits; whatever it lets through besides is counted too and
falls at the support.

Texts are handled as bytes: all separators are ASCII, which no other UTF-8
character contains, and a line feed between two texts parts them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import partitions
from millrace.session import staged

LEAST, LONGEST, INSIDE_PERCENT, SCALE, TOP = 30, 4, 80, 2_000_000, 2_000
#: Shards of the mining; the local support is LEAST / SHARDS, rounded up.
SHARDS = 8
#: Bytes of text worked on at once, sequences held by a task before they are written, bytes of text per hash bucket.
CHUNK, HELD, BUCKET_BYTES = 2 << 20, 3_000_000, 4 << 20
#: Most bits of the candidates' filter (32 MB), and probes for each key.
FILTER_BITS, PROBES = 1 << 28, 3
KEY_BITS = 48

_CLASS = np.zeros(256, np.uint8)  # 1 between words, 2 between pieces
_CLASS[list(b" \t")] = 1
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
#: Two independent hashes: random values of the bytes, odd bases, odd factors of the word places.
_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(0, 2**64, (2, 256), dtype=_U)
_BASE = [int(x) | 5 for x in _RANDOM.integers(0, 2**63, 2)]
_PLACE = _RANDOM.integers(0, 2**64, (2, LONGEST), dtype=_U) | _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, _U)
    out[:1] = 1
    return np.cumprod(out, out=out)


class Words:
    """The words of a chunk of bytes: where they start and end, in which piece, and their hashes."""

    def __init__(self, data: bytes) -> None:
        raw = np.frombuffer(data, np.uint8)
        kind = _CLASS[raw]
        blank = kind == 1
        again = np.zeros(len(raw), bool)
        again[1:] = blank[1:] & blank[:-1]
        if again.any():
            raw, kind = raw[~again], kind[~again]
        self.bytes = _LOWER[raw]
        self.bytes[kind == 1] = 32
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = kind == 0
        turn = np.diff(inside)
        self.start, self.end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]

    def hashes(self, which: int) -> np.ndarray:
        """A polynomial of the word's bytes modulo 2^64, from running sums, and mixed."""
        if not len(self.start):
            return np.zeros(0, _U)
        n, base = len(self.bytes), _BASE[which]
        total = np.zeros(n + 1, _U)
        np.cumsum(_BYTES[which][self.bytes] * _powers(base, n), out=total[1:])
        out = total[self.end] - total[self.start]
        out *= _powers(pow(base, -1, 2**64), n)[self.start]
        return _mix(out + (self.end - self.start).astype(_U))

    def sequences(self, which: int, salt: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For 1 to ``LONGEST`` words: the numbers of the first words of all sequences within a piece, and the sequences' hashes."""
        word = self.hashes(which)
        so_far, out = _mix(word * _PLACE[which][0] + _U(salt)), []
        out.append((np.arange(len(word)), so_far))
        for k in range(1, min(LONGEST, len(word))):
            so_far = _mix(so_far[:-1] + word[k:] * _PLACE[which][k])
            at = np.flatnonzero(self.piece[k:] == self.piece[:-k])
            out.append((at, so_far[at]))
        return out

    def texts(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The bytes from the start of ``first`` to the end of ``last`` words."""
        size = self.end[last] - self.start[first]
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[first] - (ends - size), size)
        offsets = np.zeros(len(size) + 1, np.int64)
        offsets[1:] = ends
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(self.bytes[where]))


def _salt(lang: str, which: int) -> int:
    data = lang.encode()
    return zlib.crc32(data, which) << 32 | zlib.adler32(data, 7 + which)


def _chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK) -> Iterator[tuple[str, bytes]]:
    """(lang, bytes) of at most about ``most`` bytes, cut where a piece ends; a longer piece stays whole."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        size = np.asarray(pc.binary_length(texts))
        open_of: dict[str, list[int]] = {}
        held: dict[str, int] = {}
        for i, lang in enumerate(langs):
            open_of.setdefault(lang, []).append(i)
            held[lang] = held.get(lang, 0) + int(size[i])
            if held[lang] >= most:
                yield from _cut(lang, texts.take(pa.array(open_of.pop(lang))), most)
                held.pop(lang)
        for lang, rows in open_of.items():
            yield from _cut(lang, texts.take(pa.array(rows)), most)


def _cut(lang: str, texts: pa.Array, most: int) -> Iterator[tuple[str, bytes]]:
    data = "\n".join(texts.to_pylist()).encode()
    at = 0
    while at < len(data):
        to = at + most
        if to < len(data):
            near = np.flatnonzero(_CLASS[np.frombuffer(data, np.uint8, to - at, at)] == 2)
            while not len(near) and to < len(data):
                beyond = min(to + most, len(data))
                near = np.flatnonzero(_CLASS[np.frombuffer(data, np.uint8, beyond - to, to)] == 2)[:1] + (to - at)
                to = beyond
            to = at + int(near[-1]) + 1 if len(near) else len(data)
        yield lang, data[at:to]
        at = to


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane (the upper ones are zeros, which compress), and small counts."""
    step = np.diff(keys, prepend=_U(0))
    return step.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T.tobytes() + counts.astype(np.uint8).tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = KEY_BITS // 8
    raw = np.frombuffer(data, np.uint8).reshape(planes + 1, -1)
    step = np.zeros((raw.shape[1], 8), np.uint8)
    step[:, :planes] = raw[:planes].T
    return np.cumsum(step.view(_U).ravel(), dtype=_U), raw[planes]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> _U(64 - KEY_BITS)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(KEY_BITS - 32)) * _U(buckets)) >> _U(32)


def _probe(keys: np.ndarray, bits: int, i: int) -> np.ndarray:
    """The ``i``-th place of the keys among ``bits``."""
    return _mix(keys + _U(i + 1)) % _U(bits)


def _local(batches: Iterator[pa.RecordBatch], buckets: int, support: int) -> Iterator[pa.RecordBatch]:
    """A task's sequences as packed counts by bucket of the hash; the task belongs to one shard."""
    shard = TaskContext.get().partitionId() % SHARDS
    held: list[np.ndarray] = []
    size = 0

    def written() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        edges = np.flatnonzero(np.diff(_bucket(keys, buckets).astype(np.int64), prepend=-1))
        ends = [*edges[1:].tolist(), len(keys)]
        rows = [_pack(keys[a:b], np.minimum(counts[a:b], support)) for a, b in zip(edges.tolist(), ends, strict=True)]
        named = _bucket(keys[edges], buckets).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(named), pa.array(np.full(len(rows), shard, np.int32)), pa.array(rows, pa.binary())], names=["bucket", "shard", "packed"])

    for lang, data in _chunks(batches):
        for _, found in Words(data).sequences(0, _salt(lang, 0)):
            held.append(_short(found))
            size += len(found)
        if size >= HELD:
            yield written()
            held, size = [], 0
    if size:
        yield written()


def _frequent(batches: Iterator[pa.RecordBatch], support: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of buckets to one row for each bucket: the filter of what reaches the support in any shard."""

    def finished(bucket: int, by_shard: dict[int, list[bytes]]) -> pa.RecordBatch:
        keep = []
        for packed in by_shard.values():
            parts = [_unpack(p) for p in packed]
            keys, counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            keep.append(keys[counts >= support])
        union = np.unique(np.concatenate(keep))
        field = np.zeros(bits, bool)
        for i in range(PROBES):
            field[_probe(union, bits, i)] = True
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(union)], pa.int64()), pa.array([np.packbits(field).tobytes()], pa.binary())], names=["bucket", "candidates", "field"])

    now, by_shard = None, {}
    for bucket, shard, packed in (row for b in batches for at in range(0, b.num_rows, 64) for row in zip(*[c.to_pylist() for c in b.slice(at, 64).columns], strict=True)):
        if now is not None and bucket != now:
            yield finished(now, by_shard)
            by_shard = {}
        now = bucket
        by_shard.setdefault(shard, []).append(packed)
    if now is not None:
        yield finished(now, by_shard)


def _counted(batches: Iterator[pa.RecordBatch], fields, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of the filtered sequences by text, chunk by chunk; a null text carries the number of all words."""
    field = np.frombuffer(fields.value, np.uint8)
    for lang, data in _chunks(batches, 2 * CHUNK):
        words = Words(data)
        first, last, one, two = [], [], [], []
        second = words.sequences(1, _salt(lang, 1))
        for k, (at, found) in enumerate(words.sequences(0, _salt(lang, 0))):
            hit = np.arange(len(found))
            for i in range(PROBES):
                keys = _short(found[hit])
                bit = _bucket(keys, buckets) * _U(bits) + _probe(keys, bits, i)
                hit = hit[(field[bit >> _U(3)] << (bit & _U(7)).astype(np.uint8) & 128) > 0]
            first.append(at[hit])
            last.append(at[hit] + k)
            one.append(found[hit])
            two.append(second[k][1][hit])
        first, last, one, two = (np.concatenate(x) for x in (first, last, one, two))
        # sequences of one hash stay apart by the other; a sequence in two runs is summed later, by its text
        order = np.argsort(one)
        one, two = one[order], two[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        heads = np.flatnonzero(new)
        counts = np.diff(heads, append=len(order))
        names = words.texts(first[order[heads]], last[order[heads]]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, pa.array(counts, pa.int64())], names=["lang", "phrase", "a"])
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([len(words.start)], pa.int64())], names=["lang", "phrase", "a"])


def sequence_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``a``: all sequences of 1 to 4 words with ``a`` >= ``least`` occurrences, and for each lang a row of a null phrase with the number of words.

    ``docs``: ``text`` (null: empty) and ``lang`` (null: ``und``); other columns play no part. Repeated rows count each.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * partitions(docs), volume // BUCKET_BYTES)
    bits = 8 * max(64, min(FILTER_BITS, volume // 16) // buckets // 8)
    support = math.ceil(least / SHARDS)
    local = texts.mapInArrow(lambda b: _local(b, buckets, support), "bucket int, shard int, packed binary")
    mined = local.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _frequent(b, support, bits), "bucket int, candidates long, field binary")
    field = bytearray(buckets * bits // 8)
    for row in mined.collect():
        at = row["bucket"] * bits // 8
        field[at : at + bits // 8] = row["field"]
    shared = spark.sparkContext.broadcast(bytes(field))
    found = texts.mapInArrow(lambda b: _counted(b, shared, buckets, bits), "lang string, phrase string, a long")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) | F.col("phrase").isNull())


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each lang: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Words and pieces as the module says; a null lang is ``und``, a null text is
    empty, a lang without a phrase has no row, an empty table gives none. The
    score of a phrase is floor(2000000 a / (l + r)) at its lowest cut, ties to
    the first cut; a phrase inside a longer one with at least 80 % of its
    occurrences goes. Equal scores are ordered by ``a``, then by the bytes of the
    phrase. Extra columns play no part.
    """
    counted = staged(sequence_counts(docs, least), "sequences")
    known = counted.filter(F.col("phrase").isNotNull())
    total = counted.filter(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    words = F.split("phrase", " ", -1)
    phrases = known.withColumn("w", words).withColumn("k", F.size("w")).filter("k > 1")

    def part(first: str, size: str) -> F.Column:
        return F.array_join(F.expr(f"slice(w, {first}, {size})"), " ")

    cuts = phrases.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part("1", "cut").alias("left"), part("cut + 1", "k - cut").alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr(f"(cast({SCALE} as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    spans = F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> array_join(slice(w, i, s), ' '))))")
    inside = phrases.filter("k > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "decimal(22,0)"
    whole = F.col("longer").isNull() | (100 * F.col("longer").cast(wide) < INSIDE_PERCENT * F.col("a").cast(wide))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(whole).select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    order = "order by score desc, a desc, phrase"
    part_of = f"pmod(xxhash64(phrase), {partitions(docs)})"
    first = left.withColumn("place", F.expr(f"row_number() over (partition by lang, {part_of} {order})")).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.expr(f"row_number() over (partition by lang {order})").cast("long")).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
