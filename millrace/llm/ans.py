"""Token ids as rANS-coded binary blocks: one shared frequency table, independent blocks of interleaved lanes.

File format (``write_ids``): a folder with two Parquet tables, so that it can lie
in any store that Spark reaches and is written with Spark's commit protocol.

``table``: ``id``, ``freq``; the frequencies of all ids of the vocabulary, each at
least 1, with the sum 2^18.

``blocks``: one row for each block, sorted by ``part`` and ``seq``, which is the
ascending order of documents. A block holds whole documents.

    part, seq      place in the order          offset    ids before the block in its part
    doc_ids        documents of the block      lengths   their numbers of ids
    n_tokens       ids in the block            blob      the coded ids

``blob``, little-endian: magic ``MRNS``, u8 precision, u8 zero, u16 lanes, u32 ids, u32 steps of
a segment, u32 segments, u32 crc of the frequency table; for each segment u32 offset in the words and u32
crc32 of its ids (as unsigned 32-bit integers), then ``lanes`` u64 states; then the words (u32).

Id number i of a block lies in step i // lanes, lane i % lanes. A segment is
SEGMENT steps; its stored states and word offset are a checkpoint, so all
segments of all blocks can be decoded side by side, each with its own checksum.
States are in [2^31, 2^63); a lane below 2^31 takes the next word.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import chain, compress, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import CHUNK_ROWS, distinct_cuts, map_texts, partitions, spans
from millrace.session import shared_dir

PRECISION, LANES, SEGMENT = 18, 256, 256
#: A block is closed once it holds so many ids. Blocks coded side by side in one task.
BLOCK_IDS, TOGETHER = 1 << 18, 8
#: Pre-tokens whose ids a worker remembers, those that go to the library's model at once, and bytes of text cut together.
REMEMBERED, TO_MODEL, CHUNK = 1_000_000, 4096, 8 << 20
_HEAD, _LOW = struct.Struct("<4sBBHIIII"), np.uint64(1 << 31)


@dataclass(frozen=True)
class Table:
    """Frequencies with the sum 2^PRECISION, cumulated, and the id of each slot."""

    freq: np.ndarray
    start: np.ndarray
    slots: np.ndarray
    crc: int

    @classmethod
    def of(cls, freq: np.ndarray) -> Table:
        freq = freq.astype(np.uint64)
        start = np.cumsum(freq, dtype=np.uint64) - freq
        return cls(freq, start, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)), zlib.crc32(freq.astype("<u4").tobytes()))


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to the sum 2^PRECISION, at least 1 each; what rounding leaves goes to the largest."""
    room = (1 << PRECISION) - len(counts)
    if room < 0:
        raise ValueError(f"a vocabulary of {len(counts)} ids needs a higher precision")
    total = int(counts.sum())
    freq = 1 + (counts.astype(np.float64) * (room / total) if total else np.zeros(len(counts))).astype(np.int64)
    freq[int(np.argmax(counts))] += (1 << PRECISION) - int(freq.sum())
    return freq


def encode_blocks(table: Table, blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids as a blob. All blocks are coded side by side, from the last step to the first."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    steps = [-(-len(blocks[i]) // LANES) for i in order]
    most, shift, whole = max(steps, default=0), np.uint64(63 - PRECISION), np.uint64(1 << PRECISION)
    ids = np.full((most, len(order), LANES), int(np.argmax(table.freq)), np.uint32)
    for b, i in enumerate(order):
        flat = ids[: steps[b], b].reshape(-1)
        flat[: len(blocks[i])] = blocks[i]
        ids[: steps[b], b] = flat.reshape(-1, LANES)
    words, taken = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, bool)
    state = np.full((len(order), LANES), _LOW, np.uint64)
    saved: dict[int, np.ndarray] = {}
    left = np.array(steps)
    for t in range(most - 1, -1, -1):
        n = int((left > t).sum())
        x, symbol = state[:n], ids[t, :n].astype(np.intp)
        f = table.freq.take(symbol)
        full = x >= (f << shift)
        words[t, :n] = x  # the lower half; the upper one stays
        taken[t, :n] = full
        x = np.where(full, x >> np.uint64(32), x)
        x += x // f * (whole - f)
        state[:n] = x + table.start.take(symbol)
        if t % SEGMENT == 0:
            saved[t] = state[:n].copy()
    out: list[bytes] = [b""] * len(order)
    for b, i in enumerate(order):
        n, parts, offset = len(blocks[i]), [], 0
        flat = blocks[i].astype("<u4")
        for t in range(0, steps[b], SEGMENT):
            parts.append(struct.pack("<II", offset, zlib.crc32(flat[t * LANES : (t + SEGMENT) * LANES].tobytes())))
            parts.append(saved[t][b].astype("<u8").tobytes())
            offset += int(taken[t : min(t + SEGMENT, steps[b]), b].sum())
        head = _HEAD.pack(b"MRNS", PRECISION, 0, LANES, n, SEGMENT, -(-steps[b] // SEGMENT), table.crc)
        own = words[: steps[b], b][taken[: steps[b], b]]
        out[i] = b"".join([head, *parts, own.astype("<u4").tobytes()])
    return out


def decode_blocks(table: Table, blobs: list[bytes]) -> list[np.ndarray]:
    """Ids of each blob; all segments of all blobs side by side, with their checksums compared."""
    sizes, segments = [], []  # of a segment: blob, first step, ids, checksum
    states, starts, streams, at = [], [], [], 0
    for b, blob in enumerate(blobs):
        magic, precision, _, lanes, n, segment, count, crc = _HEAD.unpack_from(blob)
        if (magic, precision, lanes, crc) != (b"MRNS", PRECISION, LANES, table.crc):
            raise ValueError("not a block of this format, or of another frequency table")
        sizes.append(n)
        place = _HEAD.size
        body = place + count * (8 + 8 * lanes)
        stream = np.frombuffer(blob, "<u4", offset=body)
        for k in range(count):
            offset, check = struct.unpack_from("<II", blob, place)
            states.append(np.frombuffer(blob, "<u8", lanes, place + 8))
            starts.append(at + offset)
            segments.append((b, k * segment * lanes, min(segment * lanes, n - k * segment * lanes), check))
            place += 8 + 8 * lanes
        streams.append(stream)
        at += len(stream)
    out = [np.zeros(n, np.uint32) for n in sizes]
    if not segments:
        return out
    order = sorted(range(len(segments)), key=lambda s: -segments[s][2])
    state = np.stack([states[s] for s in order]).astype(np.uint64)
    pointer = np.array([starts[s] for s in order], np.int64)
    stream = np.concatenate([*streams, np.zeros(LANES, np.uint32)])
    steps = np.array([-(-segments[s][2] // LANES) for s in order])
    ids = np.zeros((int(steps[0]), len(order), LANES), np.uint32)
    mask = np.uint64((1 << PRECISION) - 1)
    for t in range(len(ids)):
        n = int((steps > t).sum())
        x = state[:n]
        slot = x & mask
        symbol = table.slots.take(slot.astype(np.intp))
        ids[t, :n] = symbol
        symbol = symbol.astype(np.intp)
        x = table.freq.take(symbol) * (x >> np.uint64(PRECISION)) + slot - table.start.take(symbol)
        low = x < _LOW
        rank = np.cumsum(low, axis=1)
        if rank[:, -1].any():
            word = stream[np.minimum(pointer[:n, None] + rank - 1, len(stream) - 1)]
            x = np.where(low, (x << np.uint64(32)) | word, x)
            pointer[:n] += rank[:, -1]
        state[:n] = x
    for row, s in enumerate(order):
        b, first, n, check = segments[s]
        own = ids[: steps[row], row].reshape(-1)[:n]
        if zlib.crc32(own.astype("<u4").tobytes()) != check:
            raise ValueError(f"block is damaged: wrong checksum at id {first}")
        out[b][first : first + n] = own
    return out


# Tokens -----------------------------------------------------------------------------------------------------------


@cache
def _library(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are Spark's; threads of the library would only wait for each other
    return Tokenizer.from_file(path)


@cache
def _added(path: str) -> tuple[str, ...]:
    """The strings that the tokenizer takes out of a text before it cuts it into pre-tokens."""
    return tuple(t.content for t in _library(path).get_added_tokens_decoder().values())


#: A cut that is a word, marks, and perhaps another line with a word and marks, in ASCII: its pre-tokens, told without their pattern.
_PLAIN_CUT = r"^(?P<a>[A-Za-z]+)(?P<b>[!-/:-@\[-`{-~]*)(?:(?P<c>\n)(?P<d>[A-Za-z]+)(?P<e>[!-/:-@\[-`{-~]*))?$"


class TextIds:
    """Token ids of whole texts, with the library's model; the library would cut a text at the same places itself.

    The distinct cuts of a call become pre-tokens together, and those that are
    not remembered go to the model together. A memory of more than ``size``
    pre-tokens is left with those of the present call.
    """

    def __init__(self, library, pattern: regex.Pattern, size: int) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.pattern, self.size = pattern, size
        self.byte = _byte_characters() | {255: " "}  # UTF-8 has no byte 255, and no other is shown as a space
        self.plain = Tokenizer(library.model)  # without added tokens
        self.plain.pre_tokenizer = CharDelimiterSplit(" ")
        vocabulary = library.get_vocab(with_added_tokens=False)
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.length[list(vocabulary.values())] = list(map(len, vocabulary))
        self.known = {"": 0}
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some pre-tokens, and how many each has."""
        shown = _joined(new.cast(pa.binary()), b"\xff").decode("latin-1").translate(self.byte)
        ids = np.array(self.plain.encode_batch_fast([shown], add_special_tokens=False)[0].ids, np.uint32)
        ends, upto = np.cumsum(pc.binary_length(new).to_numpy(), dtype=np.int64), np.cumsum(self.length[ids])
        last = np.searchsorted(upto, ends)
        if len(upto) and upto[-1] == ends[-1] and (upto[last] == ends).all():
            return ids, np.diff(last + 1, prepend=0)
        found = [[t.id for t in self.plain.model.tokenize(p)] for p in shown.split(" ")]  # the vocabulary lacks a byte
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the memory holds these distinct pre-tokens; new ones are learned."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = pieces.take(pa.array(new))
            ids, sizes = zip(*[self._encode(unknown.slice(k, TO_MODEL)) for k in range(0, len(new), TO_MODEL)], strict=True)
            at[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self.known.update(zip([names[i] for i in new.tolist()], at[new].tolist(), strict=True))
            self.ids, self.sizes = np.concatenate([self.ids, *ids]), np.concatenate([self.sizes, *sizes])
        return at

    def _shrink(self, at: np.ndarray) -> None:
        """Keep the pre-tokens at these places, and the empty one."""
        kept = np.zeros(len(self.sizes), bool)
        kept[at] = kept[0] = True
        self.ids, self.sizes = self.ids[np.repeat(kept, self.sizes)], self.sizes[kept]
        self.known = dict(zip(compress(self.known, kept.tolist()), range(len(self.sizes)), strict=True))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids begin (one entry more than texts), and all ids."""
        starts, numbers, words, begins = distinct_cuts(texts)
        told = pc.extract_regex(words, _PLAIN_CUT)
        plain = told.is_valid().to_numpy(zero_copy_only=False)
        n, word, *others = int(plain.sum()), *told.filter(pa.array(plain)).flatten()
        rest = words.filter(pa.array(~plain))
        pieces = self.pattern.findall(" " + _joined(rest, " ")) if len(rest) else []
        firsts = [self.pattern.findall(b) for b in begins]
        every = pa.concat_arrays([pc.binary_join_element_wise(" ", word, ""), *others, pa.array(chain(pieces, *firsts), words.type)]).dictionary_encode()
        places, width = every.indices.to_numpy(), pc.binary_length(every.dictionary).to_numpy()
        learned = self._places(every.dictionary)
        at = np.concatenate([learned[places[: 5 * n]].reshape(5, n).T.ravel(), learned[places[5 * n :]]])
        last = np.searchsorted(np.cumsum(width[places[5 * n : 5 * n + len(pieces)]], dtype=np.int64), np.cumsum(pc.binary_length(rest).to_numpy() + 1, dtype=np.int64)) + 1
        cuts = np.concatenate([5 * np.arange(n + 1), 5 * n + last, 5 * n + len(pieces) + np.cumsum([len(f) for f in firsts], dtype=np.int64)])
        ends, own = spans((np.cumsum(self.sizes) - self.sizes)[at], self.sizes[at])
        ids, begin = self.ids[own], ends[cuts]
        order = np.concatenate([np.where(plain, np.cumsum(plain), n + np.cumsum(~plain)) - 1, np.arange(len(words), len(cuts) - 1)])
        if len(self.known) > self.size:
            self._shrink(learned)
        ends, own = spans(begin[order][numbers], np.diff(begin)[order][numbers])
        return ends[starts], ids[own]


def _joined(values: pa.Array, between: str | bytes) -> str | bytes:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), between)[0].as_py()


@cache
def _encoder(path: str, pre_tokens: str) -> TextIds:
    return TextIds(_library(path), regex.compile(pre_tokens), REMEMBERED)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printed, the others count on from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


PACKED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("packed", T.BinaryType())])


def tokenized(df: DataFrame, path: str, pre_tokens: str, end_id: int, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and ``packed`` ids (their bytes apart, zstd) of every whole text, with ``end_id`` after each.

    The ids are those of the library's plain call: a text that holds the string of an added token goes to it whole. A null
    text is empty and has the end id alone; an empty table stays empty.
    """

    def make() -> Callable[[pa.Array], list]:
        encode, squeeze = _encoder(path, pre_tokens), zstandard.ZstdCompressor(level=1)
        library, added = _library(path), _added(path)
        width = 2 if max(library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = _planes([end_id], width)

        def work(texts: pa.Array) -> list:
            whole = np.zeros(len(texts), bool)
            for a in added:
                whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
            own = {i: texts[i].as_py() for i in np.flatnonzero(whole).tolist()}
            starts, ids = encode(pc.if_else(pa.array(whole), "", texts) if own else texts)
            planes = _planes(ids, width)
            rows = [b"".join([p[a:b] + e for p, e in zip(planes, end, strict=True)]) for a, b in pairwise(starts.tolist())]
            for i, t in own.items():
                rows[i] = b"".join(_planes([*library.encode(t, add_special_tokens=False).ids, end_id], width))
            return [[len(r) // width for r in rows], [squeeze.compress(r) for r in rows]]

        return work

    return map_texts(df, text, PACKED, make, CHUNK)


def _planes(ids: Sequence[int] | np.ndarray, width: int) -> list[bytes]:
    """The bytes of each id apart, the upper ones of which squeeze to nothing."""
    apart = np.asarray(ids).astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return [apart[:, i].tobytes() for i in range(width)]


@cache
def _expander() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_expander().decompress(data), np.uint8).reshape(-1, n)
    return np.frombuffer(planes.T.tobytes(), f"<u{len(planes)}")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents: one row for each id and task is shuffled, at most ``vocabulary`` come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                total += np.bincount(np.concatenate(list(map(_unpacked, part.column("packed").to_pylist(), part.column("n_tokens").to_pylist()))), minlength=vocabulary)
        (seen,) = total.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    found = tokens.select("packed", "n_tokens").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(vocabulary, np.int64)
    for r in found:
        out[r["id"]] = r["n"]
    return out


BLOCKS = "part int, seq int, offset long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, blob binary"


def _to_blocks(freq: np.ndarray, key: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = Table.of(freq), TaskContext.get().partitionId()
        state = {"seq": 0, "offset": 0}
        ready, docs, sizes, ids, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = []
            for (d, s, _), blob in zip(ready, encode_blocks(table, [x[2] for x in ready]), strict=True):
                rows.append({"part": part, "seq": state["seq"], "offset": state["offset"], "n_tokens": sum(s), "doc_ids": d, "lengths": s, "blob": blob})
                state["seq"] += 1
                state["offset"] += sum(s)
            ready.clear()
            return pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)

        for batch in batches:
            for d, n, x in zip(batch.column(key).to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("packed"), strict=True):
                own = _unpacked(x.as_py(), n)
                docs.append(d)
                sizes.append(len(own))
                ids.append(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    ready.append((docs, sizes, np.concatenate(ids)))
                    docs, sizes, ids, held = [], [], [], 0
                    if len(ready) == TOGETHER:
                        yield flush()
        if docs:
            ready.append((docs, sizes, np.concatenate(ids)))
        if ready:
            yield flush()

    return run


_BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blob", pa.binary())]
)


def write_ids(df: DataFrame, path: str, tokenizer_path: str, pre_tokens: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text (``pre_tokens`` is the pattern of the tokenizer file's byte-level pre-tokens) and write the ids to ``path`` in ascending order of ``key`` (nulls first; equal keys in any order).

    The tokens are staged once in the shared folder: the table needs the counts
    of all of them before the first block can be coded.
    """
    spark = df.sparkSession
    staged = f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    tokenized(df.select(F.col(key).cast("long").alias(key), F.col(text).alias("text")), tokenizer_path, pre_tokens, end_id).drop("text").write.option("compression", "none").parquet(staged)
    tokens = spark.read.schema(T.StructType([T.StructField(key, T.LongType()), *PACKED])).parquet(staged)
    freq = quantised(id_counts(tokens, max(_library(tokenizer_path).get_vocab_size(), end_id + 1)))
    spark.createDataFrame(list(enumerate(freq.tolist())), "id int, freq int").coalesce(1).write.parquet(f"{path}/table")
    ordered = tokens.select(key, "n_tokens", "packed").repartitionByRange(partitions(df), key).sortWithinPartitions(key)
    ordered.mapInArrow(_to_blocks(freq, key), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """Documents of a written folder: ``key``, ``start``, ``n_tokens`` and ``ids`` (packed unsigned 32-bit), or their ``ids_crc32``.

    Blocks are decoded independently, wherever they are read. The parts' sizes,
    one number for each part, are the only thing that goes to every task.
    """
    freq = np.array([r["freq"] for r in spark.read.schema("id int, freq int").parquet(f"{path}/table").orderBy("id").collect()], np.int64)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before, at = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before[r["part"]] = at
        at += r["n"]
    what = ("ids_crc32", pa.int64(), "long") if digest else ("ids", pa.binary(), "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(freq)
        for batch in batches:
            for k in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(k, TOGETHER).to_pylist()
                out: list[list] = [[], [], [], []]
                for r, ids in zip(rows, decode_blocks(table, [r["blob"] for r in rows]), strict=True):
                    start, flat, here = before[r["part"]] + r["offset"], ids.astype("<u4"), 0
                    for d, n in zip(r["doc_ids"], r["lengths"], strict=True):
                        own = flat[here : here + n].tobytes()
                        for column, x in zip(out, (d, start + here, n, zlib.crc32(own) if digest else own), strict=True):
                            column.append(x)
                        here += n
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], what[1])], names=[key, "start", "n_tokens", what[0]])

    return blocks.select("part", "offset", "doc_ids", "lengths", "blob").mapInArrow(run, f"`{key}` long, start long, n_tokens long, {what[0]} {what[2]}")
