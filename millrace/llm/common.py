"""What several operators share: Arrow maps that keep the other columns, and text cut at safe boundaries."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handled at once in a Python worker: bounds the Python objects alive, not the result.
CHUNK_ROWS = 256
#: Bytes of text that ``map_texts`` hands on at once, a longer text being handed on whole.
CHUNK_BYTES = 4 << 20


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, for exchanges whose number has to be stated."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def add_columns(df: DataFrame, text: str, fields: T.StructType, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``df`` with the columns that a function of the whole text gives.

    ``make`` is called once in each task and returns a function from a list of
    texts (a null text is the empty text) to one tuple per text. A column of
    the input that has the name of a result is replaced by the result.
    """
    new = {f.name for f in fields}
    kept = [f.name for f in df.schema if f.name not in new]
    schema = T.StructType([df.schema[n] for n in kept] + list(fields))
    hidden = "__text_of_this_row"
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                texts = [x or "" for x in part.column(hidden).to_pylist()]
                rows = work(texts)
                columns = [part.column(n) for n in kept]
                columns += [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=kept + [f.name for f in arrow])

    return df.select(*[F.col(f"`{n}`") for n in kept], F.col(text).cast("string").alias(hidden)).mapInArrow(run, schema)


def map_texts(df: DataFrame, text: str, fields: T.StructType, make: Callable[[], Callable[[pa.Array], list]], chunk: int = CHUNK_BYTES) -> DataFrame:
    """As ``add_columns``, but the function takes an Arrow array of whole texts (null is empty; ``chunk`` bytes at once) and returns one sequence of values for each new column."""
    new = {f.name for f in fields}
    kept = [f.name for f in df.schema if f.name not in new]
    schema = T.StructType([df.schema[n] for n in kept] + list(fields))
    hidden = "__text_of_this_row"
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = pc.fill_null(batch.column(hidden), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, side="right")))
                columns = [batch.column(n).slice(at, to - at) for n in kept]
                columns += [pa.array(x, type=f.type) for x, f in zip(work(texts.slice(at, to - at)), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=kept + [f.name for f in arrow])
                at = to

    return df.select(*[F.col(f"`{n}`") for n in kept], F.col(text).cast("string").alias(hidden)).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return simple[kind.simpleString()]


#: A cut that is one word, and marks that end it: letters of Unicode's Latin blocks, which no later version will take back.
_PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")


def pre_tokens(cuts: list[str], pattern: re.Pattern) -> list[Sequence[str]]:
    """The matches of the byte-level pre-token pattern in each cut; plain words are told without it, and come with the marks after them or with an empty one."""
    plain, every = _PLAIN.fullmatch, pattern.findall
    return [found.groups() if (found := plain(c)) else every(c) for c in cuts]


def distinct_cuts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str]]:
    """Texts as sequences of their distinct cuts, without a Python object for each cut.

    No match of the byte-level pre-token pattern goes over a space that is
    followed by something that is not white space, so a text is cut there. A
    part that does not begin so (several spaces, a space before a line end)
    stays joined to the one before.

    Returns where each text's cuts begin (one entry more than texts; each text has a cut), the place of every cut among
    the distinct ones, and these: first the cuts that begin with such a space, without it, then the first cuts of texts.
    No text is null.
    """
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), pa.array([], pa.string()), []
    parts = pc.split_pattern(texts, " ")
    flat, starts = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    later = np.ones(len(flat), bool)
    later[starts[:-1]] = False
    found = flat.filter(pa.array(later)).dictionary_encode()
    words, places = found.dictionary, found.indices.to_numpy()
    begins = flat.take(pa.array(starts[:-1])).to_pylist()
    bound = _bound(words)  # no cut can be made before these: they belong to the part before
    numbers = np.empty(len(flat), np.int64)
    if bound.any():
        joined = np.zeros(len(flat), bool)
        joined[later] = bound[places]
        whole = _whole(flat, joined)
        numbers[later] = (np.cumsum(~bound) - 1)[places]
        words = words.filter(pa.array(~bound))
        longer = dict.fromkeys(w for b, w in whole.items() if later[b])  # each holds a space, so it is none of the words
        place = dict(zip(longer, range(len(words), len(words) + len(longer)), strict=True))
        text_of = dict(zip(starts[:-1].tolist(), range(len(begins)), strict=True))
        for b, w in whole.items():
            if later[b]:
                numbers[b] = place[w]
            else:
                begins[text_of[b]] = w
        words = pa.concat_arrays([words, pa.array(longer, words.type)])
    else:
        numbers[later] = places
    firsts = dict(zip(dict.fromkeys(begins), count(len(words)), strict=False))
    numbers[starts[:-1]] = np.fromiter(map(firsts.__getitem__, begins), np.int64, len(begins))
    if bound.any():
        starts = np.concatenate([[0], np.cumsum(~joined)])[starts]
        numbers = numbers[~joined]
    return starts, numbers, words, list(firsts)


def _bound(words: pa.Array) -> np.ndarray:
    """The words that are empty or begin with white space."""
    out = ~pc.match_substring_regex(words, "^[!-~]").to_numpy(zero_copy_only=False)
    at = np.flatnonzero(out)
    out[at] = [not w or w[0].isspace() for w in words.take(pa.array(at)).to_pylist()]
    return out


def _whole(flat: pa.Array, joined: np.ndarray) -> dict[int, str]:
    """By its place, each part that others are joined to, with those."""
    at = np.flatnonzero(joined)
    breaks = np.flatnonzero(np.diff(at) > 1)
    begin, end = at[np.concatenate([[0], breaks + 1])] - 1, at[np.concatenate([breaks, [len(at) - 1]])] + 1
    return {b: " ".join(flat.slice(b, e - b).to_pylist()) for b, e in zip(begin.tolist(), end.tolist(), strict=True)}


class NumberedCuts:
    """Texts as sequences of numbers of their cuts, which are remembered from call to call.

    Those that were not met before are numbered on and given to ``learn``. A full memory starts
    anew before the next call, with ``forget``.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], size: int = 350_000) -> None:
        self.learn, self.forget, self.size = learn, forget, size
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}
        self.n = 0

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's cuts begin (one entry more than texts; each text has a cut), and the numbers of all cuts. No text is null."""
        if self.n >= self.size:
            self.first, self.later, self.n = {}, {}, 0
            self.forget()
        starts, places, words, begins = distinct_cuts(texts)
        later = self._numbers(self.later, words.to_numpy(zero_copy_only=False).tolist(), " ")
        return starts, np.concatenate([later, self._numbers(self.first, begins, "")])[places]

    def _numbers(self, known: dict[str, int], cuts: list[str], before: str) -> np.ndarray:
        new = [c for c in cuts if c not in known]
        if new:
            known.update(zip(new, range(self.n, self.n + len(new)), strict=True))
            self.n += len(new)
            self.learn([before + c for c in new])
        return np.fromiter(map(known.__getitem__, cuts), np.int64, len(cuts))


class CutIds:
    """Token ids of whole texts from those of their distinct pre-tokens.

    ``encode`` gives the ids of pre-tokens that are not remembered, as packed unsigned 32-bit integers.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], pattern: re.Pattern, size: int = 350_000) -> None:
        self.encode, self.pattern, self.size = encode, pattern, size
        self.known: dict[str, bytes] = {}
        self.cuts = NumberedCuts(self._learn, self._forget, size)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.new_ids: list[bytes] = []
        if len(self.known) > self.size:
            self.known.clear()

    def _learn(self, cuts: list[str]) -> None:
        known, pieces = self.known, pre_tokens(cuts, self.pattern)
        new = list(set(chain.from_iterable(pieces)).difference(known))
        known.update(zip(new, self.encode(new), strict=True))
        self.new_ids += [b"".join([known[p] for p in own]) for own in pieces]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids begin (one entry more than texts), and all ids."""
        starts, numbers = self.cuts(texts)
        if self.new_ids:
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, self.new_ids), np.int64, len(self.new_ids)) // 4])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(self.new_ids), "<u4")])
            self.new_ids = []
        sizes = self.sizes[numbers]
        begin = np.cumsum(self.sizes) - self.sizes
        ends, at = spans(begin[numbers], sizes)
        return ends[starts], self.ids[at]


def spans(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of an array, one after the other: where each begins in the result (one entry more), and the places that they cover."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1])
    at += np.repeat(begin - ends[:-1], sizes)
    return ends, at
