"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a pre-token there is exactly one token that can stand
last in the prefix's BPE encoding. ``PrefixTable`` stores it for each prefix.
Appending bytes only adds entries, so the encoding of any prefix, and of the
text after an append, is exact without starting over; an edit keeps all entries
before it. The work is linear in the bytes, whatever the length of a pre-token.

Whether token ``b`` may follow token ``a`` depends on the two alone: BPE joins
adjacent parts in the order of rank, so the boundary between them holds unless
some part that ends ``a`` and some part that begins ``b`` form a token whose
turn comes while both are still unmerged. At equal rank the left pair goes first.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import CutIds, map_texts

_NEVER = 1 << 62


class Ranks:
    """A vocabulary of byte strings with their ranks, and what follows from it."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.parents: dict[int, tuple | None] = {}
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def load(cls, path: str) -> Ranks:
        with open(path, "rb") as f:
            return cls({base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())})

    def merged(self, data: bytes, below: int = _NEVER) -> list[bytes]:
        """Plain BPE of a short byte string, using only tokens of lower rank than ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens it is merged from; () for a single byte; None if BPE never makes it."""
        if token not in self.parents:
            data = self.bytes_of[token]
            if len(data) == 1:
                self.parents[token] = ()
            else:
                parts = self.merged(data, token)
                self.parents[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self.parents[token]

    def spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that touch one end of a token, with the rank at which each is merged into the next."""
        known = self.right if side else self.left
        if token not in known:
            out, at, until = [], token, _NEVER
            while True:
                out.append((self.bytes_of[at], until))
                halves = self.halves(at)
                if not halves:
                    break
                until, at = at, halves[side]
            known[token] = out
        return known[token]

    def may_follow(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[(a, b)] = not any(
                (rank := self.ranks.get(x + y, _NEVER)) < until_x and rank <= until_y and rank < _NEVER
                for x, until_x in self.spine(a, 1)
                for y, until_y in self.spine(b, 0)
            )
        return known


class PrefixTable:
    """The last token of every prefix of one pre-token."""

    def __init__(self, vocabulary: Ranks, data: bytes = b"") -> None:
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> PrefixTable:
        ranks, may_follow, halves = self.vocabulary.ranks, self.vocabulary.may_follow, self.vocabulary.halves
        done, last = len(self.data), self.last
        self.data = data = self.data + more
        for end in range(done + 1, len(data) + 1):
            for start in range(max(0, end - self.vocabulary.longest), end):
                token = ranks.get(data[start:end])
                if token is not None and (not start or may_follow(last[start - 1], token)) and halves(token) is not None:
                    last.append(token)
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
        return self

    def replace(self, start: int, end: int, new: bytes) -> PrefixTable:
        """Put ``new`` in the place of bytes start..end; entries of the prefixes before it are kept."""
        tail = new + self.data[end:]
        self.data, self.last = self.data[:start], self.last[:start]
        return self.append(tail)

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all by default."""
        at, out = len(self.data) if end is None else end, []
        while at:
            out.append(token := self.last[at - 1])
            at -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class Codec:
    """Texts to ids and back; pre-tokens are the matches of ``pattern``, each encoded by itself."""

    def __init__(self, vocabulary: Ranks, pattern: str, size: int = 400_000) -> None:
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.of_texts = CutIds(lambda new: [self._encoded(p) for p in new], self.pattern, size)
        self.known: dict[str, bytes] = {}
        self.size = size
        self.table = vocabulary.bytes_of

    def _encoded(self, piece: str) -> bytes:
        ids = PrefixTable(self.vocabulary, piece.encode("utf-8")).tokens()
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= self.size:
                self.known.clear()
            found = self.known[piece] = self._encoded(piece)
        return found

    def encode_packed(self, texts: pa.Array) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        starts, ids = self.of_texts(texts)
        packed, ends = ids.astype("<u4", copy=False).tobytes(), (4 * starts).tolist()
        return [packed[a:b] for a, b in pairwise(ends)]

    def encode(self, text: str) -> list[int]:
        return list(memoryview(self.encode_packed(pa.array([text], pa.string()))[0]).cast("I"))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, memoryview(packed).cast("I").tolist()))


class EditableText:
    """A text with its pre-tokens, encoded anew only near an edit."""

    #: Pre-tokens that are not white space, before an edit, that are matched again. The pattern looks at most two characters beyond a match.
    BACK = 3

    def __init__(self, codec: Codec, text: str) -> None:
        self.codec, self.text = codec, text
        self.pieces = codec.pattern.findall(text)

    def replace(self, start: int, end: int, new: str) -> EditableText:
        starts, at = [], 0
        for p in self.pieces:
            starts.append(at)
            at += len(p)
        keep = sum(1 for s in starts if s < start)
        solid = 0
        while keep and solid < self.BACK:
            keep -= 1
            solid += not self.pieces[keep].isspace()
        old, shift = set(starts), len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        out, at = self.pieces[:keep], starts[keep] if keep < len(starts) else 0
        for m in self.codec.pattern.finditer(self.text, at):
            if m.start() > start + len(new) and m.start() - shift in old:
                out += self.pieces[starts.index(m.start() - shift) :]
                break
            out.append(m.group())
        self.pieces = out
        return self

    def tokens(self) -> list[int]:
        return [t for p in self.pieces for t in memoryview(self.codec._piece(p)).cast("I")]


@cache
def _codec(path: str, pattern: str) -> Codec:
    """One for each Python worker; workers are used again for later tasks."""
    return Codec(Ranks.load(path), pattern)


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
IDS = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
TEXTS = T.StructType([T.StructField("decoded", T.BinaryType())])


def encode_column(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``.

    No exchange: each task encodes its own rows. Null and empty texts have no
    ids, rows repeat as they come, an empty table stays empty, and an input
    column called ``ids`` or ``n_tokens`` is replaced. The file of ranks has to
    be readable on every executor, as an installed package is.
    """

    def make():
        codec = _codec(ranks_path, pattern)

        def work(texts):
            packed = codec.encode_packed(texts)
            return [packed, [len(x) // 4 for x in packed]]

        return work

    return map_texts(df, text, IDS, make)


def encode_and_check(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, the digest of the ids and the digest of the bytes decoded from those ids."""

    def make():
        codec = _codec(ranks_path, pattern)

        def work(texts):
            packed = codec.encode_packed(texts)
            return [[len(x) // 4 for x in packed], [hashlib.sha256(x).hexdigest() for x in packed], [hashlib.sha256(codec.decode(x)).hexdigest() for x in packed]]

        return work

    return map_texts(df, text, DIGESTS, make)
