"""Token counts under a unigram model, worked out along a trie of pre-tokens.

The distinct pre-tokens of a task go into one trie of bytes. Each node holds the
best score of any segmentation of its prefix into tokens and that
segmentation's number of tokens; it is computed once, from the nodes above it,
however many pre-tokens share the prefix. The terminal of a pre-token so holds
its count, and the count of a text is the sum over its pre-tokens.

The model scores a token by its rank in the given vocabulary, with the
Zipf-Mandelbrot law ``-ln(rank + SHIFT)``: ranks are given in the order of
frequency. Equal scores go to the fewer tokens, then to the longer last token.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import NumberedCuts, map_texts, pre_tokens
from millrace.llm.prefix_bpe import Ranks

SHIFT = 2.7
#: Nodes, and terminal counts, that a worker keeps before it starts anew, and bytes beyond which a pre-token is scored without leaving nodes.
MAX_NODES, MAX_DEPTH = 400_000, 64
#: Pre-tokens in the trie of one pass over its levels.
AT_ONCE = 8192


class Suffixes:
    """The vocabulary read backwards as a table of states, so that one walk meets all tokens that a prefix may end with and stops where no token ends so.

    Row ``state`` of ``below`` gives the state after one byte more, 0 if there is none; ``score`` is that of the token read
    so far, NaN if it is none. States without any byte more come last and have no row.
    """

    def __init__(self, scores: dict[bytes, float]) -> None:
        links: list[dict[int, int]] = [{}]
        ends: dict[int, float] = {}
        for token, score in scores.items():
            at = 0
            for byte in reversed(token):
                after = links[at].get(byte)
                if after is None:
                    after = links[at][byte] = len(links)
                    links.append({})
                at = after
            ends[at] = score
        order = sorted(range(len(links)), key=lambda i: not links[i])
        place = np.empty(len(links), np.int32)
        place[order] = np.arange(len(links))
        self.inner = max(1, sum(map(bool, links)))
        self.below = np.zeros((self.inner, 256), np.int32)
        for i, after in enumerate(links):
            for byte, to in after.items():
                self.below[place[i], byte] = place[to]
        self.score = np.full(len(links), np.nan)
        for i, score in ends.items():
            self.score[place[i]] = score
        self._next, self._score = memoryview(self.below).cast("B").cast("i"), self.score.tolist()

    def ending(self, data: bytes, end: int) -> Iterator[tuple[int, float]]:
        """Start and score of each token that ends at ``end``, the shortest first."""
        at = 0
        for start in range(end - 1, -1, -1):
            at = self._next[at << 8 | data[start]]
            if not at:
                return
            score = self._score[at]
            if score == score:
                yield start, score
            if at >= self.inner:
                return


class Node:
    __slots__ = ("below", "score", "count", "terminal")

    def __init__(self, score: float, count: int) -> None:
        self.below, self.score, self.count, self.terminal = {}, score, count, None


class UnigramTrie:
    """``counts`` works on many pre-tokens at once, ``count`` on one after the other in a trie that stays."""

    def __init__(self, scores: dict[bytes, float]) -> None:
        self.suffixes = Suffixes(scores)
        self.computed = 0
        self._clear()

    def _clear(self) -> None:
        self.root, self.nodes = Node(0.0, 0), 1

    def _forward(self, data: bytes, end: int, before: list[tuple[float, int]]) -> tuple[float, int]:
        """Best score and count of the first ``end`` bytes; ``before[i]`` is that of the first i."""
        self.computed += 1
        best = None
        for start, own in self.suffixes.ending(data, end):
            score, count = before[start]
            made = (score + own, -count - 1)
            if best is None or made > best:
                best = made
        if best is None:
            raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
        return best[0], -best[1]

    def counts(self, pieces: list[bytes]) -> list[int]:
        """Tokens of each pre-token. In sorted order a pre-token shares the nodes of its common beginning with the one before."""
        out = [0] * len(pieces)
        order = sorted(range(len(pieces)), key=pieces.__getitem__)
        short = [i for i in order if len(pieces[i]) <= MAX_DEPTH]
        for at in range(0, len(short), AT_ONCE):
            some = short[at : at + AT_ONCE]
            for i, n in zip(some, self._levels([pieces[i] for i in some]), strict=True):
                out[i] = n
        for i in order:
            if len(pieces[i]) > MAX_DEPTH:
                out[i] = self.count(pieces[i])
        return out

    def _levels(self, ordered: list[bytes]) -> list[int]:
        """Terminal counts of sorted pre-tokens; all nodes of one depth at a time, each computed once."""
        n, size = len(ordered), np.fromiter(map(len, ordered), np.int64, len(ordered))
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        data = np.zeros((n, width), np.uint8)
        data[inside] = np.frombuffer(b"".join(ordered), np.uint8)
        new = inside.copy()
        new[1:] &= ~np.logical_and.accumulate((data[1:] == data[:-1]) & inside[:-1], axis=1)
        node = np.zeros((width + 1, n), np.int64)  # by depth and pre-token; nodes count from 1, level by level, 0 is the root
        node[1:] = np.cumsum(new.T).reshape(width, n)
        score, count = np.zeros(node[-1, -1] + 1), np.zeros(node[-1, -1] + 1, np.int64)
        suffixes = self.suffixes
        for depth in range(1, width + 1):
            rows = np.flatnonzero(new[:, depth - 1])
            best, fewest = np.full(len(rows), -np.inf), np.zeros(len(rows), np.int64)
            live, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for start in range(depth - 1, -1, -1):
                state = suffixes.below[state, data[rows[live], start]]
                go = state > 0
                live, state = live[go], state[go]
                if not len(live):
                    break
                before = node[start, rows[live]]
                made, tokens = score[before] + suffixes.score[state], count[before] + 1
                better = (made > best[live]) | ((made == best[live]) & (tokens < fewest[live]))
                best[live[better]], fewest[live[better]] = made[better], tokens[better]
                go = state < suffixes.inner
                live, state = live[go], state[go]
            if (fewest == 0).any():
                raise ValueError(f"the vocabulary has no token for byte {data[rows[(fewest == 0).argmax()], depth - 1]}")
            own = node[depth, rows]
            score[own], count[own] = best, fewest
            self.computed += len(rows)
        return count[node[size, np.arange(n)]].tolist()

    def count(self, data: bytes) -> int:
        """Tokens of a pre-token; it stays in the trie."""
        if len(data) > MAX_DEPTH:
            before = [(0.0, 0)]
            for end in range(1, len(data) + 1):
                before.append(self._forward(data, end, before))
            return before[-1][1]
        if self.nodes > MAX_NODES:
            self._clear()
        node, before = self.root, [(0.0, 0)]
        for end in range(1, len(data) + 1):
            below = node.below.get(data[end - 1])
            if below is None:
                below = node.below[data[end - 1]] = Node(*self._forward(data, end, before))
                self.nodes += 1
            node = below
            before.append((node.score, node.count))
        if node.terminal is None:
            node.terminal = node.count
        return node.terminal


class Counter:
    """Pre-tokens and tokens of whole texts, from those of their distinct cuts."""

    def __init__(self, vocabulary: Ranks, pattern: str, shift: float = SHIFT) -> None:
        self.trie = UnigramTrie({b: -math.log(r + shift) for b, r in vocabulary.ranks.items()})
        self.pattern = regex.compile(pattern)
        self.cuts = NumberedCuts(self._learn, self._forget)
        self.terminals: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.learned: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        if len(self.terminals) > MAX_NODES:
            self.terminals.clear()

    def _learn(self, cuts: list[str]) -> None:
        """A pre-token whose terminal count was met before does not go into the trie again."""
        known, pieces = self.terminals, pre_tokens(cuts, self.pattern)
        new = list(set(chain.from_iterable(pieces)).difference(known))
        known.update(zip(new, self.trie.counts([p.encode() for p in new]), strict=True))
        self.learned.append(np.array([(len(own) - own.count(""), sum([known[p] for p in own])) for own in pieces], np.int64).reshape(-1, 2))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        starts, numbers = self.cuts(texts)
        self.learned = [np.concatenate(self.learned)]
        return [np.add.reduceat(x, starts[:-1]) if len(x) else x for x in self.learned[0][numbers].T]


@cache
def _counter(path: str, pattern: str, shift: float) -> Counter:
    return Counter(Ranks.load(path), pattern, shift)


COUNTS = T.StructType([T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counts(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", shift: float = SHIFT) -> DataFrame:
    """``df`` with ``n_pretokens`` and ``n_tokens`` of every whole text; no exchange.

    Null and empty texts count 0, repeated rows repeat, an empty table stays
    empty, and an input column with a result's name is replaced.
    """
    return map_texts(df, text, COUNTS, lambda: _counter(ranks_path, pattern, shift))
