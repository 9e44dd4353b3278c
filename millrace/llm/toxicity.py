"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is a sequence of words. The input of a word is the embedding of the word
next to the mean embedding of its character trigrams (with marks at both ends),
both by hashed place. Two gated recurrent layers read a window of words in both
directions, attention pools their states, and a logistic unit scores the window.
The score of a text is the highest of all its overlapping windows, so a long
text is read to its end and one bad passage is enough.

Training is plain numpy on a bounded sample of labelled rows: each text is a bag of windows
of which the highest counts, so every few epochs the windows are scored anew
and the leading one of each text is learned from, next to random windows of clean texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import add_columns

#: STEPS: batches in an epoch, of 16 windows at least.
#: Labelled rows of each class that are fitted on at most, and characters beyond which a text is not taken for fitting.
FIT_ROWS, FIT_CHARS = {1: 2000, 0: 3000}, 3000
WINDOW, STRIDE = 32, 24
THRESHOLD = 0.3
WORD_PLACES, CHAR_PLACES, WORD_SIZE, CHAR_SIZE, HIDDEN = 8192, 8192, 8, 8, 8
EPOCHS, STEPS, RATE, LEADERS_EVERY = 12, 45, 0.03, 2
#: Share of words that a training step sees by their characters only, so that unseen forms of a stem are judged alike.
HIDDEN_WORDS = 0.5
#: Words whose inputs a worker remembers.
REMEMBERED = 300_000
_TOGETHER = 2048


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _bare(word: str) -> str:
    """Without what is neither letter nor digit at its ends."""
    if word.isalnum():
        return word
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def features(word: str) -> tuple[int, list[int]]:
    """Place of the word and of each of its character trigrams; place 0 of words is for none. A very long word is read whole."""
    word = _bare(word)
    if not word:
        return 0, [0]
    marked = f"^{word}$".encode()
    return 1 + zlib.crc32(marked) % (WORD_PLACES - 1), [zlib.crc32(marked[i : i + 4]) % CHAR_PLACES for i in range(max(1, len(marked) - 3))]


def windows(n: int) -> list[int]:
    """Where the windows of a text of ``n`` words begin: every STRIDE words until the end is read."""
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE)) if n > WINDOW else [0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 * _sigmoid(2 * x) - 1


@dataclass
class Words:
    """Distinct words of a set of texts: places, and the trigrams' places flat with their words."""

    place: np.ndarray
    chars: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> Words:
        found = [features(w) for w in words]
        return cls(np.array([f[0] for f in found], np.int64), np.array([c for f in found for c in f[1]], np.int64), np.repeat(np.arange(len(found)), [len(f[1]) for f in found]))


class Network:
    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        d, h = WORD_SIZE + CHAR_SIZE, HIDDEN

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": draw(WORD_PLACES, WORD_SIZE, scale=0.1), "char": draw(CHAR_PLACES, CHAR_SIZE, scale=0.3)}
        for side in "fb":
            self.p |= {"w" + side: draw(d, 3 * h, scale=d**-0.5), "u" + side: draw(h, 3 * h, scale=h**-0.5), "c" + side: np.zeros(3 * h, np.float32)}
        self.p |= {"att": draw(2 * h, 2 * h, scale=(2 * h) ** -0.5), "att_c": np.zeros(2 * h, np.float32), "att_v": draw(2 * h, scale=0.5), "out": draw(2 * h, scale=0.3), "out_c": np.zeros(1, np.float32)}
        self.trained = False
        self.known, self.rows = {}, np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)

    def inputs(self, words: Words) -> np.ndarray:
        """One row for each distinct word."""
        n = len(words.place)
        total = np.zeros((n, CHAR_SIZE), np.float32)
        if n:
            starts = np.flatnonzero(np.diff(words.owner, prepend=-1))
            total = np.add.reduceat(self.p["char"][words.chars], starts, axis=0) / np.diff(np.append(starts, len(words.chars)))[:, None]
        return np.concatenate([self.p["word"][words.place], total], axis=1).astype(np.float32)

    def forward(self, x: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``index`` (windows, WINDOW) into the rows of ``x``; ``mask`` is 1 at words."""
        p, h, (n, t) = self.p, HIDDEN, index.shape
        states, saved = np.zeros((n, t, 2 * h), np.float32), {}
        for side, steps in (("f", range(t)), ("b", range(t - 1, -1, -1))):
            ready = x @ p["w" + side] + p["c" + side]
            now, log = np.zeros((n, h), np.float32), []
            at = slice(0, h) if side == "f" else slice(h, 2 * h)
            for s in steps:
                a, u, m = ready[index[:, s]], now @ p["u" + side], mask[:, s, None]
                zr = _sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = _tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
                if keep:
                    log.append((s, now, z, r, new, u[:, 2 * h :]))
                now = now + m * z * (new - now)
                states[:, s, at] = now
            saved[side] = log
        e = _tanh(states @ p["att"] + p["att_c"])
        weight = np.exp(np.clip(e @ p["att_v"], -30, 30)) * mask
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", weight, states)
        logit = pooled @ p["out"] + p["out_c"][0]
        return (logit, (states, saved, e, weight, pooled)) if keep else logit

    def gradient(self, words: Words, index: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, h, x = self.p, HIDDEN, self.inputs(words)
        logit, (states, saved, e, weight, pooled) = self.forward(x, index, mask, keep=True)
        g = {}
        d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["out"], g["out_c"] = pooled.T @ d, d.sum(keepdims=True)
        dpooled = d[:, None] * p["out"]
        dstates = weight[:, :, None] * dpooled[:, None, :]
        dweight = np.einsum("nth,nh->nt", states, dpooled)
        dscore = weight * (dweight - (weight * dweight).sum(axis=1, keepdims=True))
        g["att_v"] = np.einsum("nth,nt->h", e, dscore)
        de = dscore[:, :, None] * p["att_v"] * (1 - e * e)
        g["att"], g["att_c"] = np.einsum("nth,ntk->hk", states, de), de.sum(axis=(0, 1))
        dstates += de @ p["att"].T
        dx = np.zeros_like(x)
        for side in "fb":
            u, at = p["u" + side], slice(0, h) if side == "f" else slice(h, 2 * h)
            dready, du, dnow = np.zeros((len(x), 3 * h), np.float32), np.zeros_like(u), np.zeros((len(y), h), np.float32)
            for s, before, z, r, new, un in reversed(saved[side]):
                m = mask[:, s, None]
                dnow = dnow + dstates[:, s, at]
                dz = dnow * m * (new - before) * z * (1 - z)
                dn = dnow * m * z * (1 - new * new)
                dr = dn * un * r * (1 - r)
                pre, rec = np.concatenate([dz, dr, dn], axis=1), np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(dready, index[:, s], pre)
                du += before.T @ rec
                dnow = dnow * (1 - m * z) + rec @ u.T
            g["w" + side], g["u" + side], g["c" + side] = x.T @ dready, du, dready.sum(axis=0)
            dx += dready @ p["w" + side].T
        share = np.bincount(words.owner, minlength=len(x))[words.owner][:, None]
        for name, places, rows in (("word", words.place, dx[:, :WORD_SIZE]), ("char", words.chars, dx[words.owner, WORD_SIZE:] / share)):
            g[name] = np.zeros_like(p[name])
            np.add.at(g[name], places, rows)
        return g

    def scores(self, texts: list[str]) -> list[float]:
        """The highest window of each text; 0 to 1."""
        return [max(x) for x in self.window_scores(texts)] if self.trained else [0.0] * len(texts)

    def _remembered(self, words: list[str]) -> np.ndarray:
        """``inputs`` of the words, each worked out once; the memory starts anew when it is full."""
        if len(self.known) > REMEMBERED:
            self.known, self.rows = {}, np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)
        missing = [w for w in words if w not in self.known]
        if missing:
            self.known |= zip(missing, range(len(self.known), len(self.known) + len(missing)), strict=True)
            if len(self.known) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), 2 * len(missing)), self.rows.shape[1]), np.float32)])
            self.rows[len(self.known) - len(missing) : len(self.known)] = self.inputs(Words.of(missing))
        return self.rows[[self.known[w] for w in words]]

    def window_scores(self, texts: list[str]) -> list[np.ndarray]:
        split = [words_of(t) for t in texts]
        words, index, mask, sizes = laid_out(split)
        x, out = self._remembered(words), []
        for at in range(0, len(index), _TOGETHER):
            out.append(_sigmoid(self.forward(x, index[at : at + _TOGETHER], mask[at : at + _TOGETHER])))
        return np.split(np.concatenate(out), np.cumsum(sizes)[:-1]) if out else []


def laid_out(split: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, list[int]]:
    """Distinct words, windows as indexes into them, masks, and the windows of each text."""
    number: dict[str, int] = {"": 0}
    flat = [[number.setdefault(w, len(number)) for w in words] for words in split]
    starts = [windows(len(f)) for f in flat]
    index = np.zeros((sum(map(len, starts)), WINDOW), np.int64)
    mask = np.zeros(index.shape, np.float32)
    row = 0
    for f, places in zip(flat, starts, strict=True):
        own = np.array(f or [0], np.int64)
        for s in places:
            piece = own[s : s + WINDOW]
            index[row, : len(piece)] = piece
            mask[row, : len(piece)] = 1
            row += 1
    return list(number), index, mask, [len(s) for s in starts]


def train(texts: list[str], labels: list[int], seed: int = 7, epochs: int = EPOCHS, odds: float | None = None) -> Network:
    """Adam on the leading windows; without both classes the network stays untrained and scores 0.

    ``odds`` are those of label 1 among all labelled rows: the sample may hold
    more of one class, which the last bias makes good.
    """
    net, r = Network(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return net
    distinct, index, mask, sizes = laid_out([words_of(t) for t in texts])
    words = Words.of(distinct)
    ends = np.cumsum(sizes)
    first, count = ends - sizes, np.array(sizes)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, leading = 0, first.copy()
    for epoch in range(epochs):
        if epoch > 1 and epoch % LEADERS_EVERY == 0:
            x = net.inputs(words)
            logit = np.concatenate([net.forward(x, index[a : a + _TOGETHER], mask[a : a + _TOGETHER]) for a in range(0, len(index), _TOGETHER)])
            leading = np.array([a + int(np.argmax(logit[a:b])) for a, b in zip(first, ends, strict=True)])
        rows = np.arange(len(y)) if epoch > 1 else np.flatnonzero(count <= 4) if (count[y == 1] <= 4).any() and (count[y == 0] <= 4).any() else np.arange(len(y))
        clean = rows[y[rows] == 0]
        chosen = np.concatenate([leading[rows], first[clean] + (r.random(len(clean)) * count[clean]).astype(np.int64)])
        target = np.concatenate([y[rows], np.zeros(len(clean), np.float32)])
        order = r.permutation(len(chosen))
        batch = max(16, -(-len(order) // STEPS))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            own, local = np.unique(index[chosen[pick]], return_inverse=True)
            known = _subset(words, own)
            known.place[r.random(len(own)) < HIDDEN_WORDS] = 0
            g = net.gradient(known, local.reshape(len(pick), -1), mask[chosen[pick]], target[pick])
            step += 1
            for k, v in g.items():
                a, b = moment[k]
                a += 0.1 * (v - a)
                b += 0.001 * (v * v - b)
                net.p[k] -= (RATE * (1 - epoch / (epochs + 1)) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    if odds:
        net.p["out_c"] += np.float32(np.log(odds) - np.log(y.sum() / (len(y) - y.sum())))
    net.trained = True
    return net


def _subset(words: Words, own: np.ndarray) -> Words:
    starts = np.searchsorted(words.owner, own)
    sizes = np.searchsorted(words.owner, own, side="right") - starts
    flat = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return Words(words.place[own], words.chars[flat], np.repeat(np.arange(len(own)), sizes))


# Spark ------------------------------------------------------------------------------------------------------------


def held_out(key: str) -> F.Column:
    """Rows that are never fitted on: remainder 2 of the CRC-32 of the key as text modulo 4. A null key reads as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """A network fitted on at most FIT_ROWS labelled rows of each class that are not held out.

    They are the first in the order of a hash of the key; the sample's size
    does not depend on the tables. Rows without label or text are not fitted on.
    """
    known = labels.filter(~held_out(key) & F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__y"))
    parts = [known.filter(F.col("__y") == y).orderBy(F.xxhash64("__key"), "__key").limit(n) for y, n in FIT_ROWS.items()]
    chosen = parts[0].union(parts[1])
    share = known.agg(F.sum("__y"), F.sum(1 - F.col("__y"))).first()
    short = F.col(text).isNotNull() & (F.length(text) <= FIT_CHARS)
    rows = documents.filter(short).select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key").select("__key", "__text", "__y")  # as many rows as FIT_ROWS says
    found = sorted((r["__key"], r["__text"], r["__y"]) for r in rows.dropDuplicates(["__key"]).collect())
    return train([f[1] for f in found], [f[2] for f in found], odds=share[0] / share[1] if share[0] and share[1] else None)


def score(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``df`` with ``score`` of every whole text; no exchange.

    Null, empty and white-space texts are scored as a window without words; repeated
    rows repeat; an empty table stays empty; an input column called ``score`` is replaced.
    """
    return add_columns(df, text, T.StructType([T.StructField("score", T.DoubleType())]), lambda: lambda texts: [(float(s),) for s in network.scores(texts)])
