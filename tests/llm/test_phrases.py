"""Phrase mining against a plain count of everything."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain(rows, least, top):
    count, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in plain_words(text):
            words[lang] += len(piece)
            count.update((lang, tuple(piece[i : i + k])) for k in range(1, 5) for i in range(len(piece) - k + 1))
    frequent = {g: c for g, c in count.items() if len(g[1]) > 1 and c >= least}
    out = {}
    for (lang, w), a in frequent.items():
        longer = [b for (other, v), b in frequent.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (count[lang, w[:k]] + count[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, words[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    }


def got(frame, **more):
    found = phrases.collocations(frame, **more)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in found.collect()}


def test_equals_plain_count(docs):
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert got(docs, least=10, top=50) == plain(rows, 10, 50)


@pytest.mark.parametrize("least", [1, 2])
def test_odd_rows(odd, least):
    """Nulls, empty texts, tabs and repeated blanks, letters beyond ASCII, repeated rows and ties; all sequences count at 1."""
    rows = [tuple(r) for r in odd.select("text", "lang").collect()]
    short = odd.filter("length(text) < 3000 or text is null")
    rows = [r for r in rows if r[0] is None or len(r[0]) < 3000]
    assert got(short, least=least, top=10**6) == plain(rows, least, 10**6)


def test_very_long_text_is_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 1000)
    text = ("alpha beta  gamma\tdelta, Beta gamma. " * 300 + "one piece of many words " * 200 + "! alpha beta") * 2
    frame = spark.createDataFrame([(text, "x"), ("alpha beta", "x"), (text[::-1], None)], "text string, lang string")
    rows = [tuple(r) for r in frame.collect()]
    pieces = b"".join(d for _, d in phrases._chunks(iter([__import__("pyarrow").RecordBatch.from_pydict({"lang": ["x"], "text": [text]})])))
    assert pieces == text.encode()
    assert got(frame, least=5, top=100) == plain(rows, 5, 100)


def test_empty(empty, odd):
    assert got(empty) == set() and got(odd.withColumn("text", F.lit(None).cast("string"))) == set()


def test_packed_counts_come_back():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 2**48, 1000, dtype=np.uint64))
    keys = np.unique(np.concatenate([keys, [0, 2**48 - 1]]).astype(np.uint64))
    counts = (keys % np.uint64(7)).astype(np.uint8)
    back = phrases._unpack(phrases._pack(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all()
