"""Vector codes against plain loops over all entries, in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, label_error string, place string"


def plain(rows, parts=4, entries=256, rounds=4):
    """Rows (vec_id, vector, label) of one length, all usable."""
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in rows]
    wide = -(-len(ints[0]) // parts)
    cut = [[(v + [0] * (wide * parts - len(v)))[p * wide : (p + 1) * wide] for p in range(parts)] for v in ints]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def nearest(p, w):
        return min((sum((a - b) ** 2 for a, b in zip(w, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for e, g in groups.items():
                books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    found = [[nearest(p, v[p]) for p in range(parts)] for v in cut]
    errors, by_label = [sum(d for d, _ in f) for f in found], {}
    for (_, _, label), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    def long(x):
        return x if x < 2**63 else None

    sha = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(((k, "".join(f"{e:02x}" for _, e in f), long(err), long(by_label[label]), sha) for (k, _, label), f, err in zip(rows, found, errors)), key=str)


def got(frame, **more):
    out = vc.vector_codes(frame, **more)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def rows_of(frame):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]


def test_equals_plain_loops(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("vec_id < 120")
    assert got(frame, entries=16) == plain(rows_of(frame), entries=16)


@pytest.mark.parametrize("scale", [1.0, 5e4, 1e6, 1e9])
def test_odd_vectors(spark, scale):
    """Nulls in every column, equal vectors and keys, ties, zeros, components that need 64 bits and more, a length that four does not divide, fewer rows than entries."""
    draw = random.Random(3)
    rows = [(i, [draw.choice([-1, -0.5, 0, 0.25, 1]) * scale for _ in range(7)], i % 3 or None) for i in range(60)]
    rows += [rows[5], rows[5], (5, [0.0] * 7, 1), (None, [0.1 * scale] * 7, None), (900, [scale] * 7, 4)]
    rows = [(k, np.array(v, np.float32).astype(float).tolist(), lab) for k, v, lab in rows]
    bad = [(1, None, 1), (2, [], 1), (3, [None] * 7, 1), (4, [float("nan")] * 7, 1), (6, [float("inf")] + [0.0] * 6, 1), (7, [1.0, 2.0], 1), (8, [3e38] * 7, None)]
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows + bad], SCHEMA).repartition(3)
    for entries in (8, 256):
        assert got(frame, entries=entries) == plain(rows, entries=entries)


def test_one_hot_vector(spark, monkeypatch):
    """Most rows are one vector: blocks of it are settled by their sums."""
    monkeypatch.setattr(vc, "BLOCK", 5)
    draw = random.Random(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 4 else [draw.random() for _ in range(4)], 0) for i in range(400)]
    rows = [(k, np.array(v, np.float32).astype(float).tolist(), lab) for k, v, lab in rows]
    assert got(spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA), entries=20) == plain(rows, entries=20)


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == [] and got(spark.createDataFrame([(1, None, 1, "", "", "", "")], SCHEMA)) == []


@pytest.mark.parametrize(("wide", "bits"), [(2, 3), (3, 2), (1, 6)])
def test_hilbert_steps_to_neighbours(wide, bits):
    cells = np.array(np.meshgrid(*[range(2**bits)] * wide)).reshape(wide, -1).T
    walk = cells[np.argsort(vc.hilbert(cells, bits))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlists_hold_the_nearest():
    draw = np.random.default_rng(5)
    points, entries = draw.integers(-50, 50, (40, 8, 6)), draw.integers(-50, 50, (30, 6))
    listed = vc.shortlists(points.min(1), points.max(1), entries)
    for block, allowed in zip(points, listed):
        assert allowed[vc.distances(block, entries).argmin(1)].all()
