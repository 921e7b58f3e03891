"""Vector codes against plain Lloyd rounds in Python's whole numbers."""

import math
from collections import defaultdict

import numpy as np
import pytest

from longtrace.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def plain(rows, parts, entries, rounds, scale=1024):
    """[(vec_id, label, code bytes, error, label error)] and the codebooks."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    d = len(kept[0][1]) // parts
    cut = [[v[p * d : p * d + d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

    for r in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if r < rounds:
            for p in range(parts):
                of = defaultdict(list)
                for c, f in zip(cut, found, strict=True):
                    of[f[p][1]].append(c[p])
                books[p] = [[sum(y) // len(of[j]) for y in zip(*of[j], strict=True)] if j in of else c for j, c in enumerate(books[p])]
    total = defaultdict(int)
    for (_, _, label), f in zip(kept, found, strict=True):
        total[label] += sum(x for x, _ in f)
    return [(i, label, bytes(j for _, j in f), sum(x for x, _ in f), total[label]) for (i, _, label), f in zip(kept, found, strict=True)], books


def compared(spark, rows, monkeypatch=None, **kw):
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], SCHEMA).repartition(5)
    got, book = codes.compress(df, **kw)
    want, books = plain(rows, kw["parts"], kw["entries"], kw["rounds"])
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error, r.label_error) for r in got.collect()), key=str) == sorted(want, key=str)
    assert book.tolist() == books or not books and book.size == 0


def made(n, size, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (9, size))
    return [(k, (centres[rng.integers(9)] + rng.normal(0, spread, size)).astype(np.float32).tolist(), int(rng.integers(4))) for k in range(n)]


def test_rounds_equal_plain_ones(spark):
    rows = made(400, 8, 1)
    rows[7] = (7, None, 1)
    rows[9] = (9, [0.5, None] * 4, 1)
    rows[11] = (11, [float("nan")] + [0.0] * 7, 1)
    rows[13] = (13, [float("-inf")] + [0.0] * 7, None)
    rows[15] = (None, rows[15][1], None)
    rows[16] = (None, rows[17][1], None)
    rows += rows[:60]
    compared(spark, rows, parts=4, entries=20, rounds=4)
    compared(spark, rows, parts=2, entries=37, rounds=5, groups=5)


def test_ties_equal_vectors_and_few_rows(spark):
    compared(spark, [(k, [float(k % 3), 1.0, -1.0, float(k % 2)], k % 2) for k in range(50)], parts=4, entries=16, rounds=3)
    compared(spark, [(1, [0.25, -0.75], 3), (2, [1.5, 7.0], None)], parts=2, entries=256, rounds=4)
    compared(spark, [], parts=4, entries=256, rounds=4)


def test_long_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(0, 30_000, 4)).astype(np.float32).tolist(), 0) for k in range(120)]
    compared(spark, rows, parts=2, entries=12, rounds=3)
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1e9, 0.0], 0, "")], SCHEMA), parts=2)
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1.0, 0.0, 1.0], 0, "")], SCHEMA), parts=2)


def test_labels_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", 2)
    monkeypatch.setattr(codes, "LARGE", 30)
    rows = [(k, [float(k % 7), 1.0], None if k < 60 else k % 5) for k in range(120)]
    compared(spark, rows, parts=2, entries=4, rounds=2)


def test_bounds_skip_distances_and_use_net_moves():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * (rng.normal(0, 1, (12, 8))[rng.integers(0, 12, 3000)] + rng.normal(0, 0.05, (3000, 8)))).astype(np.int64)
    books, taken = [x[:64]], 0
    known = codes.scanned(x, books[0], 16, 0)
    for _ in range(5):
        books.append(np.array([x[known.code == j].sum(0) // max(1, (known.code == j).sum()) if (known.code == j).any() else books[-1][j] for j in range(64)]))
        known, n = codes.rescanned(x, books, known, 16)
        taken += n
        assert (codes.squared(x, books[-1]).argmin(1) == known.code).all()
    assert taken < 0.6 * 5 * 3000 * 64
    # entries that moved away and came back leave every bound as it was: the net move is zero, though the moves add up
    away = [books[-1], books[-1] + 100_000, books[-1]]
    fresh = codes.scanned(x, away[0], 16, 0)
    again, n = codes.rescanned(x, away, fresh, 16)
    ties = (codes.squared(x, away[0]) == fresh.near[:, None]).sum(1) > 1
    assert (again.code == fresh.code).all() and n <= 64 * (ties.sum() + 50)
