import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from finsight.llm import vector_codes as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, k=256, rounds=4):
    """Plain k-means in Python integers, every distance computed."""
    kept = [(i, [math.floor(1024 * np.float64(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    size = len(kept[0][1]) // parts
    x = np.asarray([r[1] for r in kept], object).reshape(len(kept), parts, size)
    books = x[:k].copy()

    def nearest(points, entries):
        d = np.asarray([((points - e) ** 2).sum(axis=1) for e in entries]).T
        return d.argmin(axis=1), d.min(axis=1)

    for step in range(rounds + 1):
        codes, errors = zip(*(nearest(x[:, p], books[:, p]) for p in range(parts)), strict=True)
        if step < rounds:
            for p in range(parts):
                for e in range(len(books)):
                    if len(own := x[codes[p] == e, p]):
                        books[e, p] = [int(s) // len(own) for s in own.sum(axis=0)]
    error = sum(errors)
    labels = {}
    for r, e in zip(kept, error, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + int(e)
    said = ",".join(str(books[e][p][d]) for p in range(parts) for e in range(len(books)) for d in range(size))
    digest = hashlib.sha256(said.encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{codes[p][n]:02x}" for p in range(parts)), int(error[n]), labels[r[2]], digest)
                  for n, r in enumerate(kept))


def vectors(n, width, seed, spread=0.2, centers=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, spread, (centers, width))
    return [(i * 3, [float(np.float32(x)) for x in middle[i % centers] + rng.normal(0, spread / 4, width)], i % 5 if i % 7 else None)
            for i in rng.permutation(n).tolist()]


def got(spark, rows, **hints):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "code", "state", "error", "n", "hot", "need")})
    return sorted((str(r[0]), *r[1:]) for r in op.report(df.repartition(3)).collect())


@pytest.mark.parametrize("b", [(8, 2, 16), (2, 2, 4), (1, 1, 1)])
def test_matches_plain_kmeans(spark, monkeypatch, b):
    monkeypatch.setattr(op, "FIRST_B", b[0])
    monkeypatch.setattr(op, "LEAST_B", b[1])
    monkeypatch.setattr(op, "MOST_B", b[2])
    monkeypatch.setattr(op, "ENTRIES", 32)
    rows = vectors(700, 16, 5)
    rows += rows[:20]  # repeated rows
    rows += [(9000 + i, [0.25 * ((i + d) % 3) for d in range(16)], 2) for i in range(60)]  # many ties
    rows += [(1, None, 1), (2, [None] * 16, 1), (4, [float("nan")] + [0.0] * 15, 1), (5, [float("inf")] * 16, None)]
    assert got(spark, rows) == brute(rows, k=32)


def test_full_codebooks_and_fewer_vectors_than_entries(spark):
    rows = vectors(600, 8, 6)
    assert got(spark, rows) == brute(rows)
    rows = vectors(40, 8, 7)
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:1]) == brute(rows[:1])


def test_large_components_are_exact(spark):
    rows = vectors(120, 8, 8, spread=3e4)
    assert got(spark, rows) == brute(rows)
    huge = [(i, [3e38 * (-1) ** i] * 8, 0) for i in range(4)]
    assert all(r[2] == 0 for r in got(spark, huge))  # at the border of the range


def test_bounds_hold_and_save_work(monkeypatch):
    rng = np.random.default_rng(2)
    centers = rng.integers(-400, 400, (32, 4))
    points = centers[rng.integers(0, 32, 3000)] + rng.integers(-20, 20, (3000, 4))
    state = np.zeros(3000, op.state_type(8))
    op.search_all(points, centers, state)
    skipped = 0
    for b in (8, 4, 6, 2, 12):
        books = op.Codebooks(centers[None]).replaced((centers + rng.integers(-4, 5, centers.shape))[None], np.ones((1, 32), int))
        centers = books.entries[0]
        state, d2, need = op.search_bounded(points, centers, books.moved[0], state, b)
        exact = op.squared(points, centers)
        assert (state["entry"] == exact.argmin(axis=1)).all()
        assert (d2[d2 >= 0] == exact.min(axis=1)[d2 >= 0]).all()
        skipped += int((d2 < 0).sum())
        d = np.sqrt(exact)
        rows = np.arange(3000)
        assert (state["upper"] >= d[rows, state["entry"]]).all()
        bound = np.repeat(state["outer"][:, None].astype(float), 32, axis=1)
        for z in range(b):  # an entry that is held twice counts by its better bound
            better = state["low"][:, z] < 1e29
            at = rows[better], state["near"][better, z]
            bound[at] = np.minimum(np.where(bound[at] == state["outer"][better], np.inf, bound[at]), state["low"][better, z])
        bound[rows, state["entry"]] = 0
        assert (bound <= d).all()
    assert skipped > 3000


def test_odd_lengths_and_empty(spark):
    rows = vectors(30, 8, 9) + [(1_000, [1.0, 2.0], 3), (1_001, [], None)]
    out = {r[0]: r for r in got(spark, rows)}
    assert out["1000"][1:3] == (None, None) and out["1001"][1] is None and len(out) == 32
    assert sum(r[1] is not None for r in out.values()) == 30
    assert [r[1] for r in got(spark, [(1, [1.0, 2.0, 3.0], 0)])] == [None]
    assert op.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert got(spark, [(None, [0.5] * 4, None), (None, [0.5] * 4, None)])[0][1:4] == ("00000000", 0, 0)
