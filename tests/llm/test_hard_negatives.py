"""Operator 13: bounds, and whole results against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, row long, block long, dim int, part long, positives string"


def brute(rows, positives=5, negatives=10):
    own = []
    for k, (i, label, x) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        own.append((k, i, label, [max(-2 ** 62, min(2 ** 62, math.floor(256 * float(np.float32(c))))) for c in x]))
    last = lambda i: (i is None, i or 0)
    out = []
    for k, i, label, x in own:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, m, other) for m, j, other, y in own if m != k and len(y) == len(x)]
        scored = [(max(-hn.LARGEST, min(hn.LARGEST, s)), *r) for s, *r in scored]
        scored.sort(key=lambda r: (-r[0], last(r[1]), r[2]))
        for p, j, _, _ in [r for r in scored if r[3] == label][:positives]:
            hard = [r for r in scored if r[3] != label and 30 * p <= 100 * r[0] <= 90 * p][:negatives]
            out += [(i, j, rank, r[1], p, r[0]) for rank, r in enumerate(hard, 1)]
    return sorted(out, key=str)


def mined(spark, rows, partitions=3, **options):
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in rows], SCHEMA).repartition(partitions)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in hn.mine(frame, F.col("vec_id") % 100 == 0, label=label, **options).collect()), key=str)


def vectors(n, dim, seed, centres=6):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centres, dim)) * 0.2
    return [(i, int(r.integers(0, 10)), (middle[r.integers(0, centres)] + r.normal(size=dim) * 0.1).tolist()) for i in range(n)]


@pytest.mark.parametrize("dim", [1, 3, 16, 64])
def test_bounds_hold_at_every_level_and_get_finer(dim):
    x = np.random.default_rng(dim).integers(-300, 300, size=(200, dim)).astype(float)
    means, spreads = (a.astype(np.float32).astype(float) for a in hn.summaries(x))
    exact, length, done, width = x @ x.T, np.sqrt((x * x).sum(axis=1)), 0, None
    for first in hn.levels(dim):
        part = slice(done, done + len(first))
        done += len(first)
        reach = spreads[:, part] @ spreads[:, part].T + hn.SLACK * np.outer(length, length) + 1e-9
        middle = means[:, part] @ means[:, part].T
        assert (middle - reach <= exact).all() and (exact <= middle + reach).all()
        assert width is None or reach.mean() < width
        width = reach.mean()


@pytest.mark.parametrize(("n", "dim", "rows", "anchors"), [(900, 64, 8192, 4096), (900, 16, 70, 2), (300, 2, 50, 1)])
def test_equals_brute_force(ready, monkeypatch, n, dim, rows, anchors):
    monkeypatch.setattr(hn, "ROWS", rows)
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    data = vectors(n, dim, n + dim)
    assert mined(ready, data) == brute(data)


def test_the_summaries_settle_candidates_without_their_score():
    data = vectors(2000, 64, 1, centres=3)
    x = hn.whole_numbers(np.array([v for _, _, v in data]))
    means, spreads = hn.summaries(x.astype(float))
    # smooth vectors: neighbours alike, so means say nearly all
    smooth = np.repeat(x[:, :16], 4, axis=1)
    m, s = hn.summaries(smooth.astype(float))
    block = hn.Block(64, np.arange(2000), np.ones(2000, dtype=bool), np.array([v[1] for v in data]), np.arange(2000), smooth, m, s)
    scored = []
    exact = block.scores
    block.scores = lambda at, vector: scored.append(len(at)) or exact(at, vector)
    block.positives(int(block.labels[0]), 0, smooth[0], m[0], s[0], 5)
    assert scored[0] < 20


def test_odd_rows(ready):
    r = random.Random(8)
    data = [(i, r.choice([0, 1, 2, None]), [r.choice([0.0, 0.5, -0.25, 0.125]) for _ in range(4)]) for i in range(0, 400, 5)]
    data += [(100, 1, [0.5] * 4)] * 3 + [(None, 1, [0.5] * 4)] * 2 + [(None, 2, [0.25] * 4)] * 2       # copies, null ids
    data += [(200, 1, None), (300, 1, [1.0, None, 0.0, 0.0]), (300, 2, [float("nan"), 0.0, 0.0, 0.0]), (300, 2, [float("inf"), 0.0, 0.0, 0.0])]
    data += [(500, 1, []), (505, 1, []), (506, 2, []), (600, 1, [1.0, 2.0]), (601, 1, [1.0, 1.0]), (602, 2, [0.5, 0.5])]     # other lengths
    got = mined(ready, data, partitions=1)
    assert got == brute(data)
    assert any(g[0] == 500 for g in got) and any(g[0] == 600 for g in got) and any(g[3] is None for g in got)
    assert mined(ready, []) == [] and mined(ready, [(1, 1, [1.0])]) == []


def test_very_large_components(ready):
    data = [(i * 50, i % 3, [3e15 * (i + 1), 1e30 if i == 4 else 2.0, -1.0]) for i in range(12)]
    assert mined(ready, data, partitions=1) == brute(data)


def test_a_vector_that_a_third_of_the_rows_share(ready, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 40)
    data = vectors(400, 8, 3) + [(1000 + i, i % 4, [0.25] * 8) for i in range(200)]
    assert mined(ready, data) == brute(data)
