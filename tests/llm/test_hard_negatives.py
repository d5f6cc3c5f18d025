"""Hard negatives against plain counting, and bounds that hold."""

import math
import random

import numpy as np
import pytest

from sessionloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, width int"


def brute(rows):
    usable = {}
    for i, x, label, *_ in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * c) for c in x])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a, (la, va) in usable.items():
        if a % 100:
            continue
        scores = [(-sum(p * q for p, q in zip(va, v)), i, label) for i, (label, v) in usable.items()
                  if i != a and len(v) == len(va)]
        for ps, p, _ in sorted(s for s in scores if s[2] == la)[:5]:
            fits = sorted((s, i) for s, i, label in scores if label != la and 30 * -ps <= 100 * -s <= 90 * -ps)
            out += [(a, p, rank, i, -ps, -s) for rank, (s, i) in enumerate(fits[:10], 1)]
    return sorted(out)


def table_of(seed, n=900, width=7, ties=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        label = 3 if rng.random() < 0.3 else rng.randrange(10)
        x = [(rng.choice([-0.5, 0.0, 0.5]) if ties else rng.gauss(0, 0.4)) + (0.3 if j == label % width else 0) for j in range(width)]
        rows.append((k, x, label, k, "x", 3))
    return rows


ODD = [(100, None, 3, 1, "x", 1), (None, [0.1] * 7, 3, 1, "x", 1), (200, [0.1] * 7, None, 1, "x", 1),
       (901, [float("nan")] + [0.1] * 6, 3, 1, "x", 1), (902, [float("inf")] + [0.1] * 6, 3, 1, "x", 1),
       (903, [None] + [0.1] * 6, 3, 1, "x", 1), (1000, [], 3, 1, "x", 1), (1001, [], 3, 1, "x", 1), (1003, [], 4, 1, "x", 1),
       (1100, [0.5, 0.25], 3, 1, "x", 1), (1101, [0.5, 0.5], 3, 1, "x", 1), (1102, [0.4, 0.1], 5, 1, "x", 1)]


@pytest.mark.parametrize("ties", [False, True])
def test_result_equals_brute_force(spark, ties, monkeypatch):
    for name, value in (("LEAST_ROWS", 100), ("BLOCK_ANCHORS", 4)):
        monkeypatch.setattr(hn, name, value)
    rows = table_of(1, ties=ties) + ODD
    rows += [rows[300], rows[300], (300, [0.9] * 7, 9, 1, "x", 1)]  # repeated, and one id with two vectors
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, hn.hard_negatives(frame).collect()))
    assert got == brute(rows) and len(got) > 100


def test_empty_tables_and_lone_labels(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = [(k, [0.1 * k], 2, 1, "x", 1) for k in (100, 101, 102, 103)]
    assert hn.hard_negatives(spark.createDataFrame(lone, SCHEMA)).count() == 0
    assert hn.hard_negatives(spark.createDataFrame([(1, [0.1], 2, 1, "x", 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("width", [1, 3, 16, 33])
def test_bounds_hold_and_grow_narrower(width):
    rng = np.random.default_rng(width)
    a = np.floor(rng.normal(40, 90, (30, width)))
    b = np.floor(np.concatenate([rng.normal(-20, 90, (30, width)), np.full((2, width), 7.0)]))
    x, y = hn.Summary(a), hn.Summary(b)
    exact, before = a @ b.T, None
    for level in range(len(x.parts)):
        low, high = hn.bounds(x, y, level)
        assert (low <= exact).all() and (exact <= high).all()
        some = np.array([0, 3, 7]), np.array([1, 31, 5])
        for whole, part in zip((low, high), hn.bounds(x, y, level, *some)):
            assert np.allclose(whole[some], part)
        assert before is None or ((high - low) <= before + 1e-6).all()
        before = high - low


def test_large_components_stay_exact():
    big = np.array([[1 << 30, 3], [1 << 30, 4]], np.int64)
    scorer = hn.Scorer(big)
    tile = scorer.tile(big)
    x, y = np.array([0, 1]), np.array([1, 1])
    assert scorer.scores(tile, x, y).tolist() == [(1 << 60) + 12, (1 << 60) + 16]


def test_pruned_pairs_cannot_reach_the_range():
    """Pairs left out by the bounds are outside; on vectors with a few strong segments most are."""
    rng = np.random.default_rng(4)
    rows = np.zeros((400, 64), np.int64)
    for k in range(400):
        rows[k, 16 * (k % 4):16 * (k % 4) + 16] = rng.integers(80, 90, 16)
    scorer = hn.Scorer(rows[:8])
    tile = scorer.tile(rows)
    x, y = scorer.undecided(tile, np.ones((8, 400), bool), np.full(8, 50_000.0), np.full(8, np.inf))
    exact = rows[:8] @ rows.T
    assert set(zip(*np.nonzero(exact >= 50_000))) <= set(zip(x.tolist(), y.tolist())) and len(x) < 0.3 * exact.size
