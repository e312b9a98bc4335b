"""Hard negatives against a search over all rows."""

import math
import random

import numpy as np
import pytest

from caseflow.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, block int, q string"


def plain(rows):
    """(anchor, positive score, negative score, rank, ids) by brute force."""
    some = []
    for i, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        q = [max(-2**20, min(2**20, math.floor(256 * float(np.float32(x))))) for x in v]
        some.append((i, label, q))
    out = []

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    for n, (i, label, v) in enumerate(some):
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=False)), j, k == label)
                  for m, (j, k, w) in enumerate(some) if m != n]
        for p, j, _ in sorted([x for x in scores if x[2]], key=order)[:5]:
            fit = [x for x in scores if not x[2] and 80 * p <= 100 * x[0] <= 100 * p]
            out += [(i, j, r, x[1], p, x[0]) for r, x in enumerate(sorted(fit, key=order)[:5], 1)]
    return out


def unit(r, near=None):
    v = np.array([r.gauss(0, 1) for _ in range(16)])
    if near is not None:
        v = np.array(near) + 0.2 * v
    return (v / np.linalg.norm(v)).tolist()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    centre = unit(r)
    out = []
    for i in range(900):
        v = centre if i % 3 == 0 and i < 300 else unit(r, centre if i % 2 else None)
        out.append((i, v, r.choice([0, 0, 0, 1, 2, 9, -3])))
    nan, inf = float("nan"), float("inf")
    out += [(1000, None, 1), (1100, [nan] * 16, 1), (1200, [inf] + [0.0] * 15, 0), (1300, [None] + [0.1] * 15, 0),
            (1400, unit(r), None), (None, unit(r, centre), 0), (None, centre, 1), (1500, [], 0), (1600, [0.5], 0),
            (1700, [3e38] * 16, 1), (1800, [-1.0] * 16, 2), (700, centre, 0), (700, centre, 0), (100, centre, 1)]
    return [(*x, 1, "x") for x in out]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 7, "shelf": 3, "group": 4}])
def test_against_all_rows(spark, rows, sizes):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hard_negatives.mine(docs, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_empty_and_without_anchors(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert hard_negatives.mine(docs.limit(0)).count() == 0
    assert hard_negatives.mine(docs.filter("vec_id % 100 <> 0")).count() == 0
    assert hard_negatives.mine(docs.filter("vec_id = 300")).count() == 0


def test_the_best_rows_survive_a_full_store(monkeypatch):
    monkeypatch.setattr(hard_negatives, "HELD", 20)
    r = np.random.default_rng(0)

    class Windows:
        low, high = np.array([[10, 40], [0, 99]]), np.array([[50, 45], [5, 99]])

    best, seen = hard_negatives.Best(Windows, 3), []
    for _ in range(30):
        a, s, i = r.integers(0, 2, 9), r.integers(0, 100, 9), r.integers(0, 1000, 9)
        best.add(a, s, i, np.zeros(9, bool))
        seen += zip(a.tolist(), s.tolist(), i.tolist(), strict=True)
    for slot, at in best.first():
        got = [(best.a[k], -best.score[k], best.id[k]) for k in at]
        fit = sorted((a, -s, i) for a, s, i in seen if Windows.low[a, slot] <= s <= Windows.high[a, slot])
        assert got == [x for a in (0, 1) for x in [y for y in fit if y[0] == a][:3]]


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in ((2, 3), (3, 2), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(keys)
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    r = np.random.default_rng(1)
    v, q = r.integers(-300, 300, (40, 9)), r.integers(-300, 300, (30, 9))
    least, most = hard_negatives.bounds(v, q.min(axis=0)[None], q.max(axis=0)[None])
    scores = v @ q.T
    assert (scores >= least).all() and (scores <= most).all()
