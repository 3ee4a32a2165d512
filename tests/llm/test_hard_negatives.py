import math
import random

import numpy as np
import pytest

from hearth.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score string, q int"


def brute(rows):
    """rows: (id, vector, label)."""
    v = []
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * c) for c in x]))

    def score(a, b):
        return max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(p * q for p, q in zip(a[2], b[2]))))

    out = []
    for a in v:
        if a[0] % 100:
            continue
        scored = sorted(((-score(a, b), b[0], b[1]) for b in v if b[0] != a[0]))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:5]:
            s = -s
            fit = [(i, -n) for n, i, label in scored if label != a[1] and 30 * s <= -100 * n <= 90 * s][:10]
            out += [(a[0], p, k, i, s, n) for k, (i, n) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, H.mine(df, **more).collect()))


def vectors(rnd, n, dims, clusters, copies=0):
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = []
    for _ in range(n):
        c = rnd.choice(centres)
        rows.append([x + rnd.gauss(0, 0.2) for x in c])
    return rows + [rows[0]] * copies


@pytest.mark.parametrize("dims,clusters,copies,block", [(8, 5, 0, 1 << 15), (4, 2, 300, 3), (16, 40, 50, 1 << 15)])
def test_equals_brute_force(spark, monkeypatch, dims, clusters, copies, block):
    monkeypatch.setattr(H, "WINDOW", 20)
    rnd = random.Random(dims)
    x = vectors(rnd, 700, dims, clusters, copies)
    rows = [(i, v, rnd.randint(0, 9) if i % 3 else 4) for i, v in enumerate(x)]
    rnd.shuffle(rows)
    want = brute(rows)
    assert want and mined(spark, rows, block_anchors=block) == want


def test_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, v, i % 4) for i, v in enumerate(vectors(rnd, 250, 6, 3))]
    rows += [(None, [1.0] * 6, 1), (300, None, 1), (301, [1.0] * 6, None), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (303, [math.nan] * 6, 1),
             (304, [math.inf] * 6, 2), (400, [0.0] * 6, 2), (401, [], 3), (402, [1.0, 2.0], 3), (-100, [0.5] * 6, 3), (403, [1e30] * 6, 2), (500, [1e30] * 6, 2)]
    rows += [rows[5]] * 3 + [rows[100]] * 2
    rnd.shuffle(rows)
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, [r for r in rows if r[0] is None]) == []
    assert mined(spark, [(100, [1.0, 2.0], 1)]) == []


def test_bounds_hold_and_skip(spark):
    rnd = np.random.default_rng(4)
    q = np.floor(256 * (rnd.normal(size=(40, 12)) * rnd.choice([0.01, 1, 9], (40, 1)))).astype(np.int64)
    q[3] = 0
    directions = H.angles_to(q[:1], np.eye(1, 12)) and (q[:6] / np.maximum(np.linalg.norm(q[:6], axis=1), 1)[:, None])[[0, 1, 2, 4, 5]]
    norms, angles = H.angles_to(q, directions)
    scores = H.inner(q, q)
    for a in range(0, 40, 4):
        low, high = H.score_bounds(norms, angles, norms[a:a + 4], angles[a:a + 4])
        assert (low[:, None] <= scores[:, a:a + 4]).all() and (scores[:, a:a + 4] <= high[:, None]).all()
    near = np.floor(256 * (np.ones((30, 12)) + rnd.normal(size=(30, 12)) * 0.01)).astype(np.int64)
    d = np.ones((1, 12)) / math.sqrt(12)
    n, a = H.angles_to(near, d)
    m, b = H.angles_to(-near, d)
    assert (H.score_bounds(n, a, m, b)[1] < 0).all()        # opposite windows are never scored
