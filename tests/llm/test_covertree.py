import math
import random

import numpy as np
from lawloom.llm import covertree


def brute(rows, k, every, scale=1024):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        best = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q)))[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    return sorted(tuple(r) for r in covertree.top_k(df, **more).collect())


def test_equals_brute_force(spark):
    r = random.Random(1)
    half = lambda: r.randint(-8, 8) / 8
    rows = [(i, [half() for _ in range(5)]) for i in range(400)]
    rows += [(400 + i, [1.0] * 5) for i in range(120)]  # many equal vectors: ties go to smaller ids
    rows += [(600, None), (601, [float("nan")] * 5), (602, [1.0, None, 1.0, 1.0, 1.0]), (603, [float("inf")] * 5), (None, [1.0] * 5), (700, [0.5, 0.25]), (701, [0.5, 0.5]), (800, []), (801, [])]
    assert run(spark, rows, k=7, every=20, block=64) == brute(rows, 7, 20)
    assert run(spark, rows, k=7, every=100, block=64, round_size=15) == brute(rows, 7, 100)


def test_few_rows_repeats_and_large_values(spark):
    rows = [(0, [1.0, 2.0]), (1, [3e9, 1e9]), (1, [3e9, 1e9]), (2, [-3e9, 2e9]), (100, [1e9, 1e9]), (100, [1e9, 1e9])]
    want = [x if abs(x[3]) < 2**63 else (*x[:3], (2**63 - 1) * (1 if x[3] > 0 else -1)) for x in brute(rows, 10, 100)]
    assert run(spark, rows) == want
    assert run(spark, []) == []


def test_tree_covers_and_separates():
    x = np.concatenate([np.random.RandomState(0).normal(c, 0.1, (300, 3)) for c in (0, 5, 20)])
    t = covertree.Tree(x, 16).seal(np.arange(len(x)))
    for n, (a, b) in enumerate(t.span):
        d = np.linalg.norm(t.x[t.order[a:b]] - t.x[t.point[n]], axis=1)
        assert d.max() <= t.radius[n] + 1e-9
    assert sorted(t.order) == list(range(len(x)))
