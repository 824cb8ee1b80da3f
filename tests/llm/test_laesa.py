import hashlib
import random

import numpy as np
import pytest

from cartwheel.llm import laesa

SCHEMA = "vec_id long, embedding array<double>, v string, cluster int, d binary"


def make(spark, rows):
    return spark.createDataFrame([(i, x, "x", 9, b"y") for i, x in rows], SCHEMA)


def brute(rows, k, rounds, dim, scale=1024, seed=3):
    import math

    kept = [
        (i, [min(max(math.floor(scale * c), -laesa.LIMIT), laesa.LIMIT) for c in x])
        for i, x in rows
        if x is not None and len(x) == dim and all(c is not None and math.isfinite(c) for c in x)
    ]
    start = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (start(r[0]), np.array(r[1], dtype="<i4").tobytes()))
    cents = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = [[] for _ in cents]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, cents)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    per = [sum(d for _, j, d in out if j == c) for c in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, j, d, per[j], sum(per), sha[j]) for i, j, d in out], cents


def vectors(n, dim, seed, centers=None):
    r = np.random.Generator(np.random.PCG64(seed))
    mid = r.standard_normal((centers or 1, dim)) * (4 if centers else 0)
    return [(int(i), (mid[i % len(mid)] + 0.3 * r.standard_normal(dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("centers", [None, 5])
def test_equals_plain_rounds(spark, centers):
    rows = vectors(300, 6, 1, centers)
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])] + [(1000 + i, rows[0][1]) for i in range(100)]
    result = laesa.cluster(make(spark, rows), dimensions=6)
    want, cents = brute(rows, 8, 10, 6)
    assert result.centroids == cents
    got = [tuple(r) for r in laesa.report(result).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if centers:  # bounds spare most distances where there is structure
        assert result.exact < 0.6 * result.possible


def test_ties_go_to_the_smaller_number():
    v = np.array([[0, 0], [2, 0], [1, 0], [1, 5]], dtype=np.int32)
    c = np.array([[2, 0], [0, 0], [0, 0]])
    p = laesa.choose_pivots(v, 3)
    at, d, _ = laesa.nearest(v, laesa.to_pivots(v, p), c, p)
    assert at.tolist() == [1, 0, 0, 0] and d.tolist() == [0, 0, 1, 26]


def test_bounds_lose_no_centroid():
    r = random.Random(5)
    for _ in range(200):
        n, dim, top = r.randrange(1, 40), r.randrange(1, 4), r.choice([2, 5, 1000, laesa.LIMIT])
        v = np.array([[r.randint(-top, top) for _ in range(dim)] for _ in range(n)], dtype=np.int32)
        c = np.array([[r.randint(-top, top) for _ in range(dim)] for _ in range(r.randrange(1, 9))])
        p = laesa.choose_pivots(v, r.randrange(1, 6))
        at, d, taken = laesa.nearest(v, laesa.to_pivots(v, p), c, p)
        full = ((v[:, None].astype(object) - c[None]) ** 2).sum(axis=2)
        assert d.tolist() == [min(row) for row in full.tolist()]
        assert at.tolist() == [row.index(min(row)) for row in full.tolist()]
        assert n <= taken <= n * len(c)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0])]
    rows = odd + [(8, [1e300, -1e300]), (9, [-0.0005, 0.0005])]
    result = laesa.cluster(make(spark, rows), dimensions=2)
    got = laesa.report(result).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 8, 10, 2)[0])
    assert {r.vec_id for r in got} == {7, 8, 9}
    for none in ([], odd[:6]):
        empty = laesa.report(laesa.cluster(make(spark, none), dimensions=2))
        assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_float_components(spark):
    rows = vectors(60, 64, 3)
    single = [(i, np.array(x, dtype=np.float32).astype(float).tolist()) for i, x in rows]
    df = spark.createDataFrame(single, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in laesa.report(laesa.cluster(df)).collect()]
    assert sorted(got) == sorted(brute(single, 8, 10, 64)[0])
