import heapq

import numpy as np
import pytest

from cartwheel.llm import multi_index as m

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(x, ids, queries, count):
    out = []
    for q in queries:
        own = x[ids.index(q)]
        rows = sorted((-float(np.dot(own, v)), i) for i, v in zip(ids, x) if i != q)[:count]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(rows)]
    return out


def vectors(n, d=16, seed=1):
    rng = np.random.Generator(np.random.PCG64(seed))
    centers = rng.standard_normal((6, d))
    x = centers[rng.integers(0, 6, n)] + 0.7 * rng.standard_normal((n, d))
    return (x * rng.uniform(0.5, 2, (n, 1))).astype(np.float32)


def test_walk_visits_cells_by_falling_sum():
    rng = np.random.Generator(np.random.PCG64(2))
    books = m.Codebooks(rng.standard_normal((400, 8)), 9)
    q = rng.standard_normal(8)
    k = len(books.first)
    counts = rng.integers(0, 5, (k, k))
    a, b = books.first @ q[:4], books.second @ q[4:]
    cells = sorted(((-(a[i] + b[j]), i, j) for i in range(k) for j in range(k)))
    heapq.heapify(cells)
    for most in (1, 20, 100, int(counts.sum()), 10**9):
        want, found = set(), 0
        for _, i, j in sorted(cells):
            if found >= most:
                break
            want.add((i, j))
            found += counts[i, j]
        mask = books.visit(q, counts, most)
        assert {(int(i), int(j)) for i, j in zip(*np.nonzero(mask))} == want


def test_exact_when_all_cells_are_visited(spark):
    x = vectors(400)
    ids = list(range(400))
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, x)], SCHEMA)
    got = m.search(df, df.where("vec_id % 20 = 0"), count=7, block=64, query_chunk=6).collect()
    want = brute(x.astype(float), ids, range(0, 400, 20), 7)
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [w[:3] for w in sorted(want)]
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in sorted(want)], rtol=1e-12)


def test_recall(spark):
    x = vectors(6000, 32, 5)
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], SCHEMA).repartition(8)
    got = m.search(df, df.where("vec_id % 100 = 0")).collect()
    want = {w[:1] + w[2:3] for w in brute(x.astype(float), list(range(6000)), range(0, 6000, 100), 20)}
    assert len({(r.query_id, r.vec_id) for r in got} & want) / len(want) >= 0.9


def test_repeats_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "x") for i in range(100, 160)]  # one vector for all
    rows += [(20, [1.0, 1.0], "x"), (20, [1.0, 1.0], "x"), (40, [0.0, 0.0], "x"), (60, None, "x"), (80, [nan, 1.0], "x")]
    rows += [(1, [inf, 0.0], "x"), (2, [None, 1.0], "x"), (3, [1.0, 2.0, 3.0], "x"), (None, [9.0, 9.0], "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in m.search(df, df.where("vec_id % 20 = 0"), count=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {20, 100, 120, 140}
    assert sorted(got[20]) == [(k + 1, 100 + k, 3.0) for k in range(5)]
    assert sorted(got[100]) == [(k, 100 + k, 5.0) for k in range(1, 6)]
    assert sorted(got[120]) == [(k + 1, 100 + k, 5.0) for k in range(5)]


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 0.5], "x")], [(20, [1.0], "x"), (21, [2.0], "x")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = m.search(df, df.where("vec_id % 20 = 0")).collect()
    assert [tuple(r) for r in got] == ([(20, 1, 21, 2.0)] if len(rows) == 2 else [])


def test_blocks_hold_every_entry_once():
    counts = np.array([[5, 0], [100, 3], [0, 0], [2, 2]])
    deal = m.Blocks(counts, 30)
    u = np.repeat(np.arange(4), counts.sum(axis=1))
    b = deal.of(u, np.arange(len(u)))
    assert all(w in deal.members[k] for w, k in zip(u.tolist(), b.tolist()))
    assert len(set(b[u == 1].tolist())) == 4
