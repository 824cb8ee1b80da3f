"""Digest-tree reconciliation against plain counts."""

import random
from collections import Counter

import pytest

from cartwheel import operators as op
from cartwheel.operators import digest


def sides(seed, n=2000, changes=12):
    """Two multisets that differ in a few ids; a third of the rows is one id."""
    r = random.Random(seed)
    source = [f"e{r.randrange(n)}" if i % 3 else "hot" for i in range(n)] + [None] * 5
    sink = list(source)
    for _ in range(changes):
        kind = r.randrange(4)
        if kind == 0:
            sink.pop(r.randrange(len(sink)))
        elif kind == 1:
            sink.append(r.choice(sink))
        elif kind == 2:
            sink.append(f"foreign{r.randrange(5)}")
        else:
            sink.append(None)
    r.shuffle(sink)
    return source, sink


def frame(spark, ids, parts=5):
    return spark.createDataFrame([(i,) for i in ids], "event_id string").repartition(parts)


@pytest.mark.parametrize("seed,bits,levels", [(1, 10, 3), (2, 2, 5), (3, 1, 1), (4, 3, 2)])
def test_equals_counting(spark, seed, bits, levels):
    source, sink = sides(seed)
    a, b = Counter(source), Counter(sink)
    want = {(i, a[i], b[i]) for i in a | b if a[i] != b[i]}
    s, k = frame(spark, source), frame(spark, sink)
    assert {tuple(r) for r in op.id_differences(s, k, bits=bits, levels=levels).collect()} == want
    got = op.reconcile_by_digest(s, k, bits=bits, levels=levels).first()
    assert tuple(got) == tuple(op.reconcile_ids(s, k).first())
    assert tuple(op.reconcile_by_digest(k, s, bits=bits, levels=levels).first()) == tuple(op.reconcile_ids(k, s).first())


def test_equal_sides_and_empty_sides(spark):
    s = frame(spark, ["a", "a", "b", None])
    none = s.limit(0)
    assert digest.suspects(s, s.repartition(2)) is None
    assert op.id_differences(s, s).collect() == []
    assert tuple(op.reconcile_by_digest(s, s).first()) == (0, 0)
    assert tuple(op.reconcile_by_digest(none, none).first()) == (0, 0)
    assert tuple(op.reconcile_by_digest(s, none).first()) == (0, 4)
    assert tuple(op.reconcile_by_digest(none, s).first()) == (3, 0)


def test_only_rows_near_a_difference_are_looked_at(spark):
    ids = spark.range(60_000).selectExpr("id AS event_id")
    sink = ids.where("event_id <> 77")
    rows = digest.suspects(ids, sink, bits=6, levels=3)
    # one bucket of 2**18 differs: the lost id and what shares its bucket
    assert rows.count() <= 9
    assert [tuple(r) for r in op.id_differences(ids, sink, bits=6).collect()] == [(77, 1, 0)]


def test_sides_of_different_types_and_shuffled_buckets(spark, monkeypatch):
    a = spark.range(500).selectExpr("cast(id AS int) AS event_id")
    b = spark.range(3, 503).selectExpr("id AS event_id")
    want = {(i, 1, 0) for i in range(3)} | {(i, 0, 1) for i in range(500, 503)}
    assert {tuple(r) for r in op.id_differences(a, b).collect()} == want
    monkeypatch.setattr(digest, "BROADCAST_BUCKETS", 0)
    assert {tuple(r) for r in op.id_differences(a, b).collect()} == want


def test_equal_sums_are_not_enough(spark):
    # same number of ids on both sides of a bucket, other ids
    s, k = frame(spark, ["a", "b", "b"]), frame(spark, ["a", "a", "b"])
    assert {tuple(r) for r in op.id_differences(s, k, bits=1, levels=1).collect()} == {("a", 1, 2), ("b", 2, 1)}
