"""Centroid clustering of integer vectors with a LAESA pivot table.

Lloyd rounds in exact integer arithmetic: components are ``floor(scale * x)``,
distances are squared Euclidean, a centroid moves to the componentwise
``floor(sum / count)`` of its vectors, an empty one stays.

*Pivot table.*  ``PIVOTS`` vectors, fixed for the whole run, are chosen far
apart (greedy max-min) from the ``SAMPLE`` vectors of smallest start hash.
Every vector's distances to them are computed once and stored beside the
vector.  In a round the driver takes the distances of the (few) centroids to
the pivots; by the triangle inequality ``|d(v, p) - d(c, p)|``, at its largest
over the pivots, is a lower bound of ``d(v, c)``.  The centroid of the least
bound gets its exact distance first; only centroids whose bound does not exceed
the best distance found get theirs.  Bounds are lowered by more than their
rounding error, so no centroid that could win or tie is passed over.

A round is one scan of the stored table: each task adds up its vectors per
centroid, and one row per task and centroid is shuffled.  The driver holds
the centroids and the pivots only.  A round that moves no centroid is the last
(all later ones would repeat it).

Defined cases: null vectors, those of another length and those with null or
non-finite components take no part; a null id is hashed as no digits; rows
that repeat an id or a vector are vectors of their own (equal hashes are
ordered by the vector); components are held to +-2**27, so that distances fit
64 bits; sums of distances that do not are null; with fewer vectors than
centroids each starts one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.scratch import stage

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
PIVOTS, SAMPLE = 16, 1000
LIMIT = 1 << 27
#: Lowering of the bounds, relative to the distances they come from; the
#: rounding of a distance and of a difference is about 1e-15.
SLACK = 1e-12


def integers(
    vectors: DataFrame, id_column: str, column: str, dimensions: int = DIMENSIONS, scale: int = SCALE
) -> DataFrame:
    """``vec_id, v``: the rows that take part, components as 32-bit integers."""
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where(
        (F.size("v") == dimensions)
        & F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(scale * x), -LIMIT, LIMIT).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in whole], pa.binary())], names=["vec_id", "v"]
            )

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, v binary")


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` from one vector."""
    d = v.astype(np.int64) - c.astype(np.int64)
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """At most ``count`` distinct vectors, each the farthest from those before."""
    chosen = [0]
    far = squared(sample, sample[0])
    while len(chosen) < count and far.max():
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The table: one row per vector, one distance per pivot."""
    return np.stack([np.sqrt(squared(v, p).astype(np.float64)) for p in pivots], axis=1)


def nearest(v: np.ndarray, table: np.ndarray, c: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its squared distance, exact distances
    taken); of equally near centroids the smaller number."""
    own = to_pivots(c, pivots)
    bound = np.stack([np.abs(table - row).max(axis=1) for row in own], axis=1)
    bound -= SLACK * (table.max(axis=1, keepdims=True) + own.max())
    first = bound.argmin(axis=1)
    best, at, taken = np.empty(len(v), dtype=np.int64), first.copy(), len(v)
    for i in range(len(c)):
        mine = first == i
        best[mine] = squared(v[mine], c[i])
    for i in range(len(c)):
        low = bound[:, i]
        near = np.flatnonzero((first != i) & ((low <= 0) | (low * low <= best * (1 + SLACK))))
        if not len(near):
            continue
        taken += len(near)
        d = squared(v[near], c[i])
        better = (d < best[near]) | ((d == best[near]) & (i < at[near]))
        best[near[better]], at[near[better]] = d[better], i
    return at, best, taken


@dataclass
class Clustering:
    """``rows`` (``vec_id, cluster, distance``) and the final centroids."""

    rows: DataFrame
    centroids: list[list[int]]
    rounds: int
    #: Exact distances taken in the rounds, and those there would be without bounds.
    exact: int
    possible: int


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[list[int], list[list[int]], int]:
    """One round: vectors of each centroid, their component sums, and the
    exact distances taken."""
    shape = (len(centroids), centroids.shape[1] + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per centroid its component sums, its vectors and the distances taken
        total = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), "<i4")
            at, _, exact = nearest(v, _matrix(batch.column(1), "<f8"), centroids, pivots)
            for i in range(len(centroids)):
                total[i, :-2] += v[at == i].sum(axis=0, dtype=np.int64)
            total[:, -2] += np.bincount(at, minlength=len(centroids))
            total[0, -1] += exact
        if total.any():
            cells = [np.repeat(np.arange(shape[0]), shape[1]), np.tile(np.arange(shape[1]), shape[0]), total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["cluster", "item", "total"])

    parts = table.select("v", "d").mapInArrow(run, "cluster long, item long, total long")
    cells = parts.groupBy("cluster", "item").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = [[0] * shape[1] for _ in range(shape[0])]
    for r in cells:
        sums[r["cluster"]][r["item"]] = int(r["total"])
    return [s[-2] for s in sums], [s[:-2] for s in sums], sum(s[-1] for s in sums)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> Clustering:
    """Cluster the vectors; starts are those of smallest SHA-256 of
    ``seed:id``, in the order of these hashes."""
    rows = integers(vectors, id_column, column, dimensions, scale)
    digits = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    start = F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)
    # a bounded sample: the first of them are the starts, the pivots come from all
    head = rows.orderBy(start, "v").limit(max(SAMPLE, clusters)).select("v").collect()
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not head:
        none = vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long")
        return Clustering(none, [], 0, 0, 0)
    sample = np.frombuffer(b"".join(bytes(r["v"]) for r in head), dtype="<i4").reshape(len(head), -1)
    centroids, pivots = sample[:clusters].astype(np.int64), choose_pivots(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = to_pivots(_matrix(batch.column(1), "<i4"), pivots).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r.tobytes() for r in d], pa.binary())], names=["vec_id", "v", "d"]
            )

    table = stage(rows.mapInArrow(measure, f"vec_id {kind}, v binary, d binary"), "pivot_table")
    exact = possible = done = 0
    while done < rounds:
        done += 1
        moved = centroids.copy()
        counts, sums, taken = _sums(table, centroids, pivots)
        exact, possible = exact + taken, possible + sum(counts) * len(centroids)
        for i, n in enumerate(counts):
            if n:
                moved[i] = [x // n for x in sums[i]]
        if (moved == centroids).all():
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, d, _ = nearest(_matrix(batch.column(1), "<i4"), _matrix(batch.column(2), "<f8"), centroids, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"]
            )

    final = stage(table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "clusters")
    return Clustering(final, centroids.tolist(), done, exact, possible)


def report(result: Clustering) -> DataFrame:
    """The rows with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark = result.rows.sparkSession
    sums = result.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in result.centroids]
    fits = lambda n: n if n < 1 << 63 else None
    known = [(r["cluster"], fits(int(r["s"])), fits(total), digest[r["cluster"]]) for r in sums]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return result.rows.join(F.broadcast(spark.createDataFrame(known, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
