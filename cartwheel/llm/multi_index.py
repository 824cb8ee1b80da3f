"""Nearest neighbours by largest inner product through an inverted multi-index.

*Index.*  Vectors are split into two halves, each quantised with its own
codebook of ``CENTROIDS`` centroids (k-means in numpy on at most ``SAMPLE``
vectors, chosen by a hash of the vector).  A vector's cell is its pair of
centroids; every vector is indexed.

*Traversal.*  A query sorts both codebooks by inner product with its halves.
Centroid pairs are visited by falling sum with a heap (the multi-sequence
walk of Babenko and Lempitsky), until the visited cells hold ``SHARE`` of all
vectors, at least ``MIN_CANDIDATES``.

*Rerank.*  Cells are dealt out in blocks of about ``BLOCK`` vectors and queries
in chunks of ``QUERY_CHUNK``; each pair of block and chunk is one task that
takes the exact inner products (double precision) of the chunk's queries with
the entries of the cells they visited and returns the best of each query.

Equal vectors are one entry with its ``count + 1`` smallest ids, which is all a
result can need, so a vector shared by a third of the rows costs one row per
partition.  A first centroid with more than a block of entries is cut into
several blocks.

Defined cases: null or zero vectors, and those with null or non-finite
components, take no part; so do null ids and vectors whose length is not the
most common one (the smaller of equals).  Rows that repeat an id are one
vector each but the id is listed once, with its best score, and as a query it
has its smallest vector.  With fewer candidates than asked for, all are
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.scratch import stage

CENTROIDS, SAMPLE, ROUNDS, SEED = 64, 20_000, 12, 3
SHARE, MIN_CANDIDATES = 0.5, 2000
BLOCK, QUERY_CHUNK = 4096, 1024

TYPE = np.dtype("<f8")


def valid(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, v`` (array of double) of the rows that take part."""
    v = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
        & F.expr("exists(v, x -> x <> 0)")
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(TYPE)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _from_bytes(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=TYPE).reshape(len(rows), -1)


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """``vector`` (bytes) and its ``ids`` smallest ids, ascending."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held: dict[bytes, list[int]] = {}
            x = _matrix(batch.column(1))
            for i, row in zip(batch.column(0).to_pylist(), x):
                held.setdefault(row.tobytes(), []).append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.binary()),
                    pa.array([sorted(set(v))[:ids] for v in held.values()], pa.list_(pa.int64())),
                ],
                names=["vector", "ids"],
            )

    return (
        rows.mapInArrow(collapse, "vector binary, ids array<long>")
        .groupBy("vector")
        .agg(F.collect_list("ids").alias("lists"))  # one short list per batch
        .select("vector", F.expr(f"slice(array_sort(array_distinct(flatten(lists))), 1, {ids})").alias("ids"))
    )


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        empty = n == 0
        c = sums / np.maximum(n, 1)[:, None]
        c[empty] = x[rng.choice(len(x), int(empty.sum()))]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)


class Codebooks:
    """The centroids of both halves."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS):
        self.half = sample.shape[1] // 2
        # small tables get fewer, so that cells are not mostly empty
        k = max(1, min(centroids, int(np.sqrt(len(sample) / 2)) or 1))
        self.first = kmeans(sample[:, : self.half], k) if self.half else np.zeros((1, 0))
        self.second = kmeans(sample[:, self.half :], k)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.first), nearest(x[:, self.half :], self.second)

    def visit(self, q: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
        """Cells (as a mask, first by second centroid) in the order of falling
        summed inner product until they hold ``most`` vectors."""
        a, b = self.first @ q[: self.half], self.second @ q[self.half :]
        u, v = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[u].tolist(), b[v].tolist()
        held = counts[np.ix_(u, v)].tolist()
        mask = np.zeros((len(a), len(b)), dtype=bool)
        # row i has been visited up to column reached[i]; the heap holds each
        # row's next column, and row i + 1 opens when row i is first visited
        heap, found = [(-(a[0] + b[0]), 0, 0)], 0
        reached = [0] * len(a)
        last = len(b) - 1
        while heap and found < most:
            _, i, j = heap[0]
            found += held[i][j]
            reached[i] = j + 1
            if j < last:
                heapq.heapreplace(heap, (-(a[i] + b[j + 1]), i, j + 1))
            else:
                heapq.heappop(heap)
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        for i, n in enumerate(reached):
            mask[u[i], v[:n]] = True
        return mask


class Blocks:
    """Which block holds an entry: consecutive first centroids share a block
    of about ``BLOCK`` entries; a larger one is cut by a hash."""

    def __init__(self, counts: np.ndarray, block: int = BLOCK):
        self.first, self.cut, self.members = [], [], []
        held = 0
        for u, n in enumerate(counts.sum(axis=1).tolist()):
            cut = max(1, -(-n // block))
            if cut > 1 or held + n > block or not self.members:
                self.members.append([])
                held = 0
            self.first.append(len(self.members) - 1)
            self.cut.append(cut)
            self.members[-1].append(u)
            for _ in range(cut - 1):
                self.members.append([u])
            held = block if cut > 1 else held + n
        self.first, self.cut = np.array(self.first), np.array(self.cut)

    def of(self, u: np.ndarray, spread: np.ndarray) -> np.ndarray:
        return self.first[u] + spread % self.cut[u]


def _best(scores: np.ndarray, ids: list[list[int]], own: int, count: int) -> list[tuple[float, int]]:
    """(score, id) of the best entries, ties to the smaller id."""
    live = np.flatnonzero(scores > -np.inf)
    if len(live) > count + 1:
        s = scores[live]
        # the own entry may be among them; ties at the end stay in
        live = live[s >= np.partition(s, len(s) - count - 1)[len(s) - count - 1]]
    rows = sorted((-float(scores[e]), i) for e in live.tolist() for i in ids[e] if i != own)
    out, seen = [], set()
    for s, i in rows:
        if i not in seen:
            seen.add(i)
            out.append((-s, i))
            if len(out) == count:
                break
    return out


def search(
    vectors: DataFrame,
    queries: DataFrame,
    count: int = 20,
    share: float = SHARE,
    centroids: int = CENTROIDS,
    block: int = BLOCK,
    query_chunk: int = QUERY_CHUNK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest of each query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; a query
    never finds rows of its own id."""
    spark = vectors.sparkSession
    rows = valid(vectors)
    entries = stage(distinct_vectors(rows, count + 1), "imi_entries")
    asked = valid(queries).groupBy("id").agg(F.min("v").alias("v"))
    sample = [
        bytes(r["vector"])
        for r in entries.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(SAMPLE).collect()
    ]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = spark.sparkContext.broadcast(Codebooks(_from_bytes(sample), centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                u, v = books.value.cells(_from_bytes(batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64))],
                    names=["vector", "ids", "u", "v"],
                )

    coded = stage(entries.mapInArrow(assign, "vector binary, ids array<long>, u long, v long"), "imi_index")
    counts = np.zeros((len(books.value.first), len(books.value.second)), dtype=np.int64)
    for r in coded.groupBy("u", "v").count().collect():  # at most centroids ** 2 rows
        counts[r["u"], r["v"]] = r["count"]
    blocks = Blocks(counts, block)
    plan = spark.sparkContext.broadcast((counts, blocks))
    most = max(MIN_CANDIDATES, int(np.ceil(share * counts.sum())))
    lots = max(1, -(-asked.count() // query_chunk))
    wide = counts.shape[1]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, deal = plan.value
        for batch in batches:
            out: list[tuple] = []
            x = _matrix(batch.column(1)) if batch.num_rows else []
            for i, q in zip(batch.column(0).to_pylist(), x):
                mask = books.value.visit(q, held, most)
                for b, members in enumerate(deal.members):
                    part = mask[members]
                    if part.any():
                        out.append((b, hash(i) % lots, i, q.tobytes(), np.packbits(part).tobytes()))
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names=["block", "lot", "query_id", "vector", "cells"]
            )

    def deal_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = plan.value[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            u = batch.column(2).to_numpy()
            spread = np.array([x[0] for x in batch.column(1).to_pylist()], dtype=np.int64)
            b = deal.of(u, spread)
            place = np.array([deal.members[k].index(w) for k, w in zip(b.tolist(), u.tolist())], dtype=np.int64)
            cell = place * wide + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.astype(np.int64)), pa.array(cell), batch.column(0), batch.column(1)],
                names=["block", "cell", "vector", "ids"],
            )

    def rerank(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(asked) and len(held):
            e = _from_bytes(list(held["vector"]))
            cell = held["cell"].to_numpy()
            ids = [list(x) for x in held["ids"]]
            for lo in range(0, len(asked), 64):
                part = asked.iloc[lo : lo + 64]
                scores = _from_bytes(list(part["vector"])) @ e.T
                masks = np.unpackbits(
                    np.frombuffer(b"".join(part["cells"]), dtype=np.uint8).reshape(len(part), -1), axis=1
                )
                scores[masks[:, cell] == 0] = -np.inf
                for q, row in zip(part["query_id"], scores):
                    out += [(q, i, s) for s, i in _best(row, ids, q, count)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    # the walk is all computation: spread by queries, not by their few bytes
    probes = asked.repartition(4 * lots, "id").mapInArrow(probe, "block long, lot long, query_id long, vector binary, cells binary")
    spread = coded.mapInArrow(deal_out, "block long, cell long, vector binary, ids array<long>").withColumn(
        "lot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long")))
    )
    found = (
        probes.groupBy("block", "lot")
        .cogroup(spread.groupBy("block", "lot"))
        .applyInPandas(rerank, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
