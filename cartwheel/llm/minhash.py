"""Near-duplicate documents by circulant MinHash.

*Sets.*  A document's set holds its distinct five-word shingles over
lower-cased (A-Z) words, as 64-bit hashes; with one to four words the whole
sequence is the only shingle; without words (or with null text) the set is
empty and linked with nothing.

*Signatures.*  Two permutations of ``UNIVERSE`` slots make all coordinates
(Li and Li, "C-MinHash"): the first places each shingle, the second, shifted
circularly by ``k``, ranks the slots for coordinate ``k``.  A shingle's ranks
for all ``k`` are one contiguous slice of the second permutation, so a
signature is an elementwise minimum over slices.

*Bands.*  ``BANDS`` bands of ``ROWS`` coordinates.  A pair at the threshold
0.75 meets in a band with probability 1 - (1 - 0.75^5)^51 > 0.999998.

*Groups.*  Documents with equal sets form one class, represented by its
smallest ``doc_id``, before anything is compared.  Classes that meet in a band
are tied to the smallest class of that band (a link per class and band, never
all pairs), and the connected groups of these ties are compared exactly:
within a group every pair of classes is decided by prefix filtering over the
full sets and an exact intersection count, ``100 * |A & B| >= 75 * |A | B|``.
A group larger than ``BLOCK`` classes is cut into blocks and each pair of
blocks is a task of its own, so no group, however large, meets in one task;
each task returns only a spanning forest of its links.  Connected components
of the links give ``component_id``.

Defined cases: rows sharing a ``doc_id`` count as one document with the links
of all its texts; a null ``doc_id`` takes part with its text, is never the
smallest of a class that has another id, and a class of null ids only has a
null ``component_id`` and is kept; an empty table gives an empty result; other columns
are ignored by ``near_duplicates`` and returned unchanged by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.components import connected_components
from cartwheel.llm.scratch import free_names, stage
from cartwheel.llm.words import Words, chunks, mix, shingle_sets, to_bytes

WIDTH, PERCENT = 5, 75
UNIVERSE, ROWS, BANDS, SEED = 1 << 20, 5, 51, 7
#: Classes of a block, and their shingles together.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Up to so many members (16 bytes each) are sent to the scan of the texts;
#: more are joined with a shuffle.
BROADCAST_MEMBERS = 4_000_000
_SLICES = 2048

_rng = np.random.Generator(np.random.PCG64(SEED + 1))
_ROW_MIX = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND_MIX = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_SET_MIX = _rng.integers(1, 1 << 63, 2, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(SEED))
    place = rng.permutation(UNIVERSE).astype(np.uint32)
    rank = rng.permutation(UNIVERSE).astype(np.uint32)
    circle = np.concatenate((rank, rank[: ROWS * BANDS]))
    return place, np.lib.stride_tricks.sliding_window_view(circle, ROWS * BANDS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The ``ROWS * BANDS`` coordinates of a non-empty set of shingle hashes."""
    place, slices = _permutations()
    at = place[shingles & np.uint64(UNIVERSE - 1)]
    low = slices[at[:_SLICES]].min(axis=0)
    for i in range(_SLICES, len(at), _SLICES):
        np.minimum(low, slices[at[i : i + _SLICES]].min(axis=0), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One int64 key per band of each signature row."""
    rows = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix((rows * _ROW_MIX).sum(axis=2, dtype=np.uint64) + _BAND_MIX).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), to_bytes(batch.column(1))
        for lo, hi in chunks(texts):
            sets = shingle_sets(Words(texts[lo:hi]), WIDTH)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((0, BANDS), dtype=np.int64)
            if full:
                keys = band_keys(np.stack([signature(sets[i]) for i in full]))
            counts = np.array([len(s) for s in sets], dtype=np.int64)
            digest = np.zeros((2, len(sets)), dtype=np.uint64)
            for i in full:
                digest[0, i] = mix(sets[i] * _SET_MIX[0]).sum(dtype=np.uint64)
                digest[1, i] = mix(sets[i] ^ _SET_MIX[1]).sum(dtype=np.uint64)
            offsets = np.concatenate(([0], np.cumsum(np.where(counts > 0, BANDS, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, hi - lo).cast(pa.int64()),
                    pa.array(counts),
                    pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


_CLASS = ["n_shingles", "set_a", "set_b"]


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def forest_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of indices that tie every two sets linked with
    ``100 * |A & B| >= percent * |A | B|`` into one tree; empty sets and sets
    already tied by other links give none."""
    n = len(sets)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    _, code, df = np.unique(every, return_inverse=True, return_counts=True)
    by_rarity = np.empty(len(df), dtype=np.int64)
    by_rarity[np.argsort(df, kind="stable")] = np.arange(len(df))
    code = by_rarity[code.ravel()]
    ends = np.cumsum(sizes)
    tokens = [np.sort(code[e - k : e]) for e, k in zip(ends.tolist(), sizes.tolist())]
    # smaller sets first: only the prefix (rarest shingles) of each set is indexed
    order = [int(i) for i in np.argsort(sizes, kind="stable") if sizes[i]]
    postings: dict[int, list[int]] = {}
    mark = np.zeros(len(df), dtype=bool)
    forest, links = _Forest(n), []
    for i in order:
        t = tokens[i]
        k = len(t)
        prefix = t[: k - (percent * k + 99) // 100 + 1].tolist()
        near: set[int] = set()
        for x in prefix:
            near.update(postings.get(x, ()))
        near = [j for j in near if 100 * len(tokens[j]) >= percent * k]
        if near:
            mark[t] = True
            roots: dict[int, list[int]] = {}
            for j in near:
                roots.setdefault(forest.root(j), []).append(j)
            for members in roots.values():  # one link to each tree is enough
                for a in range(0, len(members), 64):
                    part = members[a : a + 64]
                    m = np.array([len(tokens[j]) for j in part])
                    at = np.concatenate(([0], np.cumsum(m)[:-1]))
                    both = np.add.reduceat(mark[np.concatenate([tokens[j] for j in part])], at, dtype=np.int64)
                    hit = np.flatnonzero(100 * both >= percent * (m + k - both))
                    if len(hit):
                        j = part[int(hit[0])]
                        if forest.join(i, j):
                            links.append((i, j))
                        break
            mark[t] = False
        for x in prefix:
            postings.setdefault(x, []).append(i)
    return links


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, text, group = batch.column(0), to_bytes(batch.column(1)), batch.column(2)
        for lo, hi in chunks(text):
            sets = shingle_sets(Words(text[lo:hi]), WIDTH)
            yield pa.RecordBatch.from_arrays(
                [
                    node.slice(lo, hi - lo),
                    group.slice(lo, hi - lo),
                    pa.array([s.tobytes() for s in sets], type=pa.binary()),
                ],
                names=["node", "cluster", "shingles"],
            )


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    found: list[tuple[int, int]] = []
    for _, part in pdf.groupby("cluster", sort=True):
        nodes = part["node"].tolist()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in part["shingles"]]
        found += [(nodes[i], nodes[j]) for i, j in forest_links(sets)]
    return pd.DataFrame(found, columns=["u", "v"], dtype="int64")


def _links(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links ``(u, v)`` between classes of the same cluster."""
    if members.count() <= BROADCAST_MEMBERS:
        members = F.broadcast(members)
    sets = stage(
        docs.join(members, docs["_id"] == members["node"]).select("node", "_text", "cluster").mapInArrow(
            _full_sets, "node long, cluster long, shingles binary"
        ),
        "minhash_sets",
    )
    size = sets.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.length("shingles") / 8).alias("s"))
    blocks = size.where("n > 1").select(
        "cluster", "n", "s", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("s") / BLOCK_SHINGLES)).alias("blocks")
    )
    # as many lots as the small clusters need by texts and by shingles
    n, s = blocks.where("blocks = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("s"), F.lit(0))).first()
    lots = max(1, -(-int(n) // BLOCK), -(-int(s) // BLOCK_SHINGLES))
    dealt = sets.join(blocks.drop("s"), "cluster").withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    )
    # a small cluster goes to a lot with others; block pairs get a key each
    lot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(lots))).otherwise(F.col("cluster"))
    dealt = (
        dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .withColumn("lot", lot)
        .withColumn("whole", F.col("blocks") == 1)
    )
    return (
        dealt.select("lot", "whole", "low", "high", "cluster", "node", "shingles")
        .groupBy("lot", "whole", "low", "high")
        .applyInPandas(_compare, "u long, v long")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    source = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    sketch = stage(
        source.mapInArrow(
            _sketch, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
        ),
        "minhash_sketch",
    )
    classes = stage(
        sketch.where("n_shingles > 0")
        .groupBy(*_CLASS)
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
        .where(F.col("node").isNotNull()),
        "minhash_classes",
    )
    at = classes.select("node", F.explode("bands").alias("band"))
    hubs = at.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("last > hub")
    ties = at.join(hubs.select("band", "hub"), "band").where("node <> hub").select(
        F.col("node").alias("u"), F.col("hub").alias("v")
    )
    members = stage(
        connected_components(ties, "minhash_ties").withColumnRenamed("component", "cluster"), "minhash_members"
    )
    component = connected_components(_links(members, source), "minhash_links")
    root = classes.select(*_CLASS, "node").join(component, "node", "left").select(
        *_CLASS, F.coalesce("component", "node").alias("root")
    )
    # rows that share an id follow the smallest root of their texts
    return (
        sketch.select("doc_id", *_CLASS)
        .join(root, _CLASS, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("root", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one per group, with all columns.
    Repeated rows of the id that stays are one document; rows with a null id
    stay unless a row with an id has a linked text."""
    found = near_duplicates(docs, id_column, text_column)
    key, gone, rows = free_names(docs, "_odd", "_gone", "_rows")
    odd = (
        found.groupBy(F.col("doc_id").alias(key))
        .agg(F.max(~F.col("kept")).alias(gone), F.count("*").alias(rows))
        .where(F.col(gone) | (F.col(rows) > 1))
    )
    judged = docs.join(odd, F.col(id_column).cast("long").eqNullSafe(F.col(key)), "left").where(
        F.col(gone).isNull() | ~F.col(gone)
    )
    once = judged.where(F.col(rows).isNull()).select(docs.columns)
    return once.unionAll(judged.where(F.col(rows).isNotNull()).select(docs.columns).dropDuplicates())
