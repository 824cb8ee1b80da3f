"""Connected components of a link table, as Spark joins and aggregations.

Alternates two steps until nothing changes: every node's larger neighbours
are tied to its smallest neighbour, then its smaller ones are (the star
contraction of Kiveris et al., "Connected Components in MapReduce and
Beyond").  The tables stay linear in the number of links, the number of rounds
is logarithmic, and hot nodes are only ever aggregated with ``min`` and joined
(skewed partitions of the join are split by AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import remove_dir
from cartwheel.llm.scratch import stage_at


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of undirected ``edges(u, v)`` with u > v."""
    if large:  # neighbours on both sides; tie the larger ones to the minimum
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # the larger neighbours of u are the rows (w, u) with w > u
        out = edges.join(low.withColumnRenamed("u", "v"), "v").select(F.col("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        tied = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = tied.union(low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first()
    return tuple(r)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)`` (longs, any
    direction, repeats allowed); ``component`` is the smallest reachable node.
    Without links the result is empty."""
    e, path = stage_at(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        name,
    )
    state = _state(e)
    while state[0]:
        old = path
        e, path = stage_at(_star(_star(e, large=True), large=False), name)
        remove_dir(e.sparkSession, old)  # the new table no longer reads it
        now = _state(e)
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
