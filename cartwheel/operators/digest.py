"""JN3 / JN4 / AG11 by a digest tree: compare two multisets of ids by what differs.

Ids are dealt into buckets by a hash.  Per bucket the ids of the source, less
those of the sink, are summed up: their number and the sums of two further
64-bit hashes.  All three are 0 where both sides hold the same ids equally
often (else with a chance of about 2**-128).  Only buckets that differ are
looked into, by the next ``BITS`` of the hash, and only the ids of the last
level's differing buckets are counted one by one.

A level is a scan of the ids and one aggregation with partial sums: a task sends
at most one row per bucket it meets, however many rows or copies it reads.
The ids that are shuffled themselves are those of differing buckets, so their
number follows the difference and not the input.  Write the ids to a table
first: every level reads them again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the hash a level adds, and levels at most: 2**30 buckets in the end.
BITS, LEVELS = 10, 3
#: Differing buckets up to this number are broadcast (8 bytes each).
BROADCAST_BUCKETS = 2_000_000


def _signed(source_ids: DataFrame, sink_ids: DataFrame, key: str) -> DataFrame:
    """``event_id, _side`` (1 source, -1 sink) and the hash that deals ids out."""
    side = lambda df, n: df.select(F.col(key).alias("event_id"), F.lit(n).alias("_side"))
    both = side(source_ids, 1).unionByName(side(sink_ids, -1))  # one type on both sides
    return both.withColumn("_hash", F.xxhash64("event_id"))


def _bucket(level: int, bits: int) -> Column:
    return F.col("_hash").bitwiseAND(F.lit((1 << bits * level) - 1))


def bucket_digests(both: DataFrame, level: int, bits: int = BITS) -> DataFrame:
    """``_bucket, n, s1, s2``: number and hash sums, source less sink."""
    part = lambda i: F.sum((F.xxhash64(F.lit(i), "event_id").cast("decimal(38,0)")) * F.col("_side"))
    return both.groupBy(_bucket(level, bits).alias("_bucket")).agg(
        F.sum("_side").alias("n"), part(1).alias("s1"), part(2).alias("s2")
    )


def suspects(
    source_ids: DataFrame, sink_ids: DataFrame, key: str = "event_id", bits: int = BITS, levels: int = LEVELS
) -> DataFrame | None:
    """``event_id, _side`` of the rows in differing buckets of the last level
    (None if no bucket differs).

    Stops early where the difference is so large that most buckets differ:
    looking closer would only read the ids once more."""
    both = _signed(source_ids, sink_ids, key)
    for level in range(1, levels + 1):
        differ = bucket_digests(both, level, bits).where("n <> 0 or s1 <> 0 or s2 <> 0").select("_bucket")
        # at most one row per bucket; the blocks are recomputed if an executor is lost
        differ = differ.persist(StorageLevel.MEMORY_AND_DISK)
        found = differ.count()
        if not found:
            differ.unpersist()
            return None
        if found <= BROADCAST_BUCKETS:
            differ = F.broadcast(differ)
        both = both.withColumn("_bucket", _bucket(level, bits)).join(differ, "_bucket", "left_semi").drop("_bucket")
        if 2 * found > 1 << bits * level:
            break
    return both.select("event_id", "_side")


def id_differences(
    source_ids: DataFrame, sink_ids: DataFrame, key: str = "event_id", bits: int = BITS, levels: int = LEVELS
) -> DataFrame:
    """``event_id, source_n, sink_n`` of every id that the sides hold
    differently often.  NULL is an id like any other."""
    rows = suspects(source_ids, sink_ids, key, bits, levels)
    if rows is None:
        rows = _signed(source_ids, sink_ids, key).select("event_id", "_side").limit(0)
    of = lambda n: F.count_if(F.col("_side") == n)
    counts = rows.groupBy("event_id").agg(of(1).alias("source_n"), of(-1).alias("sink_n"))
    return counts.where("source_n <> sink_n")


def reconcile_by_digest(
    source_ids: DataFrame, sink_ids: DataFrame, key: str = "event_id", bits: int = BITS, levels: int = LEVELS
) -> DataFrame:
    """The row of ``reconcile_ids`` (``foreign_ids, missing_rows``) from the
    differing ids alone: equal counts add to neither."""
    d = id_differences(source_ids, sink_ids, key, bits, levels)
    lost = F.sum(F.greatest(F.lit(0), F.col("source_n") - F.col("sink_n")))
    return d.agg(
        F.count_if(F.col("source_n") == 0).alias("foreign_ids"),
        F.coalesce(lost, F.lit(0)).cast("bigint").alias("missing_rows"),
    )
