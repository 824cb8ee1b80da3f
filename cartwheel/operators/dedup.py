"""AG1 / AG2: de-duplicate events by id and report what was removed.

Two ways to the same rows.  ``dedup_events`` and ``dedup_events_counted`` are
one aggregation over whole rows and work on any frame.  For rows that are
written anyhow, ``with_places`` numbers them as they are written and
``mark_repeats`` then needs their ids only: whole rows are neither shuffled
nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.schema import CORRUPT_COLUMN

SLOT, PLACE = "_slot", "_place"


def dedup_events(
    df: DataFrame, key: str | Sequence[str] = "event_id", prefer: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per ``key`` (a column or several); all NULL keys collapse
    into one row.

    Without ``prefer`` any survivor is kept (right for byte-identical
    repeats).  With ``prefer`` the row with the smallest ``prefer`` tuple
    wins, deterministically.  Both forms are aggregations with a map-side
    partial step, so a key repeated a billion times is collapsed inside each
    task before the shuffle.  Columns keep their order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not prefer:
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*others), F.struct(*[F.col(c) for c in prefer]))
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def dedup_stats(raw: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: ``rows_read``, ``rows_after``, ``duplicates_removed``, ``corrupt``.

    ``rows_after`` equals ``dedup_events(raw).count()``: distinct non-NULL
    keys plus one when any key is NULL (malformed lines have NULL ids and so
    collapse into one).  A single job; the distinct count is partially
    aggregated per task before its shuffle.
    """
    corrupt = (
        F.count(F.col(CORRUPT_COLUMN)) if CORRUPT_COLUMN in raw.columns else F.lit(0).cast("bigint")
    )
    stats = raw.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_distinct(F.col(key)).alias("_distinct"),
        F.max(F.col(key).isNull().cast("int")).alias("_has_null"),
        corrupt.alias("corrupt"),
    )
    after = (F.col("_distinct") + F.coalesce(F.col("_has_null"), F.lit(0))).cast("bigint")
    return stats.select(
        "rows_read",
        after.alias("rows_after"),
        (F.col("rows_read") - after).alias("duplicates_removed"),
        "corrupt",
    )


def dedup_events_counted(raw: DataFrame, key: str = "event_id") -> DataFrame:
    """``dedup_events`` that also keeps, per surviving row, how many raw rows
    it stands for (``_copies``) and how many of them were malformed
    (``_corrupt``).  The batch job gets the de-dup statistics from the same
    single pass over the raw files (``counted_stats``)."""
    has_corrupt = CORRUPT_COLUMN in raw.columns
    others = [c for c in raw.columns if c not in (key, CORRUPT_COLUMN)]
    corrupt = F.count(F.col(CORRUPT_COLUMN)) if has_corrupt else F.lit(0).cast("bigint")
    return raw.groupBy(key).agg(
        *[F.first(c).alias(c) for c in others],
        F.count(F.lit(1)).alias("_copies"),
        corrupt.alias("_corrupt"),
    )


def counted_stats(counted: DataFrame) -> DataFrame:
    """``dedup_stats`` from the output of ``dedup_events_counted``."""
    return counted.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows_read"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum("_copies") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicates_removed"),
        F.coalesce(F.sum("_corrupt"), F.lit(0)).cast("bigint").alias("corrupt"),
    )


def with_places(df: DataFrame) -> DataFrame:
    """Add ``_slot`` (the number of the task that writes the row) and
    ``_place`` (a number of the row's own that grows in reading order).  They
    hold once the rows are written; read them from there."""
    return df.withColumns({SLOT: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()})


def repeated_hashes(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """``_hash`` of the keys that occur more than once (and, rarely, of keys
    that share a hash): a hash aggregation of two numbers a row, with a partial
    step in each task, so a hot key is one row per task."""
    counts = rows.groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 1").select("_hash")


def mark_repeats(rows: DataFrame, hashes: DataFrame, key: str = "event_id", corrupt: str = "_corrupt") -> DataFrame:
    """``_slot, _place, _copies, _corrupt`` for every row of a repeated key.

    The first place of a key keeps its row: it carries the number of copies and
    of malformed ones.  All other rows of the key have 0 copies.  ``rows`` were
    written with places, ``hashes`` are their ``repeated_hashes``; only ids and
    places of rows with such a hash are shuffled.  Keys that only share a hash
    stay apart here.  NULL keys are one key.
    """
    seen = rows.select(key, SLOT, PLACE, corrupt, F.xxhash64(key).alias("_hash")).join(hashes, "_hash", "left_semi")
    firsts = seen.groupBy(key).agg(
        F.min(PLACE).alias(PLACE), F.count(F.lit(1)).alias("_copies"), F.sum(corrupt).cast("bigint").alias("_corrupt")
    )
    slot = F.shiftright(PLACE, 33).cast("int").alias(SLOT)  # the task is in the upper bits
    keep = firsts.where("_copies > 1").select(slot, PLACE, "_copies", "_corrupt")
    zero = F.lit(0).cast("bigint")
    # places have no repeats, so a hot id makes no hot key here
    others = seen.join(firsts.select(PLACE), PLACE, "left_anti").select(
        SLOT, PLACE, zero.alias("_copies"), zero.alias("_corrupt")
    )
    return keep.unionByName(others)


def drop_marked(rows: DataFrame, marks: DataFrame | None, corrupt: str = "_corrupt") -> DataFrame:
    """``rows`` (written with places) less the marked copies, with ``_copies``
    and ``_corrupt`` per surviving row; ``marks`` is None if nothing repeats.

    A left join on the place with the marks as the side to hash: where they
    are small they are broadcast, where both are bucketed by ``_slot`` neither
    side is shuffled."""
    if marks is None:
        return rows.drop(SLOT, PLACE).withColumn("_copies", F.lit(1).cast("bigint"))
    told = marks.withColumnRenamed("_corrupt", "_marked")
    joined = rows.join(told, [SLOT, PLACE], "left").where(F.coalesce("_copies", F.lit(1)) > 0)
    return joined.withColumns(
        {"_copies": F.coalesce("_copies", F.lit(1).cast("bigint")), corrupt: F.coalesce("_marked", F.col(corrupt))}
    ).drop(SLOT, PLACE, "_marked")
