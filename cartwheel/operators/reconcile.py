"""Delivery check: AG10-AG14, WF1, WF2, JN3, JN4.

Compares what a source sent with what landed in a sink folder.  All counts
are aggregations; the only per-row Python is the exact JSON test
(``inspect_json``).  Nothing is collected except the final one-row report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.parsing import inspect_json

REPORT_METRICS = (
    "source_rows",
    "sink_files",
    "sink_rows",
    "invalid",
    "incomplete_last",
    "foreign_ids",
    "missing_rows",
)


def inspect_lines(lines: DataFrame) -> DataFrame:
    """Add ``id_ok, event_id, line_ok, event_type`` from the exact JSON test
    (``json.loads`` semantics, Arrow-batched Python)."""
    return lines.withColumn("_j", inspect_json(F.col("line"))).select(
        *lines.columns, "_j.id_ok", "_j.event_id", "_j.line_ok", "_j.event_type"
    )


def id_multiplicity(source_ids: DataFrame, sink_ids: DataFrame, key: str = "event_id") -> DataFrame:
    """AG11: ``event_id, source_n, sink_n`` for every id seen on either side.

    One aggregation over the union of both sides (partial per task, so a
    repeated id is combined before the shuffle) instead of two counts and a
    join.
    """
    both = source_ids.select(F.col(key).alias("event_id"), F.lit(1).alias("_s"), F.lit(0).alias("_k")).unionByName(
        sink_ids.select(F.col(key).alias("event_id"), F.lit(0).alias("_s"), F.lit(1).alias("_k"))
    )
    return both.groupBy("event_id").agg(
        F.sum("_s").cast("bigint").alias("source_n"), F.sum("_k").cast("bigint").alias("sink_n")
    )


def reconcile_ids(source_ids: DataFrame, sink_ids: DataFrame, key: str = "event_id") -> DataFrame:
    """JN3 + JN4 as one row: ``foreign_ids`` (distinct sink ids absent from
    the source) and ``missing_rows`` (sum over source ids of
    max(0, source count - sink count), i.e. the size of the multiset
    difference source - sink)."""
    m = id_multiplicity(source_ids, sink_ids, key)
    return m.agg(
        F.count(F.when(F.col("source_n") == 0, 1)).alias("foreign_ids"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col("source_n") - F.col("sink_n"))), F.lit(0))
        .cast("bigint")
        .alias("missing_rows"),
    )


def file_lines(sink: DataFrame) -> DataFrame:
    """``file, rows, invalid, incomplete_last`` per sink file.

    A failing line is "incomplete" when it is the last line of its file (it
    may still be being written), otherwise "invalid".  The last line is a max
    over ``(block, pos)`` that carries whether the line is good, so one
    aggregation with a partial step per task gives all counts: no join, no
    sort, and a huge file is never gathered into one task.
    """
    last = F.max(F.struct("block", "pos", "line_ok"))
    return (
        sink.groupBy("file")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("line_ok")).alias("_bad"), last.alias("_last"))
        .select(
            "file",
            "rows",
            (F.col("_bad") - (~F.col("_last.line_ok")).cast("bigint")).alias("invalid"),
            (~F.col("_last.line_ok")).cast("bigint").alias("incomplete_last"),
        )
    )


def event_type_counts(sink: DataFrame) -> DataFrame:
    """AG10 + SO4: ``event_type, count`` over valid sink lines, most first."""
    return (
        sink.where(F.col("line_ok"))
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("event_type"))
    )


def _metric(name: str, sink_files: int):
    if name == "sink_files":
        return F.lit(sink_files).cast("bigint").alias(name)
    return F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name)


def delivery_report(source: DataFrame, sink: DataFrame, sink_files: int) -> DataFrame:
    """One row: the seven counts of ``REPORT_METRICS`` and ``ok``.

    ``source`` and ``sink`` are inspected lines (``inspect_lines``);
    ``sink_files`` is the number of files in the sink folder.
    ok = sink_rows > 0 and invalid = 0 and foreign_ids = 0 (missing rows do
    not fail the check: the newest lines may still be in flight).
    """
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    lines = file_lines(sink).agg(zero("rows"), zero("invalid"), zero("incomplete_last"))
    ids = reconcile_ids(source.where(F.col("id_ok")), sink.where(F.col("id_ok")))

    def long(df: DataFrame, names: dict[str, str]) -> DataFrame:
        pairs = ", ".join(f"'{metric}', {column}" for column, metric in names.items())
        return df.select(F.expr(f"stack({len(names)}, {pairs}) AS (metric, value)"))

    metrics = (
        long(source.agg(F.count(F.lit(1)).alias("n")), {"n": "source_rows"})
        .unionByName(long(lines, {"rows": "sink_rows", "invalid": "invalid", "incomplete_last": "incomplete_last"}))
        .unionByName(long(ids, {"foreign_ids": "foreign_ids", "missing_rows": "missing_rows"}))
    )
    report = metrics.agg(*[_metric(m, sink_files) for m in REPORT_METRICS])
    ok = (F.col("sink_rows") > 0) & (F.col("invalid") == 0) & (F.col("foreign_ids") == 0)
    return report.withColumn("ok", ok)


def growth_report(samples: DataFrame, ts: str = "sample_ts") -> DataFrame:
    """WF2: ``sample_ts, source_rows, sink_rows, difference, state``.

    state: "first sample" for the first row, "growing" when the sink count
    rose since the previous sample, else "stalled".  The input has one row per
    sample (a monitoring interval), so its size does not grow with the data;
    the un-partitioned ordering window runs over that small series only.
    """
    w = Window.orderBy(F.col(ts))
    return growth_states(samples, F.lag("sink_rows").over(w), ts)


def growth_states(samples: DataFrame, prev: Column, ts: str = "sample_ts") -> DataFrame:
    """``growth_report`` of samples whose previous sink count is ``prev``."""
    state = (
        F.when(prev.isNull(), F.lit("first sample"))
        .when(F.col("sink_rows") > prev, F.lit("growing"))
        .otherwise(F.lit("stalled"))
    )
    return samples.select(
        ts,
        "source_rows",
        "sink_rows",
        (F.col("source_rows") - F.col("sink_rows")).alias("difference"),
        state.alias("state"),
    )


def growth_ok(report: DataFrame) -> DataFrame:
    """One row ``ok``: the sink grew at every sample after the first."""
    return report.agg(F.coalesce(F.bool_and(F.col("state") != "stalled"), F.lit(True)).alias("ok"))
