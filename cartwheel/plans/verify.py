"""The delivery check: did the landing folder receive what the source sent?

    source file(s) -> read_lines -> inspect_json --+
                                                   +-> delivery_report (one row)
    sink folder    -> read_lines -> inspect_json --+-> event_type_counts

Exit code 0 when the report's ``ok`` is true (and, with ``--minutes``, the
sink grew at every sample).
"""

from __future__ import annotations

import argparse
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import operators as op
from cartwheel.config import build_session, job_dir, remove_dir
from cartwheel.sinks.files import show_all
from cartwheel.sources.lines import count_files, count_lines, read_lines
from cartwheel.streaming.line_count import RunningLineCount


def stage_inspected(spark: SparkSession, path: str, staging: str) -> DataFrame:
    """Lines of ``path`` through the exact JSON test, written once as
    Parquet under the shared folder and read back: the Python test runs once
    per line however many counts use it, and the lineage is cut.  The line
    text is kept only for failing lines."""
    inspected = op.inspect_lines(read_lines(spark, path))
    inspected.withColumn("line", F.when(~F.col("line_ok"), F.col("line"))).write.mode("overwrite").parquet(staging)
    return spark.read.parquet(staging)


def check(
    spark: SparkSession, source: str, sink: str, staging: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(report, counts by event type) for a source path and a sink folder.
    ``staging`` defaults to a new folder under ``spark.checkpoint.dir``."""
    root = staging or job_dir(spark, "verify")
    src = stage_inspected(spark, source, f"{root}/source")
    snk = stage_inspected(spark, sink, f"{root}/sink")
    return op.delivery_report(src, snk, count_files(spark, sink)), op.event_type_counts(snk)


def monitor(spark: SparkSession, source: str, sink: str, minutes: float, interval: float = 15.0) -> DataFrame:
    """WF2: sample the source and sink line counts every ``interval`` seconds
    for ``minutes``; the samples (one row each) go through ``growth_report``.

    The sink is counted file by file, again only where a file is new or has
    changed; the source is one log file, counted whole at each sample.
    """
    state = job_dir(spark, "monitor")
    sink_count = RunningLineCount(spark, sink, state)
    try:
        end = time.time() + minutes * 60
        rows = []
        while True:
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            rows.append((now, count_lines(spark, source), sink_count.sample()))
            if time.time() + interval > end:
                break
            time.sleep(interval)
    finally:
        remove_dir(spark, state)
    samples = spark.createDataFrame(rows, "sample_ts timestamp_ntz, source_rows bigint, sink_rows bigint")
    return op.growth_report(samples)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Check that a sink folder received the source's events")
    ap.add_argument("--source", required=True)
    ap.add_argument("--sink", required=True)
    ap.add_argument("--minutes", type=float, default=0.0, help="0 = check once")
    ap.add_argument("--interval", type=float, default=15.0)
    args = ap.parse_args(argv)
    spark = build_session(app_name="cartwheel-verify")
    try:
        grew = True
        if args.minutes > 0:
            growth = monitor(spark, args.source, args.sink, args.minutes, args.interval).persist()
            show_all(growth, "growth samples:")
            grew = bool(op.growth_ok(growth).first()["ok"])
        staging = job_dir(spark, "verify")
        report, types = check(spark, args.source, args.sink, staging)
        show_all(types, "events in the sink by type:")
        row = report.first()
        remove_dir(spark, staging)
        for key, value in row.asDict().items():
            print(f"{key:<18} {value}")
        return 0 if (row["ok"] and grew) else 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
