"""SRC5: land raw lines from a source folder into rolled text files.

Replaces a log-collection agent: every closed file that appears in the
source folder is copied line by line, unchanged, into new files of the
landing folder, one set per trigger (10 s).  The checkpoint records which
source files were taken, so a restart neither loses nor repeats lines, and
the file sink commits each batch atomically (readers never see half files).
Write source files by atomic rename: a file still growing after it was
listed is not read again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

ROLL_INTERVAL = "10 seconds"


def start_landing(
    spark: SparkSession,
    source_dir: str,
    landing_dir: str,
    checkpoint: str,
    roll: str = ROLL_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    lines = spark.readStream.format("text").load(source_dir)
    writer = lines.writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=roll)
    return writer.start(landing_dir)
