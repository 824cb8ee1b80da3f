"""A running count of the non-blank lines landed in a folder.

Used by the growth monitor.  Each sample lists the folder and counts only the
files that are new or whose size or modification time changed since they were
last counted, so a sample costs what arrived, and a file that is still being
appended to (a rolling agent's open file) is counted again while it grows.
The counts per file are a Parquet table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.lines import file_states, read_lines

COUNTS = "path string, length bigint, modificationTime timestamp, lines bigint"


class RunningLineCount:
    def __init__(self, spark: SparkSession, folder: str, state: str, changed_limit: int = 10_000):
        self.spark, self.folder, self.state = spark, folder, state.rstrip("/")
        self.changed_limit = changed_limit
        self.counts: DataFrame = spark.createDataFrame([], COUNTS)
        self.samples = 0

    def sample(self) -> int:
        """Non-blank lines under the folder now."""
        keys = ["path", "length", "modificationTime"]
        # one listing: what is counted must be what is remembered
        seen = f"{self.state}/files-{self.samples}"
        file_states(self.spark, self.folder).write.mode("overwrite").parquet(seen)
        files = self.spark.read.parquet(seen)
        known = files.join(self.counts, keys)
        changed = files.join(self.counts, keys, "left_anti")
        # the names of changed files choose what is read; when there are very
        # many (the first sample), the whole folder is read instead
        names = [r["path"] for r in changed.select("path").limit(self.changed_limit + 1).collect()]
        whole = len(names) > self.changed_limit or self.samples == 0
        if names:
            lines = read_lines(self.spark, self.folder if whole else names)
            counted = lines.groupBy(F.col("file").alias("path")).agg(F.count(F.lit(1)).alias("lines"))
            counted = changed.join(counted, "path", "left").select(*keys, F.coalesce("lines", F.lit(0)).alias("lines"))
            known = known.select(*keys, "lines").unionByName(counted)
        path = f"{self.state}/counts-{self.samples}"
        known.select(*keys, "lines").write.mode("overwrite").parquet(path)
        self.counts = self.spark.read.schema(COUNTS).parquet(path)
        self.samples += 1
        return self.counts.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
