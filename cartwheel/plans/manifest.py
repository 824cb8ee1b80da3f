"""What a batch job has finished, so that a job begun anew goes on from there.

A manifest belongs to one state of the input: it is keyed by a digest of the
input's file listing (paths, sizes, modification times), so any new, changed or
removed file makes another manifest.  Each finished stage is a small note
written once, after the stage's own files, in the shared folder; a note that
is there says that the files it names are whole.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartwheel.config import shared_dir
from cartwheel.sources.lines import file_states


def listing_digest(spark: SparkSession, path: str) -> str:
    """A digest of the files under ``path``: one aggregation of the listing,
    no file body is read and no name comes to Python."""
    entry = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    other = F.xxhash64(F.lit(1), "path", "length", "modificationTime").cast("decimal(38,0)")
    row = file_states(spark, path).agg(F.count(F.lit(1)), F.sum("length"), F.sum(entry), F.sum(other)).first()
    return hashlib.sha256("|".join(map(str, row)).encode()).hexdigest()


class Manifest:
    """The notes of one job over one state of its input."""

    def __init__(self, spark: SparkSession, job: str, input_path: str, **options):
        self.spark = spark
        settings = json.dumps([job, input_path.rstrip("/"), options], sort_keys=True)
        key = hashlib.sha256((settings + listing_digest(spark, input_path)).encode()).hexdigest()[:24]
        self.root = shared_dir(spark, "manifests", job, key)

    def done(self, stage: str) -> dict | None:
        """The note of a finished stage, or None."""
        try:
            rows = self.spark.read.text(f"{self.root}/{stage}").collect()
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
                return None
            raise
        return json.loads(rows[0]["value"]) if rows else None

    def finish(self, stage: str, **note) -> None:
        line = self.spark.createDataFrame([(json.dumps(note),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self.root}/{stage}")
