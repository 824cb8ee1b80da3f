"""SRC3 / SRC4: raw text lines of a file or a folder, for the delivery check."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.parsing import strip_line


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank, stripped lines with their file and position.

    Columns: ``file``, ``block`` (byte offset of the split the line came
    from), ``pos`` (increasing within a split), ``line``.  ``(block, pos)``
    orders the lines of one file even when a large file is cut into several
    splits read by different tasks.  Bytes that are not UTF-8 become U+FFFD.
    A missing path gives an empty frame.
    """
    try:
        raw = spark.read.text(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return spark.createDataFrame([], "file string, block bigint, pos bigint, line string")
        raise
    return (
        raw.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            strip_line("value").alias("line"),
        )
        .where(F.col("line") != "")
    )


def count_lines(spark: SparkSession, path: str) -> int:
    """Number of non-blank lines in a file or folder; a missing path is 0."""
    return read_lines(spark, path).count()


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    """The file listing of ``path`` (None if there is no such path).  Scans
    leave out empty files, the listing itself has them."""
    try:
        return spark.read.format("binaryFile").load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise


def count_files(spark: SparkSession, path: str) -> int:
    """Number of files under ``path``, empty ones included; a missing path is
    0.  Only the length of the listing that Spark holds for a scan is asked
    for; no name comes to Python."""
    index = _index(spark, path)
    return 0 if index is None else len(index._jdf.inputFiles())


def file_states(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of every file with content, as a
    scan of the listing (no file body is read)."""
    index = _index(spark, path)
    if index is None:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    # the same form of the path as ``read_lines`` gives
    return index.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
    )


def files_by_name(spark: SparkSession, path: str) -> DataFrame:
    """SO5: the files under ``path`` in name order, empty ones included."""
    index = _index(spark, path)
    names = [] if index is None else index.inputFiles()
    return spark.createDataFrame([(n,) for n in names], "path string").orderBy("path")
