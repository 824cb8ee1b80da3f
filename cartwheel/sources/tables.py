"""SRC6: read an insight table by name from the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """``SELECT *`` from a catalog table (``database.name``)."""
    return spark.table(f"{database}.{name}" if database else name)
