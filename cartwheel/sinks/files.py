"""SNK1-SNK4: file and console outputs of the insight-sized results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_parquet_single(df: DataFrame, path: str, names: Mapping[str, str] | None = None) -> None:
    """SNK1: replace ``path`` with one Parquet file; ``names`` renames columns
    (e.g. to the original output names).

    ``coalesce(1)`` funnels the rows into one task, so use it only on the
    insight results (tens of rows), never on event-sized data.
    """
    df.withColumnsRenamed(dict(names or {})).coalesce(1).write.mode("overwrite").parquet(path)


def write_csv_single(df: DataFrame, path: str, names: Mapping[str, str] | None = None) -> None:
    """SNK2: replace ``path`` with one CSV file with a header (of the renamed
    columns, if ``names`` are given).

    A sorted input keeps its order (coalesce does not shuffle).  Doubles are
    printed like 205052.0.
    """
    df.withColumnsRenamed(dict(names or {})).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def show_all(df: DataFrame, title: str | None = None) -> None:
    """SNK4: print every row of a result without truncating values.  Rows come
    to the driver one partition at a time."""
    if title:
        print(title)
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join(str(v) for v in row))
