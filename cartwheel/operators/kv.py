"""SNK8: key-value rows as long-form cells, and the merge rule of an upsert.

A put replaces the cells it names and leaves the others; nothing is ever
deleted.  Cells: ``table, row_key, column, value`` (column = "cf:<name>",
value = the text Python's ``str()`` gives for the value).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.text import kv_payload, python_text
from cartwheel.schema import KV_FAMILY


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = python_text(F.col(name))
    else:
        text = F.col(name).cast("string")
    return F.coalesce(text, F.lit("None"))  # str(None)


def to_cells(df: DataFrame, table: str, row_key: Column, cells: Mapping[str, str]) -> DataFrame:
    """Rows -> cells.  ``cells`` maps a DataFrame column to its qualifier.

    No ``collect``: the cells stay a distributed frame.
    """
    entries = F.array(
        *[
            F.struct(F.lit(f"{KV_FAMILY}:{q}").alias("column"), _as_text(df, c).alias("value"))
            for c, q in cells.items()
        ]
    )
    return df.select(
        F.lit(table).alias("table"), row_key.cast("string").alias("row_key"), F.explode(entries).alias("_c")
    ).select("table", "row_key", "_c.column", "_c.value")


def latest_cells(cells: DataFrame, version: Sequence[str]) -> DataFrame:
    """Merge rule: per (table, row_key, column) the cell with the greatest
    ``version`` tuple wins.  Partial aggregation per task, so a hot row key
    is combined before the shuffle."""
    newest = F.max_by(F.col("value"), F.struct(*[F.col(v) for v in version]))
    return cells.groupBy("table", "row_key", "column").agg(newest.alias("value"))


def row_payloads(df: DataFrame, table: str, row_key: Column, cells: Mapping[str, str]) -> DataFrame:
    """FN12: the REST JSON body of each row put, as data (no HTTP call).

    Output: ``table, row_key, payload``; the cells appear in the order of
    ``cells`` (a DataFrame column -> qualifier mapping), values as text.
    """
    entries = F.array(
        *[F.struct(F.lit(q).alias("column"), _as_text(df, c).alias("value")) for c, q in cells.items()]
    )
    key = row_key.cast("string")
    return df.select(F.lit(table).alias("table"), key.alias("row_key"), kv_payload(key, entries).alias("payload"))
