"""SRC1: batch scan of a landing folder of JSON-lines event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schema import CORRUPT_COLUMN, EVENT_SCHEMA, EVENT_TEXT_SCHEMA, NUMBERS


def read_events(spark: SparkSession, path: str, keep_corrupt: bool = True) -> DataFrame:
    """Read every file under ``path`` with the one explicit event schema.

    No inference pass (which would read the whole folder once more) and an
    empty folder gives a typed empty frame.  PERMISSIVE mode: a malformed line
    becomes a row of NULLs whose raw text is in ``_corrupt_record``; fields a
    line lacks are NULL; blank lines are skipped.  Numbers are read as their
    text and cast, so ``2``, ``1.5`` and ``"3"`` are all amounts; a text that
    is no number is NULL and its line is not malformed.  Filters and
    projections applied later are pushed into the scan.
    """
    raw = (
        spark.read.schema(EVENT_TEXT_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )
    return typed_events(raw, keep_corrupt)


def typed_events(raw: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """Events as parsed with ``EVENT_TEXT_SCHEMA`` (a batch or a stream) ->
    events with numbers."""

    def number(c):
        return c.try_cast("double")

    items = F.transform(
        "items",
        lambda i: F.when(
            i.isNotNull(),
            F.struct(
                i["product_id"].alias("product_id"),
                number(i["quantity"]).alias("quantity"),
                number(i["price"]).alias("price"),
            ),
        ),
    )
    columns = [
        (items if n == "items" else number(F.col(n)) if n in NUMBERS else F.col(n)).alias(n) for n in EVENT_SCHEMA.names
    ]
    return raw.select(*columns, *([CORRUPT_COLUMN] if keep_corrupt else []))
