"""FN1 / PRJ2 / PRJ3: purchase events -> one row per bought item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import subtotal
from cartwheel.schema import PURCHASE


def purchases(events: DataFrame) -> DataFrame:
    """FLT1: ``event_type = 'purchase'``."""
    return events.where(F.col("event_type") == PURCHASE)


def explode_items(purchase_events: DataFrame, *keep: str) -> DataFrame:
    """``product_id, quantity, price`` of every element of ``items``, after
    the ``keep`` columns of its purchase.

    A NULL or empty ``items`` array produces no row (the order still counts
    in the city insight, which reads the purchases, not the items).
    """
    return purchase_events.select(*keep, F.inline("items")).select(*keep, "product_id", "quantity", "price")


def with_subtotal(items: DataFrame) -> DataFrame:
    """PRJ3: ``subtotal = quantity * price``."""
    return items.withColumn("subtotal", subtotal("quantity", "price"))
