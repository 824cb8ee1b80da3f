"""RA1 / RA2: order totals from items and the current cart per session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.money import items_total, money_parts, money_total, round2, subtotal
from cartwheel.schema import ADD_TO_CART


def order_totals_from_arrays(purchase_events: DataFrame) -> DataFrame:
    """RA1 on purchase events that carry their ``items`` array.

    Output: ``order_id, items_total, total, total_matches``.  Per-row
    higher-order aggregate: no explode, no shuffle.
    """
    it = items_total("items")
    return purchase_events.select(
        "order_id",
        it.alias("items_total"),
        "total",
        (it == round2("total")).alias("total_matches"),
    )


def order_totals_from_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """RA1 on exploded items: sum per order, then compare with the order.

    ``items``: ``order_id, quantity, price``; ``orders``: ``order_id, total``.
    Every order appears; one without items has 0.0.  Items are summed as
    ``functions.money`` does, so a total does not depend on the order of
    addition.  The join sees one row per order on both sides.
    """
    sums = items.groupBy("order_id").agg(*money_parts(subtotal("quantity", "price")))
    it = F.coalesce(money_total(), F.lit(0.0))
    return orders.select("order_id", "total").join(sums, "order_id", "left").select(
        "order_id",
        it.alias("items_total"),
        "total",
        (it == round2("total")).alias("total_matches"),
    )


def cart_state(
    events: DataFrame,
    session: str = "session_id",
    product: str = "product_id",
    values: Sequence[str] = ("quantity", "price"),
    order_by: Sequence[str] = ("ingest_time", "event_id"),
    cart_type: str | None = ADD_TO_CART,
) -> DataFrame:
    """RA2: last cart event per (session, product) wins.

    ``max_by`` over the ``order_by`` tuple -- a partial aggregation, so a
    session with millions of cart events is combined per task first.
    Output: ``session, product, *values``.
    """
    src = events if cart_type is None else events.where(F.col("event_type") == cart_type)
    last = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(c) for c in order_by]))
    return src.groupBy(session, product).agg(last.alias("_v")).select(
        session, product, *[F.col("_v")[v].alias(v) for v in values]
    )
