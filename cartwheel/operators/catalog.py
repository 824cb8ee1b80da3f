"""AG3: the product -> category catalog derived from the events themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def derive_catalog(
    events: DataFrame,
    product: str = "product_id",
    category: str = "category",
    order_by: Sequence[str] = ("event_time", "event_id"),
) -> DataFrame:
    """One category per product: rows with a category, first by ``order_by``.

    ``min_by`` makes the survivor deterministic where the original kept an
    arbitrary one; for data where a product always has one category both
    agree.  Partial aggregation per task keeps a hot product cheap.
    """
    first = F.min_by(F.col(category), F.struct(*[F.col(c) for c in order_by]))
    return (
        events.where(F.col(category).isNotNull())
        .groupBy(F.col(product).alias("product_id"))
        .agg(first.alias("category"))
    )
