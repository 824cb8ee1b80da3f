"""PRJ5, FLT5-FLT8, ST1-ST4, AG15: windowed product interest and alerts.

The same functions serve a batch frame and a streaming frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.parsing import is_blank, parse_iso_instant, project_stream_fields
from cartwheel.functions.text import iso_instant_text, trending_line
from cartwheel.schema import ADD_TO_CART, ALERT_THRESHOLD, CLICK, WINDOW_SIZE, WINDOW_SLIDE

TRENDING_TYPES = (CLICK, ADD_TO_CART)


def stream_records(lines: DataFrame, line: str = "value", types=TRENDING_TYPES) -> DataFrame:
    """Raw JSON lines -> ``event_type, product_id, event_time`` (timestamp).

    Dropped: blank and malformed lines, other event types, a missing product
    or time, a time that is not a full ISO instant with a zone.
    """
    rec = project_stream_fields(F.col(line)).alias("r")
    parsed = lines.where(~is_blank(line)).select(rec).select(
        F.col("r.event_type").alias("event_type"),
        F.col("r.product_id").alias("product_id"),
        parse_iso_instant(F.col("r.event_time")).alias("event_time"),
    )
    return parsed.where(
        F.col("event_type").isin(*types) & F.col("product_id").isNotNull() & F.col("event_time").isNotNull()
    )


def trending_counts(
    records: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str | None = None,
    product: str = "product_id",
    time: str = "event_time",
) -> DataFrame:
    """Events per (sliding event-time window, product).

    Output: ``window_start, window_end, product_id, events``.  Windows are
    aligned to the epoch; with size = 2 x slide each event lands in two.
    ``watermark`` (e.g. "40 seconds") is required for a streaming frame in
    append mode: a window is emitted once, when the watermark passes its end,
    and rows for windows already closed are dropped.  The count is kept as
    one number per (window, product) in the state store, not as a buffer of
    events.
    """
    src = records.withWatermark(time, watermark) if watermark else records
    return (
        src.groupBy(F.window(F.col(time), size, slide).alias("w"), F.col(product).alias("product_id"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "product_id",
            "events",
        )
    )


def trending_counts_paned(
    records: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    product: str = "product_id",
    time: str = "event_time",
) -> DataFrame:
    """``trending_counts`` of a batch through panes: every event is counted
    once, in the pane (a window of the slide's length) it falls into, and a
    window is the sum of its ``size / slide`` panes.

    A window of the sliding form copies each event into every window that
    holds it before anything is counted.  Here only the counted panes are
    copied, one row per (product, pane), so the rows before the first shuffle
    are the events and not a multiple of them.  ``size`` must be a multiple of
    ``slide``.
    """
    spark = records.sparkSession
    span = lambda text: spark.sql(f"SELECT unix_micros(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {text})").first()[0]
    whole, step = span(size), span(slide)
    if whole % step:
        raise ValueError(f"{size} is not a multiple of {slide}")
    panes = records.groupBy(F.window(F.col(time), slide).alias("w"), F.col(product).alias("product_id")).agg(
        F.count(F.lit(1)).alias("events")
    )
    start = F.unix_micros("w.start")
    # the windows of a pane begin with it or with one of the panes before it
    starts = F.sequence(start - F.lit(whole - step), start, F.lit(step))
    windows = panes.select(F.explode(starts).alias("at"), "product_id", "events")
    return (
        windows.groupBy("at", "product_id")
        .agg(F.sum("events").alias("events"))
        .select(
            F.timestamp_micros("at").alias("window_start"),
            F.timestamp_micros(F.col("at") + whole).alias("window_end"),
            "product_id",
            "events",
        )
    )


def alert_key(product: Column | str, start: Column | str) -> Column:
    """``<product>-<window start epoch millis>``: replays overwrite, never add."""
    p = F.col(product) if isinstance(product, str) else product
    s = F.col(start) if isinstance(start, str) else start
    return F.concat(p, F.lit("-"), F.unix_millis(s).cast("string"))


def alerts(counts: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """FLT8 + PRJ6: windows with ``events >= threshold`` as alert rows.

    Output: ``row_key, product_id, events, window_start_iso, window_end_iso``.
    """
    return counts.where(F.col("events") >= threshold).select(
        alert_key("product_id", "window_start").alias("row_key"),
        "product_id",
        "events",
        iso_instant_text("window_start").alias("window_start_iso"),
        iso_instant_text("window_end").alias("window_end_iso"),
    )


def trending_text(counts: DataFrame) -> DataFrame:
    """SNK3 input: one ``value`` line per (window, product)."""
    return counts.select(trending_line("window_start", "window_end", "product_id", "events").alias("value"))
