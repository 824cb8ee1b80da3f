"""RA2 as a continuous state: the current cart of every session.

    readStream.json(landing) -> cart events -> withWatermark(event_time)
      -> groupBy(slot).transformWithState(CartState)      [update mode]
      -> foreachBatch: one put of the changed cart rows per micro-batch

The state of a session is a map from product to its newest cart event (by
ingest time, then event id), so an event that arrives out of order changes
nothing if a newer one is there.  A micro-batch emits only the products whose
newest event changed; the newest put of a (session, product) is its cart row.

A session without events for ``idle`` of event time is closed: a timer removes
its state and emits its rows with ``closed``.  Events later than the watermark are
dropped, so a closed session can only begin anew.  The state lives in RocksDB,
one entry a (session, product), with the newest event time seen for it; hot
sessions are many small entries, and a batch's events are reduced to one per
product of a session before the state is touched.

Every call to the state is a message from the Python worker to the executor, and
so is the start of every group.  Sessions are therefore dealt to ``SLOTS`` slots:
a group is a slot, an entry is written with one message, and entries are read all
at once where the batch has many of the slot's, else one by one.  A slot has one
timer, no later than the earliest end of its sessions, that goes through the slot
when it fires.  ``SLOTS`` is part of a stream's state and must not change under a
checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cartwheel.functions.parsing import parse_iso_instant
from cartwheel.schema import ADD_TO_CART, EVENT_TEXT_SCHEMA
from cartwheel.sources.events import typed_events
from cartwheel.streaming.trending import query_id, stream_settings

CART_ROWS = "session_id string, product_id string, quantity double, price double, closed boolean"
_ENTRY = "quantity double, price double, ingest_time string, event_id string, at long"
IDLE, DELAY = "30 days", "7 days"
SLOTS = 4096
#: So many entries of a slot are read through for one that is wanted.
READ_THROUGH = 8


def cart_events(raw: DataFrame) -> DataFrame:
    """Cart events with a session, a product and an event time, as the state
    takes them: missing ingest times and ids count as the smallest."""
    return raw.where((F.col("event_type") == ADD_TO_CART) & F.col("session_id").isNotNull() & F.col("product_id").isNotNull()).select(
        "session_id",
        "product_id",
        "quantity",
        "price",
        F.coalesce("ingest_time", F.lit("")).alias("ingest_time"),
        F.coalesce("event_id", F.lit("")).alias("event_id"),
        parse_iso_instant("event_time").alias("event_time"),
    ).where(F.col("event_time").isNotNull())


def _newer(a: tuple, b: tuple) -> tuple:
    """The newer of two values of an entry, ``a`` if neither is, with the newer
    event time."""
    return (*(b if a[2:4] < b[2:4] else a)[:4], max(a[4], b[4]))


class CartState(StatefulProcessor):
    """State and timer of a slot of sessions."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "session_id string, product_id string", _ENTRY)
        # the timer and the number of entries
        self.slot = handle.getValueState("slot", "at long, entries long")

    def _held(self, wanted: dict, entries: int) -> dict[tuple, tuple]:
        if entries <= READ_THROUGH * len(wanted):
            pairs = self.items.iterator() if entries else ()
            return {k: tuple(v) for k, v in ((tuple(key), value) for key, value in pairs) if k in wanted}
        return {k: tuple(self.items.getValue(k)) for k in wanted if self.items.containsKey(k)}

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[tuple, tuple] = {}
        latest: dict[str, int] = {}
        for r in rows:
            at = int(r.event_time.timestamp() * 1000)
            entry = (r.session_id, r.product_id)
            value = (r.quantity, r.price, r.ingest_time, r.event_id, at)
            newest[entry] = _newer(newest[entry], value) if entry in newest else value
            latest[r.session_id] = max(latest.get(r.session_id, at), at)
        if not newest:
            return
        timer, entries = self.slot.get() if self.slot.exists() else (None, 0)
        held = self._held(newest, entries)
        for entry, value in newest.items():
            before = held.get(entry)
            after = value if before is None else _newer(before, value)
            if after != before:
                self.items.updateValue(entry, after)
            if before is None or after[2:4] != before[2:4]:
                yield Row(session_id=entry[0], product_id=entry[1], quantity=after[0], price=after[1], closed=False)
        # no session that has these events ends before
        end = min(latest.values()) + self.idle_ms
        if timer is None or end < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(end)
            timer = end
        self.slot.update((timer, entries + len(newest) - len(held)))

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        ends: dict[str, int] = {}
        entries = 0
        for entry, value in self.items.iterator():
            ends[entry[0]] = max(ends.get(entry[0], value[4] + self.idle_ms), value[4] + self.idle_ms)
            entries += 1
        live = [end for end in ends.values() if end > now]
        if len(live) < len(ends):
            for entry, value in [(tuple(k), v) for k, v in self.items.iterator() if ends[k[0]] <= now]:
                self.items.removeKey(entry)
                entries -= 1
                yield Row(session_id=entry[0], product_id=entry[1], quantity=value[0], price=value[1], closed=True)
        if live:
            self.handle.registerTimer(min(live))
            self.slot.update((min(live), entries))
        else:
            self.slot.clear()

    def close(self) -> None:
        pass


def cart_changes(events: DataFrame, idle: str = IDLE, delay: str = DELAY) -> DataFrame:
    """Streaming cart events (``cart_events``) -> changed cart rows."""
    spark = events.sparkSession
    idle_ms = spark.sql(f"SELECT unix_millis(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {idle})").first()[0]
    return (
        events.withWatermark("event_time", delay)
        .withColumn("slot", F.pmod(F.xxhash64("session_id"), F.lit(SLOTS)))
        .groupBy("slot")
        .transformWithState(
            statefulProcessor=CartState(int(idle_ms)), outputStructType=CART_ROWS, outputMode="Update", timeMode="EventTime"
        )
    )


def _write_changes(out: str):
    """A put per micro-batch, named by the stream's query id and batch id: a
    replayed batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{out.rstrip('/')}/query={query_id(batch)}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    return write


def start_cart(
    spark: SparkSession,
    input_dir: str,
    out: str,
    checkpoint: str,
    idle: str = IDLE,
    delay: str = DELAY,
    available_now: bool = False,
    poll: str = "20 seconds",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the cart stream over a landing folder of JSON-lines files."""
    reader = spark.readStream.schema(EVENT_TEXT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = cart_changes(cart_events(typed_events(reader.json(input_dir))), idle, delay)
    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(_write_changes(out))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    with stream_settings(spark):
        return writer.start()


def current_carts(spark: SparkSession, out: str) -> DataFrame:
    """``session_id, product_id, quantity, price``: per session and product the
    row of the newest batch, closed ones left out.  For the puts of one stream."""
    puts = spark.read.schema(f"{CART_ROWS}, query string, batch bigint").parquet(out)
    newest = F.max_by(F.struct("quantity", "price", "closed"), "batch").alias("_v")
    return puts.groupBy("session_id", "product_id").agg(newest).where("not _v.closed").select(
        "session_id", "product_id", "_v.quantity", "_v.price"
    )
