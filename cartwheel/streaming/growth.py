"""WF2 + SRC4: the growth of a sink folder from a stream's own progress.

    readStream.text(sink) -> non-blank lines -> running count (state)
      -> observed per micro-batch, kept per batch

The stream's checkpoint remembers which files were read and the state holds the
running count, so a sample costs what has landed since the last one and a
restarted monitor goes on from the count it had.  Nothing is listed or joined
by the monitor itself.  A ``StreamingQueryListener`` turns the stream's events
into samples: a micro-batch gives one with its new count, an idle trigger one
with the count as it was (the sink stalled).

Files are counted when they land and not again: for a folder whose files are
appended to in place there is ``RunningLineCount``.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cartwheel.functions.parsing import is_blank
from cartwheel.operators.reconcile import growth_states
from cartwheel.streaming.trending import stream_settings

SAMPLES = "sample_ts timestamp_ntz, source_rows bigint, sink_rows bigint"
METRIC = "sink_growth"


class GrowthListener(StreamingQueryListener):
    """Collects the samples of one stream; ``begin`` is the count before it."""

    def __init__(self, begin: int = 0):
        self.total = begin
        self.samples: list[tuple[datetime, int]] = []
        self.run_id: str | None = None
        self.ended = threading.Event()
        # events of a run that begins are kept until its id is known
        self._early: list = []

    def follow(self, query: StreamingQuery) -> None:
        self.run_id = str(query.runId)
        for run_id, at, total in self._early:
            self._sample(run_id, at, total)
        self._early = []

    def _sample(self, run_id, at: str, total: int | None) -> None:
        if self.run_id is None:
            self._early.append((run_id, at, total))
        elif str(run_id) == self.run_id:
            self.total = self.total if total is None else total
            self.samples.append((datetime.strptime(at, "%Y-%m-%dT%H:%M:%S.%fZ"), self.total))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if METRIC in p.observedMetrics:
            self._sample(p.runId, p.timestamp, p.observedMetrics[METRIC]["sink_rows"])

    def onQueryIdle(self, event) -> None:
        self._sample(event.runId, event.timestamp, None)

    def onQueryTerminated(self, event) -> None:
        if self.run_id is None or str(event.runId) == self.run_id:
            self.ended.set()


class GrowthStream:
    """Follows ``sink``; its checkpoint and counts are under ``state``."""

    def __init__(self, spark: SparkSession, sink: str, state: str):
        self.spark, self.sink, self.state = spark, sink, state.rstrip("/")

    def counted(self) -> int:
        """The running count of all micro-batches so far."""
        try:
            counts = self.spark.read.schema("sink_rows bigint, batch bigint").parquet(f"{self.state}/counts")
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
                return 0
            raise
        return counts.agg(F.coalesce(F.max("sink_rows"), F.lit(0))).first()[0]

    def _start(self, available_now: bool, interval: str, max_files_per_trigger: int | None) -> StreamingQuery:
        reader = self.spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = reader.load(self.sink).where(~is_blank("value"))
        total = lines.agg(F.count(F.lit(1)).alias("sink_rows")).observe(METRIC, F.max("sink_rows").alias("sink_rows"))

        def keep(batch: DataFrame, batch_id: int) -> None:  # a replayed batch replaces its own count
            batch.write.mode("overwrite").parquet(f"{self.state}/counts/batch={batch_id}")

        writer = total.writeStream.outputMode("update").option("checkpointLocation", f"{self.state}/checkpoint").foreachBatch(keep)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
        with stream_settings(self.spark):
            return writer.start()

    def sample(
        self,
        seconds: float | None = None,
        interval: str = "15 seconds",
        max_files_per_trigger: int | None = None,
        source_rows: int = 0,
    ) -> DataFrame:
        """``growth_report`` of the samples taken for ``seconds`` (None: until
        what has landed is counted), after the count there was before."""
        listener = GrowthListener(self.counted())
        self.spark.streams.addListener(listener)
        try:
            query = self._start(seconds is None, interval, max_files_per_trigger)
            listener.follow(query)
            query.awaitTermination(None if seconds is None else seconds)
            query.stop()
            listener.ended.wait(30)
        finally:
            self.spark.streams.removeListener(listener)
        samples = sorted(listener.samples, key=lambda x: x[0])
        rows = [(at, source_rows, n, prev) for (at, n), prev in zip(samples, [None, *(n for _, n in samples)])]
        return growth_states(self.spark.createDataFrame(rows, f"{SAMPLES}, prev bigint"), F.col("prev"))
