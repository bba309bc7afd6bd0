"""What a running stream received, as a table: a listener appends one row per batch and per end.

The frames of a batch and their bytes are observed in the stream's own plan, so nothing is read twice.
A stream that ends by an error is a disconnect with the reason its message gives. Rows lie in folders
named by run and batch; an event told twice replaces its own row.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from starling.sources.tables import path_exists

OBSERVED = "received"
EVENTS = "name string, run string, kind string, batch_id long, frames long, bytes long, reason string"
REASON = re.compile(r"jetstream disconnected: ([^\n\"\[]*?)(?: SQLSTATE: \w+)?\s*(?:[\n\"\[]|$)")


def observed(frames: DataFrame, column: str = "value") -> DataFrame:
    """The frames, counted as they pass."""
    size = F.coalesce(F.sum(F.octet_length(column).cast("bigint")), F.lit(0).cast("bigint"))
    return frames.observe(OBSERVED, F.count("*").alias("frames"), size.alias("bytes"))


class MetricsListener(StreamingQueryListener):
    """Appends the events of the stream `name` below `root`."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.folder, self.name = spark, f"{root.rstrip('/')}/_metrics", name
        self.running: set[str] = set()
        self.errors: list[str] = []

    def _add(self, run: str, kind: str, batch: int = -1, frames: int = 0, size: int = 0, reason: str | None = None) -> None:
        try:
            row = self.spark.createDataFrame([(self.name, run, kind, batch, frames, size, reason)], EVENTS)
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/event={run}-{kind}-{batch}")
        except Exception as error:  # a gauge that fails must not stop the stream
            self.errors.append(str(error))

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = (progress.observedMetrics or {}).get(OBSERVED)
        if progress.name == self.name and seen is not None and seen["frames"]:
            self._add(str(progress.runId), "batch", progress.batchId, seen["frames"], seen["bytes"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if run not in self.running:
            return
        if event.exception is None:
            self._add(run, "end")
        else:
            found = REASON.search(event.exception)
            self._add(run, "disconnect", reason=found[1].strip() if found else "(none)")
        self.running.discard(run)


@contextmanager
def measured(spark: SparkSession, root: str, name: str = "firehose", patience: float = 60.0) -> Iterator[MetricsListener]:
    """Metrics of the streams called `name` that run inside; waits until their ends are told."""
    listener = MetricsListener(spark, root, name)
    spark.streams.addListener(listener)
    try:
        yield listener
        until = time.monotonic() + patience
        time.sleep(0.2)
        while listener.running and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)


def stream_totals(spark: SparkSession, root: str, name: str = "firehose") -> DataFrame:
    """Batches, frames, bytes, and ends of each kind, of all runs of a stream."""
    path = f"{root.rstrip('/')}/_metrics"
    events = spark.read.schema(EVENTS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], EVENTS)
    zero = F.lit(0).cast("bigint")
    return events.filter(F.col("name") == name).agg(
        F.count_if(F.col("kind") == "batch").alias("batches"),
        F.coalesce(F.sum("frames"), zero).alias("frames"),
        F.coalesce(F.sum("bytes"), zero).alias("bytes"),
        F.count_if(F.col("kind") == "end").alias("ends"),
        F.count_if(F.col("kind") == "disconnect").alias("disconnects"),
        F.max("reason").alias("last_reason"),
    )
