"""Firehose ingestion as a Structured Streaming query.

One micro-batch is one flush window. Each record type is written on its own, into the
partitions (created_at_day, flush_id); flush_id names the stream, its checkpoint and the batch. A
replayed batch replaces exactly the partitions it wrote before, and one whose flush log is
there is done and not written again, so upkeep may merge logged flushes. A new checkpoint starts
new ids, so it never replaces rows of an earlier one. The streaming checkpoint is what
resumes the query; the cursor table is for readers.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starling import constants as C
from starling.operators.calllog import flush_summary
from starling.operators.membership import window_dedupe
from starling.sources import envelopes as E
from starling.sources.tables import (
    DAY,
    file_listing,
    list_names,
    path_exists,
    remove_path,
    with_day,
    write_dead_letter,
)

ATTEMPTS = 3
Writer = Callable[[DataFrame, str], None]


@dataclass
class IngestJob:
    """Where a stream writes, and under which names.

    `writer` puts rows at a path; tests replace it to make a sink fail.
    """

    root: str
    run_id: str
    name: str = "firehose"
    writer: Writer | None = None
    failures: list[str] = field(default_factory=list)
    #: Identity of the checkpoint; set by start_ingest.
    checkpoint_id: str = "0"
    #: Rows that reached neither their table nor the dead letters, by type.
    dropped: dict[str, int] = field(default_factory=dict)

    def table(self, record_type: str) -> str:
        return f"{self.root.rstrip('/')}/{record_type}"

    def flush_id(self, batch_id: int) -> str:
        return f"{self.name}-{self.checkpoint_id}-{batch_id}"


def write_flush(rows: DataFrame, path: str) -> None:
    """Replace the (day, flush) partitions of `rows`; other partitions stay."""
    balanced = rows.hint("rebalance", DAY)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY, "flush_id").option("compression", C.COMPRESSION).parquet(path)


def _commit(job: IngestJob, record_type: str, rows: DataFrame) -> bool:
    """Write with retries; False when every try failed. A wrong schema is not retried."""
    write = job.writer or write_flush
    for attempt in range(1, ATTEMPTS + 1):
        try:
            write(rows, job.table(record_type))
            return True
        except AnalysisException as error:
            job.failures.append(f"{record_type}: {error}")
            return False
        except Exception as error:
            job.failures.append(f"{record_type}: {error}")
            if attempt < ATTEMPTS:
                time.sleep(0.1 * 2**attempt)
    return False


def window_rows(parsed: DataFrame, run_id: str, flush_id: str) -> DataFrame:
    """The window's rows of all types: first per (type, uri), stamped, with their day."""
    stored = parsed.filter(F.col("record_type").isNotNull())
    rows = window_dedupe(stored, ["ingested_at", "cid", "rev"], ["record_type"])
    return with_day(rows).withColumns({"run_id": F.lit(run_id), "flush_id": F.lit(flush_id)})


def type_rows(window: DataFrame, record_type: str) -> DataFrame:
    columns = [*E.COMMON_COLUMNS, *E.PAYLOAD_COLUMNS[record_type], DAY, "run_id", "flush_id"]
    return window.filter(F.col("record_type") == record_type).select(*columns)


def _row_size() -> Column:
    """Bytes of the row as JSON, with its own type's columns only."""
    size = F.lit(None).cast("int")
    for record_type, payload in E.PAYLOAD_COLUMNS.items():
        whole = F.octet_length(F.to_json(F.struct(*E.COMMON_COLUMNS, *payload, "run_id")))
        size = F.when(F.col("record_type") == record_type, whole).otherwise(size)
    return size


def process_batch(job: IngestJob, frames: DataFrame, batch_id: int) -> None:
    """Parse one window and commit it."""
    process_parsed(job, E.parse_envelopes(E.decode(frames)), batch_id)


def process_parsed(job: IngestJob, rows: DataFrame, batch_id: int) -> None:
    """Commit the four tables of one window of parsed rows, then its flush log and cursor.

    The window is parsed and deduplicated once and kept for the five writes. Lost blocks are
    recomputed from the batch's files, which the streaming checkpoint pins.
    """
    spark = rows.sparkSession
    flush_id = job.flush_id(batch_id)
    if path_exists(spark, f"{job.root}/_flush_log/flush_id={flush_id}/_SUCCESS"):
        return
    seen = Observation()
    parsed = rows.observe(seen, F.max("time_us").alias("time_us"))
    window = window_rows(parsed, job.run_id, flush_id).persist()
    try:
        stored_rows = window.count()
        position = seen.get["time_us"]
        if position is None:
            return
        dead, lost_types = [], []
        for record_type in C.RECORD_TYPES:
            rows = type_rows(window, record_type)
            if not _commit(job, record_type, rows):
                dead.append(record_type)
                day = time.strftime("%Y-%m-%d", time.gmtime(position / 1e6))
                try:
                    write_dead_letter(
                        rows, f"{job.root.rstrip('/')}/_dead_letters", record_type, job.run_id, day, flush_id
                    )
                except Exception as error:
                    job.failures.append(f"{record_type} dead letters: {error}")
                    lost_types.append(record_type)
                    job.dropped[record_type] = job.dropped.get(record_type, 0) + rows.count()
        if stored_rows:
            sizes = window.select("flush_id", "record_type", _row_size().alias("row_size"))
            summary = flush_summary(sizes, "flush_id").drop("flush_id")
            kept_aside = _sum_of([name for name in dead if name not in lost_types])
            summary.withColumns(
                {"dead_letters": kept_aside, "dropped": _sum_of(lost_types), "run_id": F.lit(job.run_id)}
            ).coalesce(1).write.mode("overwrite").parquet(
                f"{job.root}/_flush_log/flush_id={flush_id}"
            )
        write_cursor(spark, job, batch_id, position)
    finally:
        window.unpersist()


def _sum_of(record_types: list[str]) -> Column:
    total = F.lit(0).cast("bigint")
    for name in record_types:
        total = total + F.col(f"{name}_rows")
    return total


#: Cursor rows that are kept; older ones are removed as new ones come.
CURSORS = 8


def write_cursor(spark: SparkSession, job: IngestJob, batch_id: int, time_us: int) -> None:
    """Record the position reached; a failed write only means a longer replay.

    The position never moves back: the row holds the furthest one known. A bounded number of
    rows stays.
    """
    folder = f"{job.root.rstrip('/')}/_cursor/query={job.name}"
    try:
        known = read_cursor(spark, job.root, job.name)
        row = spark.range(1).select(F.lit(max(time_us, known or time_us)).cast("bigint").alias("time_us"))
        row.write.mode("overwrite").parquet(f"{folder}/batch_id={job.checkpoint_id}-{batch_id}")
        rows = spark.read.parquet(folder).select("time_us", F.col("_metadata.file_path").alias("path"))
        # At most CURSORS rows and those of failed removals.
        old = rows.orderBy(F.desc("time_us"), F.desc("path")).collect()[CURSORS:]
        for r in old:
            remove_path(spark, r["path"].rsplit("/", 1)[0])
    except Exception as error:
        job.failures.append(f"cursor: {error}")


def read_cursor(spark: SparkSession, root: str, name: str = "firehose", rewind_us: int = 0) -> int | None:
    """Furthest position written by any batch, so it never moves back."""
    path = f"{root.rstrip('/')}/_cursor"
    if not path_exists(spark, path):
        return None
    rows = spark.read.parquet(path).filter(F.col("query") == name)
    furthest = rows.agg(F.max("time_us")).first()[0]
    return None if furthest is None else furthest - rewind_us


def start_ingest(
    frames: DataFrame, job: IngestJob, checkpoint: str, every: str | None = "30 minutes", horizon: str | None = None
) -> StreamingQuery:
    """Start the query over streaming frames (`value`); `every` None drains what is there.

    With a `horizon` ("21 days") a uri that an earlier window stored is not stored again
    (`deduplicated_stream`); without one windows forget each other.
    """
    job.checkpoint_id = checkpoint_identity(frames.sparkSession, checkpoint)
    process = process_batch
    if horizon is not None:
        frames, process = deduplicated_stream(E.parse_envelopes(E.decode(frames)), horizon), process_parsed
    stream = frames.writeStream.queryName(job.name).option("checkpointLocation", checkpoint)
    stream = stream.foreachBatch(lambda batch, batch_id: process(job, batch, batch_id))
    stream = stream.trigger(availableNow=True) if every is None else stream.trigger(processingTime=every)
    return stream.start()


def checkpoint_identity(spark: SparkSession, checkpoint: str) -> str:
    """A short id that is made once per checkpoint folder and read again afterwards."""
    folder = f"{checkpoint.rstrip('/')}/_identity"
    if not list_names(spark, folder):
        spark.range(1).write.parquet(f"{folder}/{uuid.uuid4().hex[:12]}")
    return list_names(spark, folder)[0]


def flush_due(pending_bytes: int, age_seconds: float, max_bytes: int, max_age_seconds: float) -> str | None:
    """Why a flush is due: "size" before "age"; None while neither limit is met or nothing waits."""
    if pending_bytes <= 0:
        return None
    if pending_bytes >= max_bytes:
        return "size"
    return "age" if age_seconds >= max_age_seconds else None


#: The source forgets a landed file so long after it; older ones do not wait either.
REMEMBERED = "90 days"


def _one_form(path: Column) -> Column:
    """A path as text, whichever number of slashes follows its scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path) of the landed files that the stream has taken into a batch, from its own log."""
    log = f"{checkpoint.rstrip('/')}/sources/0"
    if not path_exists(spark, log):
        return spark.createDataFrame([], "path string")
    # Compacted logs end in .compact; a log line is one file.
    lines = spark.read.text(log).select(F.from_json("value", "path string").alias("entry"))
    return lines.select(_one_form(F.col("entry.path")).alias("path")).filter("path IS NOT NULL").distinct()


def waiting_files(spark: SparkSession, source: str, checkpoint: str) -> DataFrame:
    """(path, bytes, modified) of the landed files that no batch has taken: a set, not a difference
    of sizes, so files may be removed after their flush or land during one."""
    landed = file_listing(spark, source).withColumn("path", _one_form(F.col("path")))
    newest = landed.agg(F.max("modified")).scalar()
    recent = landed.filter(F.col("modified") >= newest - F.expr(f"INTERVAL {REMEMBERED}"))
    return recent.join(taken_files(spark, checkpoint), "path", "left_anti")


def flush_windows(
    spark: SparkSession, source: str, job: IngestJob, checkpoint: str, max_bytes: int = C.FLUSH_BYTES,
    max_age_seconds: float = C.FLUSH_AGE.total_seconds(), poll_seconds: float = 5.0, stop: Callable[[], bool] = lambda: False,
) -> list[str]:
    """Flush landed files whenever `max_bytes` wait or the oldest has waited `max_age_seconds`.

    What waits is read from the folder and the stream's log at every poll, so a restart knows it
    too. A flush drains everything that waits, in batches of at most `max_bytes`, so a backlog
    never outlives a flush. Returns the reasons of the flushes made until `stop` says so;
    what waits then is flushed too.
    """
    reasons: list[str] = []
    while True:
        ending = stop()
        since = F.unix_micros("modified").cast("double") / 1e6
        total = F.sum(F.greatest("bytes", F.lit(1)))
        size, oldest = waiting_files(spark, source, checkpoint).agg(total, F.min(since)).first()
        age = 0.0 if oldest is None else time.time() - oldest
        reason = flush_due(size or 0, age, max_bytes, float("-inf") if ending else max_age_seconds)
        if reason:
            start_ingest(file_frames(spark, source, max_bytes), job, checkpoint, every=None).awaitTermination()
            reasons.append(reason)
        elif ending:
            return reasons
        else:
            time.sleep(poll_seconds)


def file_frames(spark: SparkSession, path: str, max_bytes: int = C.FLUSH_BYTES) -> DataFrame:
    """Landed capture files as a stream; a batch admits at most `max_bytes` of them."""
    reader = spark.readStream.option("maxBytesPerTrigger", str(max_bytes)).option("maxFileAge", REMEMBERED.replace(" days", "d"))
    return reader.text(path)


def deduplicated_stream(parsed: DataFrame, horizon: str = "21 days") -> DataFrame:
    """Stored rows without the repeats of a (record_type, uri) inside the horizon, across windows.

    A key is known from its first row until the newest row of earlier windows is two horizons ahead
    of it, so repeats somewhat beyond the horizon stay out as well.
    The state holds one key per uri of the horizon, hashed over the shuffle partitions, and goes with the
    checkpoint, so a restart forgets nothing. A 21-day state outgrows memory: set
    `spark.sql.streaming.stateStore.providerClass` to the RocksDB provider, as `get_session` does.

    A row older than the newest one of the windows before by more than the horizon is late and is not
    stored; the stream's progress counts it (`numRowsDroppedByWatermark`). Which of the rows that a uri
    has in one window stays is not defined, of those in different windows it is the earliest window's. A
    window that is replayed after a stop may keep another of its rows, which day upkeep removes. Rows
    without a time of arrival are compared inside their window only.
    """
    stored = parsed.filter(F.col("record_type").isNotNull())
    return stored.withWatermark("ingested_at", horizon).dropDuplicatesWithinWatermark(["record_type", "uri"])


# -- gauges ------------------------------------------------------------------------------


def gauges(spark: SparkSession, root: str, now_us: int, name: str = "firehose") -> DataFrame:
    """Cursor lag and totals written, from the cursor and the flush log."""
    cursor = spark.read.parquet(f"{root}/_cursor").filter(F.col("query") == name)
    log = spark.read.parquet(f"{root}/_flush_log")
    position = cursor.agg(F.max("time_us").alias("cursor_us"))
    return position.withColumns(
        {
            "lag_seconds": (F.lit(now_us) - F.col("cursor_us")) / 1e6,
            "rows_written": log.agg(
                F.sum(F.col("total_rows") - F.col("dead_letters") - F.col("dropped"))
            ).scalar(),
            "dead_letters": log.agg(F.sum("dead_letters")).scalar(),
            "dropped": log.agg(F.sum("dropped")).scalar(),
            "mb_written": log.agg(F.sum("total_mb")).scalar(),
            "flushes": log.agg(F.count("*")).scalar(),
        }
    )
