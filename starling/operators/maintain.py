"""Table upkeep: collapse, tombstones, duplicate masks, compaction, reports."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.keep import keep_last
from starling.sources.tables import (
    COMMITTED,
    DAY,
    SWAPS,
    create_marker,
    file_stats,
    folder_bytes,
    list_names,
    make_folder,
    move_path,
    path_exists,
    remove_path,
    retired_parts,
    write_day_partitioned,
)


def collapse_to_latest(events: DataFrame, tie_break: Sequence[str] = ("rev",)) -> DataFrame:
    """Newest row per uri by ingested_at."""
    return keep_last(events, ["uri"], ["ingested_at", *tie_break])


def drop_tombstones(collapsed: DataFrame) -> DataFrame:
    """After collapsing, so a record created and deleted is gone entirely."""
    return collapsed.filter(F.col("operation") != "delete")


def collapse_stats(events: DataFrame) -> DataFrame:
    """Rows before and after, and why rows went.

    Counted in two groupings, (uri, cid) then uri; grouping keeps a NULL cid as a value.
    """
    versions = events.groupBy("uri", "cid").agg(
        F.count("*").alias("n"), F.max(F.struct("ingested_at", "rev", "operation")).alias("last")
    )
    per_uri = versions.groupBy("uri").agg(
        F.sum("n").alias("n"), F.count("*").alias("versions"), F.max("last").alias("last")
    )
    deleted = F.col("last.operation") == "delete"
    rows, kept = F.sum("n"), F.count("*")
    return per_uri.agg(
        rows.alias("rows_before"),
        F.count_if(~deleted).alias("rows_after"),
        (rows - F.sum("versions")).alias("redelivered_duplicates"),
        (F.sum("versions") - kept).alias("lifecycle_collapses"),
        F.count_if(deleted).alias("tombstones_dropped"),
        F.coalesce(F.try_divide(F.count_if(deleted) * 100.0, rows), F.lit(0.0)).alias("tombstone_pct"),
    )


def with_path(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.col("_metadata.file_path"))


def duplicate_mask(rows: DataFrame) -> DataFrame:
    """(uri, path) pairs to delete: every file of a uri but its first, and the first too
    when it holds the uri more than once.

    The second part removes all copies there. It is harmless only while files never repeat
    a uri; `keep_one` is the safe form.
    """
    copies = rows.groupBy("uri", "path").agg(F.count("*").alias("n"))
    first = copies.groupBy("uri").agg(F.min("path").alias("first_path"))
    joined = copies.join(first, "uri")
    return joined.filter((F.col("path") != F.col("first_path")) | (F.col("n") > 1)).select("uri", "path")


def mask_duplicates(rows: DataFrame) -> DataFrame:
    return rows.join(duplicate_mask(rows), ["uri", "path"], "left_anti")


def keep_one(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per uri, from its first file."""
    from starling.functions.keep import keep_first

    return keep_first(rows, ["uri"], ["path", *order])


def recent_days(as_of: Column, days: int) -> Column:
    return (F.col(DAY) >= F.date_sub(as_of, days)) & (F.col(DAY) < as_of)


def days_to_compact(
    table: DataFrame, as_of: Column, days: int = C.COMPACT_DAYS,
    target_bytes: int = C.TARGET_FILE_BYTES, min_small: int = C.MIN_SMALL_FILES,
) -> DataFrame:
    """(day, small_files, bytes) of the days in [as_of − days, as_of) worth compacting."""
    files = table.filter(recent_days(as_of, days)).select(
        DAY, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).groupBy(DAY, "path", "size").agg(F.count("*").alias("n"))
    small = F.count_if(F.col("size") < target_bytes)
    per_day = files.groupBy(DAY).agg(small.alias("small_files"), F.sum("size").alias("bytes"))
    return per_day.filter(F.col("small_files") >= min_small)


FLUSH = "flush_id"


#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _on_days(days: Sequence[str]) -> Column:
    on = F.col(DAY).isin(*[F.lit(d).cast("date") for d in days if d != NO_DAY])
    return F.coalesce(on, F.lit(NO_DAY in days))


def _day_text() -> Column:
    return F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))


def _days_of(table: DataFrame) -> list[str]:
    """The calendar days of a table."""
    return [r[0] for r in table.select(DAY).distinct().select(_day_text().alias("day")).orderBy("day").collect()]


def has_flushes(table: DataFrame) -> bool:
    """Is it a table of the ingest stream, partitioned by day and flush?"""
    return FLUSH in table.columns


def mergeable(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    """Rows whose flush is logged, or already merged; all rows of other tables."""
    if not has_flushes(table):
        return table
    log = f"{path.rstrip('/').rsplit('/', 1)[0]}/_flush_log"
    if not path_exists(spark, log):
        return table.filter(F.col(FLUSH).startswith("merged-"))
    logged = spark.read.parquet(log).select(FLUSH).distinct()
    merged = table.filter(F.col(FLUSH).startswith("merged-"))
    return merged.unionByName(table.join(logged, FLUSH, "left_semi").select(*table.columns))


#: Steps of a replacement after which a stop is told apart in tests.
STEPS = ("staged", "retired", "committed", "removed", "moved")


def _no_stop(step: str) -> None:
    pass


def recover(spark: SparkSession, path: str) -> None:
    """Finish replacements that were committed, and drop those that were not.

    Every upkeep job starts with this; a table has one such job at a time.
    """
    folder = f"{path.rstrip('/')}/{SWAPS}"
    for name in list_names(spark, folder):
        swap = f"{folder}/{name}"
        if path_exists(spark, f"{swap}/{COMMITTED}"):
            _carry_out(spark, path, swap)
        else:
            remove_path(spark, swap)


def _carry_out(spark: SparkSession, path: str, swap: str, after: Callable[[str], None] = _no_stop) -> None:
    """Remove what a committed replacement retires and move its files in; may be done again."""
    root = path.rstrip("/")
    for row in retired_parts(spark, swap).toLocalIterator():
        remove_path(spark, f"{root}/{row['path']}")
    after("removed")
    for day in list_names(spark, f"{swap}/rows"):
        if day.startswith(f"{DAY}="):
            make_folder(spark, f"{root}/{day}")
            for name in list_names(spark, f"{swap}/rows/{day}"):
                if not name.startswith((".", "_")):
                    move_path(spark, f"{swap}/rows/{day}/{name}", f"{root}/{day}/{name}")
    after("moved")
    remove_path(spark, swap)


def _replace_days(
    spark: SparkSession, path: str, rows: DataFrame, days: Sequence[str], read: DataFrame, source: DataFrame,
    target_bytes: int = C.TARGET_FILE_BYTES, after: Callable[[str], None] = _no_stop, share: float = 1.0,
) -> None:
    """Write `rows` over what was `read` of the given days of `source`, all days in one commit.

    The new files are written to a hidden folder of the table, beside a list of what they replace:
    the flushes read, in a table of the ingest stream, or the files read, in any other; a flush or
    file that came since stays. An empty marker then commits both. Before it, the table is as it was;
    from it on, `read_table` gives the new rows, whatever has been removed or moved so far, and
    `recover` carries out the rest. Merged rows become one new flush of their day, and only
    flushes with a log are merged (`mergeable`), so a replayed batch never finds its rows merged
    already. The number of files follows from the target size and the bytes a day has now, of which
    about `share` stay, so rows are shuffled and written once.
    """
    name = uuid.uuid4().hex[:12]
    swap = f"{path.rstrip('/')}/{SWAPS}/{name}"
    flushed = has_flushes(rows)
    # One number per calendar day.
    sizes = {d: folder_bytes(spark, f"{path.rstrip('/')}/{DAY}={d}") for d in days}
    files = {d: max(1, math.ceil(size * share / target_bytes)) for d, size in sizes.items() if size}
    if files:
        count = F.create_map(*[F.lit(x) for item in files.items() for x in item])[_day_text()]
        part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != DAY]), count)
        spread = rows.withColumn("_part", part).repartition(sum(files.values()), DAY, "_part").drop("_part")
        if flushed:
            spread = spread.withColumn(FLUSH, F.lit(f"merged-{name}"))
        writer = spread.write.partitionBy(DAY, *([FLUSH] if flushed else []))
        writer.option("compression", C.COMPRESSION).parquet(f"{swap}/rows")
    after("staged")
    day = F.concat(F.lit(f"{DAY}="), _day_text(), F.lit("/"))
    if flushed:
        parts = read.filter(_on_days(days)).select(F.concat(day, F.lit(f"{FLUSH}="), F.col(FLUSH)).alias("path"))
    else:
        file = F.substring_index(F.col("_metadata.file_path"), "/", -1)
        parts = source.filter(_on_days(days)).select(F.concat(day, file).alias("path"))
    parts.distinct().write.parquet(f"{swap}/retired")
    after("retired")
    create_marker(spark, f"{swap}/{COMMITTED}")
    after("committed")
    _carry_out(spark, path, swap, after)


def compact_days(
    spark: SparkSession, path: str, as_of: str, days: int = C.COMPACT_DAYS, min_small: int = C.MIN_SMALL_FILES,
    target_bytes: int = C.TARGET_FILE_BYTES, after: Callable[[str], None] = _no_stop,
) -> list[str]:
    """Rewrite recent days that consist of many small files; returns those days.

    A day is chosen only if it comes out in fewer files than it has small ones.
    """
    recover(spark, path)
    source = spark.read.parquet(path)
    table = mergeable(spark, path, source)
    today = F.lit(as_of).cast("date")
    chosen = days_to_compact(source, today, days, target_bytes, min_small)
    chosen = chosen.filter(F.col("small_files") > F.ceil(F.col("bytes") / target_bytes))
    # At most `days` values: the list of calendar days to rewrite.
    picked = [str(r[0]) for r in chosen.select(DAY).orderBy(DAY).limit(days).collect()]
    if picked:
        _replace_days(spark, path, table.filter(_on_days(picked)), picked, table, source, target_bytes, after)
    return picked


def month_ranges(spark: SparkSession, start: str, as_of: str) -> DataFrame:
    """(month_start, month_end) half-open, from the month of start to that of as_of."""
    months = F.sequence(
        F.trunc(F.lit(start).cast("date"), "month"), F.trunc(F.lit(as_of).cast("date"), "month"),
        F.expr("INTERVAL 1 MONTH"),
    )
    first = spark.range(1).select(F.explode(months).alias("month_start"))
    return first.withColumn("month_end", F.add_months("month_start", 1))


def compact_full(spark: SparkSession, path: str, start: str, as_of: str) -> DataFrame:
    """Compact month by month, each in one commit; files and bytes of every month before and after."""
    recover(spark, path)
    report = []
    for month in month_ranges(spark, start, as_of).orderBy("month_start").toLocalIterator():
        source = spark.read.parquet(path)
        table = mergeable(spark, path, source)
        inside = (F.col(DAY) >= F.lit(month[0])) & (F.col(DAY) < F.lit(month[1]))
        days = _days_of(table.filter(inside))
        if days:
            before = file_stats(source.filter(inside)).first()
            _replace_days(spark, path, table.filter(inside), days, table, source)
            stats = file_stats(spark.read.parquet(path).filter(inside)).first()
            report.append(
                (month[0], len(days), before["n_rows"], stats["n_rows"], before["file_count"], stats["file_count"],
                 before["total_bytes"], stats["total_bytes"])
            )
    return spark.createDataFrame(
        report,
        "month_start date, days int, rows_before long, rows_after long, files_before long, files_after long, "
        "bytes_before long, bytes_after long",
    )


def mask_table(spark: SparkSession, path: str, as_of: str, days: int = C.MASK_DAYS, safe: bool = True) -> list[str]:
    """Remove cross-file duplicates of recent days; returns the days rewritten.

    Only days that hold a masked row are read again and replaced. The day predicate stands
    on both the duplicate search and the rewrite, so older days are never read.
    """
    recover(spark, path)
    source = spark.read.parquet(path)
    table = mergeable(spark, path, with_path(source))
    recent = table.filter(recent_days(F.lit(as_of).cast("date"), days))
    # Narrow columns tell which uris repeat across files; whole rows are read for their days only.
    narrow = recent.select("uri", "path", DAY)
    mask = duplicate_mask(narrow)
    touched = narrow.join(mask, ["uri", "path"], "left_semi").select(DAY).distinct()
    picked = [str(r[0]) for r in touched.orderBy(DAY).collect()]
    if picked:
        on_days = _on_days(picked)
        if safe:
            twice = narrow.groupBy("uri").agg(F.count("*").alias("_n")).filter("_n > 1").select("uri")
            single = recent.filter(on_days).join(twice, "uri", "left_anti")
            repeated = keep_one(recent.join(twice, "uri", "left_semi"), ["ingested_at"]).filter(on_days)
            rows = single.unionByName(repeated.select(*single.columns))
        else:
            rows = mask_duplicates(recent).filter(on_days)
        _replace_days(spark, path, rows.select(*[c for c in table.columns if c != "path"]), picked, table, source)
    return picked


def compact_and_collapse(
    spark: SparkSession, path: str, target: str | None = None, after: Callable[[str], None] = _no_stop
) -> dict[str, int]:
    """Whole event log: collapse, drop tombstones, write anew; counts, files and bytes before and after.

    Over the table itself in one commit, or to `target` if that is given.
    """
    recover(spark, path)
    source = spark.read.parquet(path)
    table = mergeable(spark, path, source)
    if table.isEmpty():
        return {"skipped": 1}
    before = file_stats(source).first().asDict()
    stats = collapse_stats(table).first().asDict()
    final = drop_tombstones(collapse_to_latest(table))
    if target is None:
        share = stats["rows_after"] / max(stats["rows_before"] or 0, 1)
        _replace_days(spark, path, final, _days_of(table), table, source, after=after, share=share)
    else:
        write_day_partitioned(final, target, mode="overwrite")
    rows = file_stats(spark.read.schema(table.schema).parquet(target or path)).first().asDict()
    return {
        **stats,
        "file_count_before": before["file_count"], "file_count_after": rows["file_count"],
        "bytes_before": before["total_bytes"], "bytes_after": rows["total_bytes"],
    }


def run_all(spark: SparkSession, jobs: dict[str, Callable[[], object]]) -> DataFrame:
    """Run one job per table, all of them, and report (table_name, failed, error)."""
    rows = []
    for name, job in jobs.items():
        try:
            job()
            rows.append((name, False, None))
        except Exception as error:  # every table gets its turn
            rows.append((name, True, str(error)))
    return spark.createDataFrame(rows, "table_name string, failed boolean, error string")


def require_success(report: DataFrame) -> None:
    failed = [r["table_name"] for r in report.filter("failed").collect()]
    if failed:
        raise RuntimeError(f"maintenance failed for: {', '.join(failed)}")
