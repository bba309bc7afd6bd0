"""Run metadata: task ledgers, gates, lineage, budgets and clean-up plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import chunk_index, running_total, top_n


def task_ledger_status(tasks: DataFrame, run: str) -> DataFrame:
    """Counts by status per run; complete when every task is completed or skipped."""
    statuses = ("completed", "skipped", "failed", "in_progress", "pending")
    return tasks.groupBy(run).agg(
        F.count("*").alias("tasks"),
        *[F.count_if(F.col("status") == s).alias(s) for s in statuses],
        F.every(F.col("status").isin("completed", "skipped")).alias("is_complete"),
    )


def readiness_gate(runs: DataFrame, metadata: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per stage: every run has metadata saying it was uploaded.

    `runs`: group + run_dir; `metadata`: group + run_dir + uploaded, one row per run. A stage
    without runs has no row here, and is ready.
    """
    joined = runs.join(metadata, [*group, "run_dir"], "left")
    ready = F.every(F.coalesce("uploaded", F.lit(False)))
    return joined.groupBy(*group).agg(ready.alias("ready"), F.count("*").alias("runs"))


def cleanup_allowed(runs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per dataset: all of its stages pass the gate."""
    stages = readiness_gate(runs, metadata, ["dataset_id", "stage"])
    return stages.groupBy("dataset_id").agg(F.every("ready").alias("cleanup_allowed"))


def latest_run(runs: DataFrame, group: Sequence[str]) -> DataFrame:
    """Newest run per group: run names sort as time does."""
    return runs.groupBy(*group).agg(F.max("run_dir").alias("run_dir"))


def run_lineage(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Per key: source runs (sorted), the last of them, input and output row counts.

    Lists hold run names, of which a dataset has few; rows are only counted.
    """
    runs = inputs.groupBy(key, "run_dir").agg(F.count("*").alias("n"))
    sources = runs.groupBy(key).agg(
        F.sort_array(F.collect_list("run_dir")).alias("source_runs"),
        F.max("run_dir").alias("last_source_run"),
        F.sum("n").alias("input_rows"),
    )
    kept = outputs.groupBy(key).agg(F.count("*").alias("output_rows"))
    return sources.join(kept, key, "left").fillna({"output_rows": 0})


def is_up_to_date(curated: DataFrame, current: DataFrame) -> DataFrame:
    """Per dataset: the newest curated run is uploaded, from the same runs and rules, and there.

    `curated`: dataset_id, run_dir, uploaded, source_runs, rules_hash, file_exists;
    `current`: dataset_id, source_runs, rules_hash.
    """
    newest = curated.groupBy("dataset_id").agg(
        F.max_by(F.struct("uploaded", "source_runs", "rules_hash", "file_exists"), "run_dir").alias("last")
    )
    joined = current.join(newest, "dataset_id", "left")
    same = (
        F.col("last.uploaded")
        & (F.col("last.source_runs") == F.col("source_runs"))
        & (F.col("last.rules_hash") == F.col("rules_hash"))
        & F.col("last.file_exists")
    )
    return joined.select("dataset_id", F.coalesce(same, F.lit(False)).alias("up_to_date"))


def pending_uploads(metadata: DataFrame) -> DataFrame:
    """Runs that finished and were not published."""
    return metadata.filter((F.col("status") == "completed") & ~F.coalesce("uploaded", F.lit(False)))


def resume_run(metadata: DataFrame, group: Sequence[str]) -> DataFrame:
    """Newest run per group that is not uploaded, to continue as in_progress."""
    open_runs = metadata.filter(~F.coalesce("uploaded", F.lit(False)))
    newest = open_runs.groupBy(*group).agg(F.max("run_dir").alias("run_dir"))
    return newest.withColumn("status", F.lit("in_progress"))


def row_budget(
    rows: DataFrame, tasks: DataFrame, per_task: int, max_rows: int | None, order: Sequence[Column],
    already: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, task report) under a cap per task and a cap on the whole run.

    `tasks`: (task_id, position), run in that order; `rows` carry task_id. A task may take
    what is left of the run's budget; tasks that find it spent are 'skipped'. `already` is
    the row count the run starts from, historical rows included.
    """
    sizes = rows.groupBy("task_id").agg(F.least(F.count("*"), F.lit(per_task)).alias("wanted"))
    planned = tasks.join(sizes, "task_id", "left").fillna({"wanted": 0})
    summed = running_total(planned, [], ["position", "task_id"], F.col("wanted"), "_upto")
    before = F.col("_upto") - F.col("wanted") + F.lit(already)
    if max_rows is None:
        allowed, status = F.col("wanted"), F.lit("completed")
    else:
        left = F.greatest(F.lit(max_rows) - before, F.lit(0))
        allowed = F.least(F.col("wanted"), left)
        status = F.when(before >= max_rows, "skipped").otherwise("completed")
    report = summed.select(
        "task_id", "position", "wanted", allowed.cast("bigint").alias("allowed"), status.alias("status")
    )
    ranked = top_n(rows, ["task_id"], order, per_task, "_rank")
    kept = ranked.join(report.select("task_id", "allowed"), "task_id")
    return kept.filter(F.col("_rank") <= F.col("allowed")).drop("_rank", "allowed"), report


def landing_batches(users: DataFrame, size: int, order: str) -> DataFrame:
    """Users with `batch_id` 1, 2, …: consecutive groups of `size`."""
    chunked = chunk_index(users, size, [order])
    return chunked.withColumn("batch_id", (F.col("chunk") + 1).cast("bigint")).drop("chunk")


def landing_manifest(users: DataFrame, records: DataFrame) -> DataFrame:
    """One row per attempted user: batch, error and rows per type, zeros included.

    `users`: did, batch_id, error; `records`: did, record_type.
    """
    from starling.operators.cohort import record_counts

    counted = record_counts(records, "did", users.select("did", "error"))
    return users.select("did", "batch_id").join(counted, "did")


def collection_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per keyword or subreddit, and in all (key NULL)."""
    return rows.rollup(key).agg(F.count("*").alias("n_rows"))


def runs_to_expire(runs: DataFrame, group: Sequence[str]) -> DataFrame:
    """All runs but the newest of each group."""
    newest = latest_run(runs, group)
    return runs.join(newest, [*group, "run_dir"], "left_anti")


def expire_report(runs: DataFrame, group: Sequence[str]) -> DataFrame:
    return runs.groupBy(*group).agg(
        F.count("*").alias("runs_before"),
        F.lit(1).cast("bigint").alias("runs_after"),
        (F.count("*") - 1).alias("expired"),
        F.max("run_dir").alias("kept_run"),
    )


def orphan_files(listing: DataFrame, referenced: DataFrame) -> DataFrame:
    """Listed files that nothing refers to."""
    return listing.join(referenced.select("path"), "path", "left_anti")


def orphan_summary(listing: DataFrame, referenced: DataFrame) -> DataFrame:
    orphans = orphan_files(listing, referenced)
    size = F.coalesce(F.sum("size"), F.lit(0).cast("bigint"))
    return orphans.agg(F.count("*").alias("orphans"), size.alias("orphan_bytes"))
