"""A landing zone in numbered batches: one folder per batch and non-empty type, a manifest last.

    root/_plan/attempt=…            which user is in which batch; never changes once written
    root/rows/attempt=…/batch_id=…/record_type=…
    root/_manifest/attempt=…        the attempted users of the batches that attempt finished

An attempt's rows count from the moment its manifest is whole, so a job that stops at any point
leaves finished batches or none, never half of one. The next run takes up what is open under
a new attempt name; files of the stopped one are orphans (`operators/expiry.py`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starling import constants as C
from starling.operators.ledger import landing_batches, landing_manifest
from starling.sources.tables import list_names, many_folders, name_starting, path_exists

STEPS = ("plan", "rows", "manifest")
ROWS, PLAN, MANIFEST = "rows", "_plan", "_manifest"
#: Batches that are dealt to one part of the shuffle before the write.
PART_BATCHES = 32
PLAN_SCHEMA = "did string, error string, batch_id long"
MANIFEST_SCHEMA = (
    "did string, batch_id long, error string, " + ", ".join(f"{t} long" for t in C.RECORD_TYPES) + ", run_id string"
)


def _attempt() -> str:
    """A name no other attempt has; the letter in front keeps it from being read as a number."""
    return f"a{uuid.uuid4().hex}"


def _finished(spark: SparkSession, folder: str) -> list[str]:
    """Attempts below a folder that were written to their end: one per commit."""
    return [n for n in list_names(spark, folder) if path_exists(spark, f"{folder}/{n}/_SUCCESS")]


def _whole(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of the finished attempts below a folder."""
    paths = [f"{folder}/{n}" for n in _finished(spark, folder)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every attempted user of the finished batches: batch, error, rows per type and run."""
    return _whole(spark, f"{root.rstrip('/')}/{MANIFEST}", MANIFEST_SCHEMA)


def _below(spark: SparkSession, schema: str | StructType, folders: list[str]) -> DataFrame:
    """`schema` of all rows below folders, and their file (`path`).

    The values of folders are not discovered, as that takes Spark the square of the number of folders on the
    driver. A filter on what `_with_folders` gives still leaves out files before they are opened.
    """
    with many_folders(spark):
        rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
    return rows.withColumn("path", F.col("_metadata.file_path"))


def _with_folders(rows: DataFrame) -> DataFrame:
    """Add the batch_id and record_type that the folders of `path` say."""

    def value(name: str) -> Column:
        return F.substring_index(F.substring_index("path", f"/{name}=", -1), "/", 1)

    # Escaped once as a folder's name, once more as a URI.
    kind = value("record_type")
    plain = kind
    for _ in range(2):
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    named = F.nullif(F.when(kind.contains("%"), plain).otherwise(kind), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return rows.withColumns({"batch_id": value("batch_id").cast("bigint"), "record_type": named})


def file_rows(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """(path, n_rows, batch_id, record_type) of each file of the attempts that `files` (path) are of, finished or not.

    Only the names of the attempts pass through the driver.
    """
    named = files.select(F.regexp_extract("path", "/attempt=([^/]+)/batch_id=[^/]+/[^/]+/[^/]+$", 1).alias("attempt"))
    attempts = [r["attempt"] for r in named.distinct().collect() if r["attempt"]]
    if not attempts:
        return spark.createDataFrame([], "path string, n_rows long, batch_id long, record_type string")
    rows = _below(spark, "did string", [f"{root.rstrip('/')}/{ROWS}/attempt={name}" for name in attempts])
    return _with_folders(rows.groupBy("path").agg(F.count("*").alias("n_rows")))


def landed(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the finished batches with their file (`path`); none at all is an error.

    The folders of stopped attempts are not opened, so they may be removed meanwhile.
    """
    root = root.rstrip("/")
    folders = [f"{root}/{ROWS}/{n}" for n in _finished(spark, f"{root}/{MANIFEST}")]
    # Users without rows leave an attempt without batch folders.
    some = {f: name_starting(spark, f, "batch_id=") for f in folders}
    paths = [f for f, batch in some.items() if batch]
    if not paths:
        raise FileNotFoundError(f"no rows landed under {root}")
    # The columns are those of one batch.
    columns = [c for c in spark.read.parquet(f"{paths[0]}/{some[paths[0]]}").schema if c.name != "record_type"]
    rows = _with_folders(_below(spark, StructType(columns), paths))
    return rows.select(*[c.name for c in columns], "batch_id", "record_type", "path")


def land(
    users: DataFrame,
    records: DataFrame,
    root: str,
    run_id: str,
    size: int,
    per_commit: int | None = None,
    after: Callable[[str], None] = lambda step: None,
) -> dict[str, int]:
    """Write the batches that are not finished; (batches planned, finished before, written now).

    `users`: did, error (one row each); `records`: did, record_type and any other columns. Users
    are numbered by did when first seen and keep their batch; later ones follow in new batches, so a
    finished batch never changes. `per_commit` batches are made final at a time (all at once when
    None): what a stop can cost, against one scan of `records` for each. `after` is told each step.
    """
    spark = users.sparkSession
    root = root.rstrip("/")
    plan = _whole(spark, f"{root}/{PLAN}", PLAN_SCHEMA)
    fresh = users.select("did", "error").join(plan.select("did"), "did", "left_anti")
    if not fresh.isEmpty():
        last = plan.agg(F.coalesce(F.max("batch_id"), F.lit(0).cast("bigint"))).scalar()
        numbered = landing_batches(fresh, size, "did").withColumn("batch_id", F.col("batch_id") + last)
        numbered.select("did", "error", "batch_id").write.parquet(f"{root}/{PLAN}/attempt={_attempt()}")
    after("plan")
    plan = _whole(spark, f"{root}/{PLAN}", PLAN_SCHEMA)
    done = manifest(spark, root).select("batch_id").distinct()
    counts = plan.select("batch_id").distinct().join(done.withColumn("_done", F.lit(True)), "batch_id", "left").agg(
        F.count("*").alias("batches"), F.count("_done").alias("finished"), F.max("batch_id").alias("last")
    ).first()
    report = {"batches": counts["batches"], "finished": counts["finished"], "written": 0}
    if report["batches"] == report["finished"]:
        return report
    step = per_commit or counts["last"]
    for start in range(1, counts["last"] + 1, step):
        report["written"] += _land_some(plan, done, records, root, run_id, start, start + step - 1, after)
    return report


def _land_some(
    plan: DataFrame, done: DataFrame, records: DataFrame, root: str, run_id: str, first: int, last: int,
    after: Callable[[str], None],
) -> int:
    """Write and commit the open batches among `first` to `last`; how many there were."""
    spark = plan.sparkSession
    todo = plan.filter(F.col("batch_id").between(first, last)).join(done, "batch_id", "left_anti")
    count = todo.agg(F.count_distinct("batch_id")).first()[0]
    if not count:
        return 0
    attempt = _attempt()
    stamped = records.drop("run_id").join(todo.select("did", "batch_id"), "did").withColumn("run_id", F.lit(run_id))
    written = f"{root}/{ROWS}/attempt={attempt}"
    # A batch with many rows is split over tasks and files, small ones share a task. A part is split when it is large,
    # and each piece then has a file of each of its folders, so parts are not to be large by their number of batches.
    # A task has whole batches, so the commit, one move after another, moves a folder per batch.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // PART_BATCHES))
    writer = stamped.hint("rebalance", parts, "batch_id").write.partitionBy("batch_id", "record_type")
    with many_folders(spark):
        writer.option("compression", C.COMPRESSION).parquet(written)
    after("rows")
    # Counted from the files, so the manifest cannot say more than was written.
    there = _with_folders(_below(spark, "did string", [written])).select("did", "record_type")
    listed = landing_manifest(todo.select("did", "batch_id", "error"), there).withColumn("run_id", F.lit(run_id))
    listed.write.parquet(f"{root}/{MANIFEST}/attempt={attempt}")
    after("manifest")
    return count
