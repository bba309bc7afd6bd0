"""Removal of old runs and of files that nothing refers to, from listings of the storage.

Listings, choices and reports are tables. Only the names of what goes pass through the driver, one
after another, as it alone speaks to the file system; a removal that was stopped is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.operators.ledger import expire_report, orphan_files, runs_to_expire
from starling.session import durable
from starling.sources.tables import file_listing, remove_files, remove_path


def listed_runs(spark: SparkSession, root: str, group: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Runs on storage below root/group=…/run_dir=…: group, run_dir, files, bytes, folder."""
    files = file_listing(spark, root)
    folder = F.regexp_extract("path", "^(.*/run_dir=[^/]+)/", 1)
    named = [_partition_value(name).alias(name) for name in (*group, "run_dir")]
    inside = files.select(*named, folder.alias("folder"), "bytes").filter(F.col("folder") != "")
    return inside.groupBy(*group, "run_dir", "folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def _partition_value(name: str) -> Column:
    """Value of a name=value folder in a URI: escaped once as a folder's name, once more as a URI."""
    value = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return value


def expire_runs(
    spark: SparkSession, root: str, group: Sequence[str] = ("dataset_id",), delete: bool = False
) -> DataFrame:
    """Per group: runs before and after, how many go, the run that stays, files and bytes of what goes.

    All runs but the newest of each group go, and are removed only if `delete`; run names sort as
    time does. Files outside a run folder are not looked at.
    """
    runs = durable(listed_runs(spark, root, group))
    old = runs_to_expire(runs, group)
    size = old.groupBy(*group).agg(F.sum("files").alias("expired_files"), F.sum("bytes").alias("expired_bytes"))
    report = durable(expire_report(runs, group).join(size, list(group), "left").fillna(0, ["expired_files", "expired_bytes"]))
    if delete:
        for row in old.select("folder").toLocalIterator():
            remove_path(spark, row["folder"], encoded=True)
    return report


def expire_orphans(
    spark: SparkSession, root: str, referenced: DataFrame, older_than: dt.datetime, delete: bool = False
) -> DataFrame:
    """(path, bytes, modified) of the files below a folder that nothing refers to; removed only if `delete`.

    `referenced` has `path` as a scan's `_metadata.file_path` gives it. Files modified at or after
    `older_than` stay: a job that still runs may refer to them later.
    """
    files = file_listing(spark, root).filter(F.col("modified") < F.lit(older_than))
    orphans = durable(orphan_files(files, referenced.select("path").distinct()))
    if delete:
        remove_files(spark, (row["path"] for row in orphans.select("path").toLocalIterator()))
    return orphans
