"""Day-partitioned Parquet tables, catalog registration, dead letters and exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import batched
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starling import constants as C
from starling.sources.envelopes import ROW_SCHEMAS

DAY = "created_at_day"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def _file_system(spark: SparkSession, path: str, encoded: bool = False):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def remove_path(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Remove a folder and all in it; `encoded` paths are URIs, as scans give them."""
    fs, hadoop_path = _file_system(spark, path, encoded)
    fs.delete(hadoop_path, True)


def file_remover(spark: SparkSession) -> Callable[[str], None]:
    """Removes the file of a URI, never a folder with something in it.

    Classes and file systems are looked up once: a lookup costs several calls to the JVM, a removal three.
    """
    jvm = spark.sparkContext._jvm
    path_of, uri_of, systems = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI, {}

    def remove(uri: str) -> None:
        store = urlsplit(uri)[:2]
        if store not in systems:
            systems[store] = _file_system(spark, uri, encoded=True)[0]
        systems[store].delete(path_of(uri_of(uri)), False)

    return remove


#: Removals that the driver has under way at a time, and the names it holds for them.
REMOVERS, NAMES = 16, 4096


def remove_files(spark: SparkSession, uris: Iterable[str]) -> None:
    """Remove files, several at a time; the first failure is raised."""
    remove = file_remover(spark)
    with ThreadPoolExecutor(REMOVERS) as pool:
        for names in batched(uris, NAMES):
            for _ in pool.map(remove, names):
                pass


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; a target that is there already is an error."""
    fs, hadoop_path = _file_system(spark, source)
    if not fs.rename(hadoop_path, _file_system(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none when it is missing. For folders of bounded size."""
    fs, hadoop_path = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def name_starting(spark: SparkSession, path: str, prefix: str) -> str | None:
    """Some name inside a folder that starts so; for folders of any size, as it stops at the first."""
    fs, hadoop_path = _file_system(spark, path)
    entries = fs.listStatusIterator(hadoop_path)
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if name.startswith(prefix):
            return name
    return None


#: Tasks per core that list the folders of a table, or write them.
FOLDER_TASKS = 4
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
PARTS_CONF = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[int]:
    """Tables of many folders opened or written inside take a few tasks per core, as the folders are the work.

    Spark lists by one task per folder, up to 10,000, and joins small parts of a shuffle by their bytes
    down to one task per core, the last of which may start when the others end.
    """
    tasks = FOLDER_TASKS * spark.sparkContext.defaultParallelism
    before = {name: spark.conf.get(name, None) for name in (LISTING_CONF, PARTS_CONF)}
    for name, value in before.items():
        if value is None:
            spark.conf.set(name, str(tasks))
    try:
        yield tasks
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, modified) of the files below a folder, listed by Spark; none when it is missing.

    Hidden files are left out. No file is opened, so a few tasks per core take them all.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, bytes long, modified timestamp")
    with many_folders(spark) as tasks:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.coalesce(tasks).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file, there as a whole or not at all; one that is there already is an error."""
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path, False).close()


def check_columns(df: DataFrame, expected: StructType) -> None:
    """The column set must be the table's: nothing missing, nothing extra."""
    missing = set(expected.fieldNames()) - set(df.columns)
    extra = set(df.columns) - set(expected.fieldNames())
    if missing or extra:
        raise ValueError(f"columns differ from the table: missing {sorted(missing)}, extra {sorted(extra)}")


def append_records(df: DataFrame, path: str, required: Sequence[str] = ()) -> None:
    """Append to a Parquet table; only new files are written.

    `required` columns must not be NULL: a violating row fails the job.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        schema = spark.read.parquet(path).schema
        check_columns(df, schema)
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    for column in required:
        message = F.lit(f"NULL in required column {column}")
        checked = F.when(F.col(column).isNull(), F.raise_error(message)).otherwise(F.col(column))
        df = df.withColumn(column, checked)
    df.write.mode("append").option("compression", C.COMPRESSION).parquet(path)


def with_day(df: DataFrame, created_at: str = "created_at") -> DataFrame:
    return df.withColumn(DAY, F.to_date(created_at))


def balanced_by_day(df: DataFrame) -> DataFrame:
    """Rows of a day together, a large day split over several tasks.

    The rebalance hint lets AQE merge small days and split a day that holds much of the
    table, so neither tiny files nor one giant task result.
    """
    return df.hint("rebalance", DAY)


def write_day_partitioned(df: DataFrame, path: str, mode: str = "append", extra: Sequence[str] = ()) -> None:
    rows = df if DAY in df.columns else with_day(df)
    writer = balanced_by_day(rows).write.mode(mode).partitionBy(DAY, *extra)
    if mode == "overwrite":
        # Only the partitions present in `df` are replaced.
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("compression", C.COMPRESSION).parquet(path)


#: Folder of a table with its replacements under way, hidden from plain readers.
SWAPS = "_swap"
COMMITTED = "committed"


def pending_swaps(spark: SparkSession, path: str) -> list[str]:
    """Replacements that are decided but not yet carried out in full."""
    folder = f"{path.rstrip('/')}/{SWAPS}"
    return [f"{folder}/{n}" for n in list_names(spark, folder) if path_exists(spark, f"{folder}/{n}/{COMMITTED}")]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a day-partitioned table as of its last commit.

    A replacement (`operators/maintain.py`) that stopped half-way counts as done from its commit
    on: what it retires is left out, and what it has not moved yet is read where it lies.
    """
    swaps = pending_swaps(spark, path)
    if not swaps:
        return spark.read.parquet(path)
    staged = [spark.read.parquet(f"{swap}/rows") for swap in swaps if any_rows(spark, swap)]
    base = spark.read.schema(staged[0].schema).parquet(path) if staged else spark.read.parquet(path)
    columns = base.columns
    # The folder or file right below the day tells what a row belongs to.
    base = base.withColumn("_part", F.regexp_extract(F.col("_metadata.file_path"), f"({DAY}=[^/]+/[^/]+)", 1))
    for swap in swaps:
        base = base.join(retired_parts(spark, swap).withColumnRenamed("path", "_part"), "_part", "left_anti")
    out = base.select(*columns)
    for rows in staged:
        out = out.unionByName(rows.select(*columns))
    return out


def retired_parts(spark: SparkSession, swap: str) -> DataFrame:
    return spark.read.schema("path string").parquet(f"{swap}/retired")


def any_rows(spark: SparkSession, swap: str) -> bool:
    """Does the replacement hold files that are not moved yet?"""
    rows = f"{swap}/rows"
    days = [n for n in list_names(spark, rows) if n.startswith(f"{DAY}=")]
    return any(not n.startswith((".", "_")) for day in days for n in list_names(spark, f"{rows}/{day}"))


# -- catalog --------------------------------------------------------------------


def create_tables(
    spark: SparkSession, database: str, record_types: Sequence[str] = C.RECORD_TYPES, root: str | None = None
) -> dict[str, bool]:
    """Create missing stream tables; (name -> was created)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    report = {}
    for name in record_types:
        exists = spark.catalog.tableExists(f"{database}.{name}")
        location = f"LOCATION '{root}/{name}'" if root else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ROW_SCHEMAS[name]}, {DAY} date) "
            f"USING parquet PARTITIONED BY ({DAY}) {location}"
        )
        report[name] = not exists
    return report


def require_tables(spark: SparkSession, database: str, names: Sequence[str]) -> None:
    """All missing names in one error."""
    missing = [n for n in names if not spark.catalog.tableExists(f"{database}.{n}")]
    if missing:
        raise LookupError(f"missing tables in {database}: {', '.join(missing)}")


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_partition(spark: SparkSession, table: str, values: Mapping[str, str], location: str) -> None:
    spec = ", ".join(f"{name}={quote(value)}" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {quote(location)}")


_BATCH_POST = (
    "uri string, url string, author_handle string, text string, created_at string, "
    "like_count bigint, repost_count bigint, reply_count bigint, quote_count bigint"
)
_FEATURE = "uri string, label_timestamp string, "
# Table -> (columns, partition columns).
BATCH_TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_posts": (_BATCH_POST, ("platform", "dataset_id", "run_dir")),
    "preprocessed_posts": (_BATCH_POST, ("platform", "dataset_id", "run_dir")),
    "curated_posts": (
        _BATCH_POST + ", is_political boolean, is_likely_spam boolean, is_self_contained boolean, "
        "is_structurally_complete boolean, toxicity_prob double, toxicity_tier string, "
        "news_or_opinion_category string, political_stance string",
        ("platform", "dataset_id", "run_dir"),
    ),
    "feature_is_political": (_FEATURE + "is_political boolean", ("platform", "dataset_id")),
    "feature_is_likely_spam": (_FEATURE + "is_likely_spam boolean", ("platform", "dataset_id")),
    "feature_is_self_contained": (_FEATURE + "is_self_contained boolean", ("platform", "dataset_id")),
    "feature_is_structurally_complete": (
        _FEATURE + "is_structurally_complete boolean", ("platform", "dataset_id"),
    ),
    "feature_is_news_or_opinion": (_FEATURE + "category string", ("platform", "dataset_id")),
    "feature_political_stance": (_FEATURE + "political_stance string", ("platform", "dataset_id")),
    "feature_is_toxic_tiered": (
        _FEATURE + "toxicity_prob double, toxicity_tier string", ("platform", "dataset_id"),
    ),
}


def create_batch_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """External tables of the batch stages over Hive-style Parquet folders."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, parts) in BATCH_TABLES.items():
        typed = ", ".join(f"{p} string" for p in parts)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, {typed}) USING parquet "
            f"PARTITIONED BY ({', '.join(parts)}) LOCATION {quote(f'{root}/{name}')}"
        )
    return list(BATCH_TABLES)


# -- day export, dead letters, CSV -------------------------------------------------


def day_slice(posts: DataFrame, day: str) -> DataFrame:
    return posts.filter(F.col(DAY) == F.lit(day).cast("date")).select("uri", "text", "created_at")


def unload_day(posts: DataFrame, day: str, target: str) -> bool:
    """Export one day to `target`/day; False when it is there already; no rows is an error."""
    spark = posts.sparkSession
    path = f"{target.rstrip('/')}/{day}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return False
    rows = day_slice(posts, day)
    if rows.isEmpty():
        raise ValueError(f"no posts on {day}")
    rows.write.mode("overwrite").option("compression", C.COMPRESSION).parquet(path)
    return True


def write_dead_letter(
    df: DataFrame, root: str, record_type: str, run_id: str, day: str, flush_id: str = "batch", attempts: int = 2
) -> None:
    """Keep a batch that could not reach its table; the last failure is raised.

    The flush names the folder, so a replay replaces what it wrote before.
    """
    target = f"{root.rstrip('/')}/{record_type}/dt={day}/flush={flush_id}"
    for attempt in range(1, attempts + 1):
        try:
            df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").parquet(target)
            return
        except Exception:
            if attempt == attempts:
                raise


def export_csv(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Fixed column order, NULL as an empty cell."""
    writer = df.select(*columns).write.mode("overwrite")
    writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def file_stats(df: DataFrame) -> DataFrame:
    """Files, bytes, rows and mean file size of a file-backed DataFrame."""
    per_file = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    files = per_file.groupBy("path", "size").agg(F.count("*").alias("n"))
    return files.agg(
        F.count("*").alias("file_count"),
        F.sum("size").alias("total_bytes"),
        F.sum("n").alias("n_rows"),
        F.avg("size").alias("avg_file_bytes"),
    )
