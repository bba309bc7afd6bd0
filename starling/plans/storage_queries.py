"""Writes read back: appends, day partitions, catalog, compaction, streams.

Each query writes the given tables (or what Spark derives from them) to a fresh folder of
the shared checkpoint location and returns what a reader of that folder sees.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling import constants as C
from starling.operators import expiry as EX
from starling.operators import landing as LZ
from starling.operators import maintain as MT
from starling.operators import records as R
from starling.plans import views as VW
from starling.plans.ingest_queries import event_log, parsed
from starling.plans.registry import big, duck_stamp, query, stamp
from starling.plans.views import duck
from starling.session import durable, scratch_path, written
from starling.sources import stages as ST
from starling.sources import tables as TB
from starling.streaming import ingest as IN
from starling.streaming import metrics as SM


def _posts(spark, sf):
    return VW.posts(spark, sf).select("uri", "did", "text", "created_at")


@query("S4_append_records", duck("SELECT uri, count(*) AS copies FROM (SELECT uri FROM v_posts UNION ALL SELECT uri FROM v_posts WHERE lang = 'fr') GROUP BY uri", "posts"))
def append_records(spark, sf):
    path = scratch_path(spark, "append")
    TB.append_records(_posts(spark, sf), path, required=["uri"])
    more = VW.posts(spark, sf).filter("lang = 'fr'").select("did", "created_at", "text", "uri")
    TB.append_records(more, path, required=["uri"])
    return TB.read_table(spark, path).groupBy("uri").agg(F.count("*").alias("copies"))


@query("S5_write_day_partitioned", duck("SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS n_rows FROM v_posts GROUP BY 1", "posts"))
def write_days(spark, sf):
    path = scratch_path(spark, "days")
    TB.write_day_partitioned(_posts(spark, sf), path)
    rows = TB.read_table(spark, path)
    return rows.groupBy(F.col(TB.DAY).cast("string").alias("day")).agg(F.count("*").alias("n_rows"))


def _database(spark: SparkSession, path: str) -> str:
    name = "starling_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION {TB.quote(path)}")
    return name


@query("S6_create_tables", duck("SELECT record_type, true AS created, false AS created_again, count(*) AS n_rows FROM v_stored GROUP BY record_type", "stored"))
def create_tables(spark, sf):
    path = scratch_path(spark, "catalog")
    database = _database(spark, path)
    first = TB.create_tables(spark, database, root=path)
    again = TB.create_tables(spark, database, root=path)
    TB.require_tables(spark, database, list(first))
    # Parsed once for the four tables.
    stored = parsed(spark, sf).filter(F.col("record_type").isNotNull())
    rows = written(TB.with_day(stored).withColumn("run_id", F.lit("r")), "parsed")
    out = None
    for name in first:
        table = spark.table(f"{database}.{name}")
        part = rows.filter(F.col("record_type") == name)
        part.select(*table.columns).write.insertInto(f"{database}.{name}")
        one = spark.table(f"{database}.{name}").agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("record_type"), F.lit(first[name]).alias("created"), F.lit(again[name]).alias("created_again"), "n_rows"
        )
        out = one if out is None else out.union(one)
    return out


@query("S8_register_partition", duck("SELECT lang AS dataset_id, count(*) AS n_rows FROM v_posts WHERE lang IN ('en', 'fr') GROUP BY lang", "posts"))
def register_partition(spark, sf):
    path = scratch_path(spark, "partitions")
    database = _database(spark, path)
    spark.sql(f"CREATE TABLE {database}.p (uri string, dataset_id string) USING parquet PARTITIONED BY (dataset_id) LOCATION {TB.quote(path + '/p')}")
    for lang in ("en", "fr"):
        target = f"{path}/elsewhere/{lang}"
        VW.posts(spark, sf).filter(F.col("lang") == lang).select("uri").write.parquet(target)
        for _ in range(2):
            TB.register_partition(spark, f"{database}.p", {"dataset_id": lang}, target)
    return spark.table(f"{database}.p").groupBy("dataset_id").agg(F.count("*").alias("n_rows"))


@query("S9_external_tables", duck("SELECT 'raw_posts' AS table_name, count(*) AS n_rows FROM v_post_runs UNION ALL SELECT 'feature_is_political', count(*) FROM v_f_political", "post_runs", "f_political"))
def external_tables(spark, sf):
    path = scratch_path(spark, "external")
    database = _database(spark, path)
    TB.create_batch_tables(spark, database, path)
    schema = spark.table(f"{database}.raw_posts").schema
    from starling.sources.envelopes import project_to_schema

    rows = VW.post_runs(spark, sf).withColumns({"platform": F.lit("bluesky"), "dataset_id": F.lit("d")})
    project_to_schema(rows, schema).write.insertInto(f"{database}.raw_posts")
    political = VW.feature_tables(spark, sf)["is_political"]
    labelled = political.withColumns({"platform": F.lit("bluesky"), "dataset_id": F.lit("d")})
    labelled.write.insertInto(f"{database}.feature_is_political")
    names = ("raw_posts", "feature_is_political")
    counts = [spark.table(f"{database}.{n}").agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    return counts[0].union(counts[1])


@query("S2_load_stage_csv", duck("SELECT run_dir, uri, text FROM v_post_runs", "post_runs"))
def load_stage_csv(spark, sf):
    path = scratch_path(spark, "stage")
    rows = VW.post_runs(spark, sf).select("uri", "text", "run_dir")
    writer = rows.write.partitionBy("run_dir").option("header", True).option("escape", '"').option("emptyValue", "")
    writer.option("quoteAll", True).csv(path)
    return ST.load_stage(spark, path, "uri string, text string", fmt="csv").select("run_dir", "uri", "text")


@query("S11_write_dead_letter", duck("SELECT uri, 'posts' AS record_type, 'run-1' AS run_id FROM v_stored WHERE record_type = 'posts'", "stored"))
def dead_letter(spark, sf):
    root = scratch_path(spark, "dead")
    rows = parsed(spark, sf).filter("record_type = 'posts'").select("uri", "text")
    TB.write_dead_letter(rows, root, "posts", "run-1", "2024-01-31")
    back = spark.read.parquet(f"{root}/posts")
    return back.select("uri", F.lit("posts").alias("record_type"), "run_id")


@query("S15_export_metrics_csv", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END :: BIGINT AS nation FROM customer")
def export_csv(spark, sf):
    path = scratch_path(spark, "export")
    rows = VW.table(spark, sf, "customer").withColumn("nation", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")))
    TB.export_csv(rows, ["c_custkey", "c_name", "nation"], path)
    return spark.read.schema("c_custkey bigint, c_name string, nation bigint").option("header", True).csv(path)


@query("M1_compact_days", duck("SELECT strftime(created_at, '%Y-%m-%d') AS day, uri, CASE WHEN created_at::DATE >= DATE '2024-01-07' AND created_at::DATE < DATE '2024-01-10' THEN true END AS one_file FROM v_posts", "posts"))
def compact_days(spark, sf):
    """Days written in many small files, three of them compacted into one each; no row changes."""
    path = scratch_path(spark, "compact")
    rows = TB.with_day(_posts(spark, sf))
    rows.repartition(8).write.partitionBy(TB.DAY).parquet(path)
    MT.compact_days(spark, path, "2024-01-10", days=3, min_small=2)
    after = TB.read_table(spark, path)
    files = after.groupBy(TB.DAY).agg(F.count_distinct("_metadata.file_path").alias("files"))
    chosen = F.col(TB.DAY).between("2024-01-07", "2024-01-09")
    return after.join(files, TB.DAY).select(
        F.col(TB.DAY).cast("string").alias("day"), "uri", F.when(chosen, F.col("files") == 1).alias("one_file")
    )


class Stopped(Exception):
    """An upkeep job that ends before its time."""


def _stop_after(step: str):
    def after(reached: str) -> None:
        if reached == step:
            raise Stopped(step)

    return after


@query("M1_M2_stopped_upkeep", duck(f"SELECT s.step, uri, 1 :: BIGINT AS after_stop, 1 :: BIGINT AS after_repair, true AS fewer_files FROM v_posts, (VALUES {', '.join(f'({chr(39)}{s}{chr(39)})' for s in MT.STEPS)}) AS s(step)", "posts"))
def stopped_upkeep(spark, sf):
    """A compaction stopped after each of its steps: the table has every row once, then and after the next run."""
    posts = TB.with_day(_posts(spark, sf))
    half = F.pmod(F.xxhash64("uri", "text"), F.lit(2))
    # Each task writes its part of a day as two files: no shuffle, and no sort that grows with the table.
    rows = posts.filter(half == 0).unionByName(posts.filter(half == 1))
    out = None
    for step in MT.STEPS:
        path = scratch_path(spark, f"stopped-{step}")
        rows.write.partitionBy(TB.DAY).option("compression", C.COMPRESSION).parquet(path)
        files = TB.file_stats(TB.read_table(spark, path)).first()["file_count"]
        try:
            MT.compact_days(spark, path, "2100-01-01", days=40_000, min_small=2, after=_stop_after(step))
        except Stopped:
            pass
        seen = written(TB.read_table(spark, path).select("uri"), "seen")  # as seen before the next run
        MT.compact_days(spark, path, "2100-01-01", days=40_000, min_small=2)
        repaired = spark.read.parquet(path)
        fewer = TB.file_stats(repaired).first()["file_count"] < files
        both = seen.withColumn("_stop", F.lit(True)).unionByName(repaired.select("uri", F.lit(False).alias("_stop")))
        stop, none = F.col("_stop"), F.lit(0).cast("bigint")
        # Counted in one grouping, both numbers of a uri beside each other; rows without a uri have no partner.
        counted = both.groupBy("uri", F.when(F.col("uri").isNull(), stop)).agg(
            F.nullif(F.count_if(stop), none).alias("after_stop"), F.nullif(F.count_if(~stop), none).alias("after_repair")
        )
        one = counted.select(
            F.lit(step).alias("step"), "uri", "after_stop", "after_repair", F.lit(fewer).alias("fewer_files")
        )
        out = one if out is None else out.union(one)
    return out


@query(
    "M4_collapse_in_place",
    duck(
        f"SELECT uri, cid, {duck_stamp('ingested_at')} AS ingested, (SELECT count(*) FROM v_event_log) AS rows_before, count(*) OVER () AS rows_after, true AS fewer_bytes "
        "FROM (SELECT * FROM v_event_log QUALIFY row_number() OVER (PARTITION BY uri ORDER BY ingested_at DESC, rev DESC) = 1) WHERE operation <> 'delete'",
        "event_log",
    ),
)
def collapse_in_place(spark, sf):
    """The event log collapsed over itself, with the job's own report."""
    path = scratch_path(spark, "collapse")
    TB.write_day_partitioned(event_log(spark, sf), path)
    report = MT.compact_and_collapse(spark, path)
    fewer = report["bytes_after"] < report["bytes_before"] and report["file_count_after"] <= report["file_count_before"]
    return TB.read_table(spark, path).select(
        "uri", "cid", stamp("ingested_at").alias("ingested"), F.lit(report["rows_before"]).cast("bigint").alias("rows_before"),
        F.lit(report["rows_after"]).cast("bigint").alias("rows_after"), F.lit(fewer).alias("fewer_bytes"),
    )


@query(
    "M8_maintenance_result",
    duck("SELECT 'event_log' AS table_name, false AS failed, (SELECT count(*) FROM v_event_log) AS n_rows UNION ALL SELECT 'missing', true, 0", "event_log"),
)
def maintenance_result(spark, sf):
    path = scratch_path(spark, "log")
    TB.write_day_partitioned(event_log(spark, sf), path)
    report = MT.run_all(
        spark,
        {
            "event_log": lambda: MT.compact_and_collapse(spark, path, path + "-collapsed"),
            "missing": lambda: MT.compact_days(spark, path + "-missing", "2024-01-10"),
        },
    )
    size = TB.read_table(spark, path).agg(F.count("*")).scalar()
    return report.select("table_name", "failed", F.when(F.col("failed"), F.lit(0)).otherwise(size).alias("n_rows"))


# -- landing zone, old runs and strays ----------------------------------------------------


def _repo_rows(spark, sf):
    rows = R.classify_records(VW.repo_records(spark, sf)).filter("output <> 'profile'")
    return written(rows.select("did", F.col("output").alias("record_type"), "uri", "cid", "rev"), "repo-rows")


def _land_after_stop(spark, sf, step: str) -> tuple[str, list[dict[str, int]]]:
    """The landing zone of all repos, whose first run stops after `step`, and what each later run says."""
    root = scratch_path(spark, "landing")
    users, rows = VW.bundles(spark, sf), _repo_rows(spark, sf)
    try:
        LZ.land(users, rows, root, "run-1", 200, after=_stop_after(step))
    except Stopped:
        pass
    return root, [LZ.land(users, rows, root, run, 200) for run in ("run-2", "run-3")]


_PER_USER = ", ".join(f"count(*) FILTER (WHERE r.tracked = '{t}') AS {t}" for t in C.RECORD_TYPES)
_BATCHES = "SELECT did, error, (row_number() OVER (ORDER BY did) - 1) // 200 + 1 AS batch_id FROM v_bundles"


@query(
    "S12_landing_zone_batches",
    duck(
        f"SELECT u.did, u.batch_id, u.error, {_PER_USER}, 'run-2' AS run_id, count(r.did) AS rows_read, 0 :: BIGINT AS written_again FROM ({_BATCHES}) u LEFT JOIN v_repo r ON u.did = r.did GROUP BY 1, 2, 3",
        "repo", "bundles",
    ),
)
def landing_zone(spark, sf):
    """A first run that stops before its manifest, one that lands all, and one that finds nothing to do."""
    root, (_, again) = _land_after_stop(spark, sf, "rows")
    rows = LZ.landed(spark, root).groupBy("did", "batch_id").agg(F.count("*").alias("rows_read"))
    return LZ.manifest(spark, root).join(rows, ["did", "batch_id"], "left").fillna(0, ["rows_read"]).withColumn(
        "written_again", F.lit(again["written"]).cast("bigint")
    )


@query(
    "M5_expire_runs",
    duck(
        "SELECT dataset_id, runs_before, 1 :: BIGINT AS runs_after, runs_before - 1 AS expired, kept_run, n_rows, true AS bytes_agree FROM "
        "(SELECT lang AS dataset_id, count(DISTINCT run_dir) AS runs_before, max(run_dir) AS kept_run, max_by(n, run_dir) AS n_rows FROM "
        "(SELECT lang, run_dir, count(*) AS n FROM v_post_runs GROUP BY 1, 2) GROUP BY 1)",
        "post_runs",
    ),
)
def expire_runs(spark, sf):
    """Runs of each dataset written to storage, all but the newest removed, and what a reader sees then."""
    root = scratch_path(spark, "runs")
    rows = VW.post_runs(spark, sf).select("uri", "text", F.col("lang").alias("dataset_id"), "run_dir")
    rows.write.partitionBy("dataset_id", "run_dir").parquet(root)
    before = TB.file_listing(spark, root).agg(F.sum("bytes")).first()[0]
    report = EX.expire_runs(spark, root, delete=True)
    after = TB.file_listing(spark, root).agg(F.sum("bytes")).first()[0]
    freed = report.agg(F.sum("expired_bytes")).first()[0]
    left = spark.read.schema("uri string, text string, dataset_id string, run_dir string").parquet(root)
    counts = left.groupBy("dataset_id").agg(F.count("*").alias("n_rows"))
    return report.join(counts, "dataset_id").select(
        "dataset_id", "runs_before", "runs_after", "expired", "kept_run", "n_rows",
        F.lit(0 < freed == before - after).alias("bytes_agree"),
    )


@query(
    "M6_orphans_removed",
    duck(
        f"SELECT u.batch_id, r.tracked AS record_type, count(*) AS n_rows, count(*) AS stray_rows, 0 :: BIGINT AS strays_left FROM ({_BATCHES}) u JOIN v_repo r ON u.did = r.did WHERE r.tracked IN ({', '.join(TB.quote(t) for t in C.RECORD_TYPES)}) GROUP BY 1, 2",
        "repo", "bundles",
    ),
)
def orphans_removed(spark, sf):
    """Files of a landing run that stopped before its manifest are found by listing, and removed."""
    root, _ = _land_after_stop(spark, sf, "rows")
    files = f"{root}/{LZ.ROWS}"
    used = written(LZ.landed(spark, root).select("path").distinct(), "used")
    soon = dt.datetime.now() + dt.timedelta(days=1)
    strays = EX.expire_orphans(spark, files, used, soon)
    by = ["batch_id", "record_type"]
    # Counted by file before the join, which then has one row per file.
    inside = durable(LZ.file_rows(spark, root, strays).join(strays, "path", "left_semi").groupBy(*by).agg(F.sum("n_rows").alias("stray_rows")))
    EX.expire_orphans(spark, files, used, soon, delete=True)
    left = EX.expire_orphans(spark, files, used, soon).count()
    rows = LZ.landed(spark, root).groupBy(*by).agg(F.count("*").alias("n_rows"))
    return rows.join(inside, by, "full").select(
        big("batch_id").alias("batch_id"), "record_type", "n_rows", "stray_rows", F.lit(left).cast("bigint").alias("strays_left")
    )


# -- streams ---------------------------------------------------------------------------

STREAM_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def stream_frames(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.readStream.schema(STREAM_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf)
    return VW.frames_of(events, F.col("event_id") % 7).select("value")


def run_stream(spark: SparkSession, sf: str, job: IN.IngestJob) -> None:
    run = IN.start_ingest(stream_frames(spark, sf), job, f"{job.root}/_checkpoint", every=None)
    run.awaitTermination()


def _table(spark: SparkSession, job: IN.IngestJob, record_type: str) -> DataFrame:
    return TB.read_table(spark, job.table(record_type)).withColumn("record_type", F.lit(record_type))


_STORED = (
    "SELECT tracked AS record_type, uri, min(ingested_at) AS first_seen FROM v_collapsing_parsed WHERE kind = 'commit' AND operation = 'create' AND tracked IS NOT NULL AND uri IS NOT NULL AND did IS NOT NULL AND created_at IS NOT NULL "
    "AND (tracked = 'posts' OR (tracked IN ('likes','reposts') AND subject_uri IS NOT NULL) OR (tracked = 'follows' AND subject_did IS NOT NULL)) GROUP BY 1, 2"
)


@query("ST1_ingest_stream", duck(f"SELECT record_type, uri, {duck_stamp('first_seen')} AS first_seen, 'run-1' AS run_id FROM ({_STORED})", "collapsing_parsed"))
def ingest_stream(spark, sf):
    """All four tables after draining the frames: one window, first row per uri, run-stamped."""
    job = IN.IngestJob(scratch_path(spark, "stream"), "run-1")
    run_stream(spark, sf, job)
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        rows = _table(spark, job, record_type).select("record_type", "uri", stamp("ingested_at").alias("first_seen"), "run_id")
        out = rows if out is None else out.union(rows)
    return out


_PER_TYPE = duck(f"SELECT record_type, count(*) AS n_rows, count(DISTINCT uri) AS n_uris FROM ({_STORED}) GROUP BY 1", "collapsing_parsed")


@query("ST6_replayed_batch", _PER_TYPE)
def replayed_batch(spark, sf):
    """The same batch committed twice leaves the tables as after once."""
    job = IN.IngestJob(scratch_path(spark, "replay"), "run-1")
    frames = VW.collapsing_frames(spark, sf)
    for _ in range(2):
        IN.process_batch(job, frames, 0)
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        one = _table(spark, job, record_type).groupBy("record_type").agg(F.count("*").alias("n_rows"), F.count_distinct("uri").alias("n_uris"))
        out = one if out is None else out.union(one)
    return out


@query("ST6_M2_ingest_and_upkeep", _PER_TYPE)
def ingest_and_upkeep(spark, sf):
    """A replayed batch, the same frames again under a second checkpoint, then upkeep of every table.

    The second checkpoint starts at batch 0 as well and must not replace the first one's rows;
    merging small flushes and masking repeats leaves one row per uri.
    """
    root = scratch_path(spark, "upkeep")
    frames = written(VW.collapsing_frames(spark, sf), "frames")
    first = IN.IngestJob(root, "run-1", checkpoint_id="a")
    for job in (first, first, IN.IngestJob(root, "run-2", checkpoint_id="b")):
        IN.process_batch(job, frames, 0)
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        path = first.table(record_type)
        MT.compact_days(spark, path, "2100-01-01", days=40_000, min_small=2)
        MT.mask_table(spark, path, "2100-01-01", days=40_000)
        one = _table(spark, first, record_type).groupBy("record_type").agg(F.count("*").alias("n_rows"), F.count_distinct("uri").alias("n_uris"))
        out = one if out is None else out.union(one)
    return out


@query("M3_compact_full", duck(f"SELECT record_type, uri, 2 :: BIGINT AS copies, true AS rows_kept, true AS fewer_files FROM ({_STORED})", "collapsing_parsed"))
def compact_full(spark, sf):
    """The ingest tables after two streams, compacted month by month, with each month's report."""
    root = scratch_path(spark, "full")
    frames = VW.collapsing_frames(spark, sf)
    first = IN.IngestJob(root, "run-1", checkpoint_id="a")
    for job in (first, IN.IngestJob(root, "run-2", checkpoint_id="b")):
        IN.process_batch(job, frames, 0)
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        path = first.table(record_type)
        ends = spark.read.parquet(path).agg(F.min(TB.DAY).cast("string"), F.max(TB.DAY).cast("string")).first()
        report = MT.compact_full(spark, path, ends[0], ends[1])
        kept = F.bool_and(F.col("rows_before") == F.col("rows_after"))
        total = report.agg(kept.alias("rows_kept"), (F.sum("files_after") < F.sum("files_before")).alias("fewer_files")).first()
        one = _table(spark, first, record_type).groupBy("record_type", "uri").agg(F.count("*").alias("copies"))
        one = one.withColumns({name: F.lit(total[name]) for name in ("rows_kept", "fewer_files")})
        out = one if out is None else out.union(one)
    return out


@query("ST2_flush_trigger", duck(f"SELECT 'size' AS reason, record_type, count(DISTINCT uri) AS n_uris FROM ({_STORED}) GROUP BY 2", "collapsing_parsed"))
def flush_trigger(spark, sf):
    """Landed files beyond the size limit are flushed at once, in batches, until none waits."""
    root = scratch_path(spark, "flushes")
    VW.collapsing_frames(spark, sf).select("value").repartition(4).write.text(f"{root}/landed")
    job = IN.IngestJob(f"{root}/tables", "run-1")
    reasons = IN.flush_windows(spark, f"{root}/landed", job, f"{root}/checkpoint", max_bytes=1 << 16, stop=lambda: True)
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        one = _table(spark, job, record_type).groupBy("record_type").agg(F.count_distinct("uri").alias("n_uris"))
        out = one if out is None else out.union(one)
    return out.select(F.lit(",".join(reasons)).alias("reason"), "record_type", "n_uris")


@query("ST2_flush_ledger", duck(f"SELECT 'size,age' AS reason, record_type, count(DISTINCT uri) AS n_uris FROM ({_STORED}) GROUP BY 2", "collapsing_parsed"))
def flush_ledger(spark, sf):
    """Landed files removed after their flush, others landing under a restarted job: none is missed."""
    root = scratch_path(spark, "ledger")
    frames = VW.collapsing_frames(spark, sf).select("value").withColumn("_half", F.pmod(F.crc32("value"), F.lit(100)))
    job = IN.IngestJob(f"{root}/tables", "run-1")
    reasons = []
    for part, limit in (("_half < 90", 1 << 16), ("_half >= 90", 1 << 40)):
        frames.filter(part).select("value").repartition(4).write.mode("append").text(f"{root}/landed")
        reasons += IN.flush_windows(spark, f"{root}/landed", job, f"{root}/checkpoint", max_bytes=limit, stop=lambda: True)
        for row in TB.file_listing(spark, f"{root}/landed").toLocalIterator():
            TB.remove_path(spark, row["path"])
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        one = _table(spark, job, record_type).groupBy("record_type").agg(F.count_distinct("uri").alias("n_uris"))
        out = one if out is None else out.union(one)
    return out.select(F.lit(",".join(reasons)).alias("reason"), "record_type", "n_uris")


query(
    "ST3_per_window_dedup",
    duck(f"SELECT record_type, uri, {duck_stamp('first_seen')} AS first_seen FROM ({_STORED})", "collapsing_parsed"),
)(lambda spark, sf: _window_dedup(spark, sf))


def _window_dedup(spark, sf):
    from starling.operators.membership import window_dedupe
    from starling.sources import envelopes as E

    rows = E.parse_envelopes(E.decode(VW.collapsing_frames(spark, sf))).filter(F.col("record_type").isNotNull())
    kept = window_dedupe(rows, ["ingested_at", "cid", "rev"])
    return kept.select("record_type", "uri", stamp("ingested_at").alias("first_seen"))


@query("ST3_dedup_across_windows", duck(f"SELECT record_type, uri, 1 :: BIGINT AS copies FROM ({_STORED})", "collapsing_parsed"))
def dedup_across_windows(spark, sf):
    """Most frames land and are flushed; then all of them land under a restarted stream: no uri comes twice."""
    root = scratch_path(spark, "state")
    frames = VW.collapsing_frames(spark, sf).select("value")
    some = F.pmod(F.crc32("value"), F.lit(100)) < 70
    for part, run_id in ((some, "run-1"), (F.lit(True), "run-2")):
        job = IN.IngestJob(f"{root}/tables", run_id)
        frames.filter(part).repartition(4).write.mode("append").text(f"{root}/landed")
        # The horizon is longer than the given events: none is late.
        run = IN.start_ingest(IN.file_frames(spark, f"{root}/landed"), job, f"{root}/checkpoint", every=None, horizon="3650 days")
        run.awaitTermination()
    out = None
    for record_type in ("posts", "likes", "reposts", "follows"):
        rows = _table(spark, job, record_type).groupBy("record_type", "uri").agg(F.count("*").alias("copies"))
        out = rows if out is None else out.union(rows)
    return out


@query("ST5_resume_cursor", duck("SELECT max(time_us) AS cursor_us FROM v_collapsing_parsed", "collapsing_parsed"))
def resume_cursor(spark, sf):
    job = IN.IngestJob(scratch_path(spark, "cursor"), "run-1")
    run_stream(spark, sf, job)
    IN.write_cursor(spark, job, 1, 5)
    cursor = spark.read.parquet(f"{job.root}/_cursor")
    return cursor.agg(F.max("time_us").alias("cursor_us"))


@query("ST7_dead_letter_on_failure", _PER_TYPE)
def dead_letter_on_failure(spark, sf):
    """A sink that never accepts likes: their rows are kept aside, the other types commit."""

    def refuse_likes(rows: DataFrame, path: str) -> None:
        if path.endswith("/likes"):
            raise OSError("likes table is down")
        IN.write_flush(rows, path)

    job = IN.IngestJob(scratch_path(spark, "failing"), "run-1", writer=refuse_likes)
    IN.process_batch(job, VW.collapsing_frames(spark, sf), 0)
    aside = spark.read.parquet(f"{job.root}/_dead_letters/likes").withColumn("record_type", F.lit("likes"))
    out = aside.select("record_type", "uri")
    for record_type in ("posts", "reposts", "follows"):
        out = out.union(_table(spark, job, record_type).select("record_type", "uri"))
    return out.groupBy("record_type").agg(F.count("*").alias("n_rows"), F.count_distinct("uri").alias("n_uris"))


@query("ST8_run_stamping", duck(f"SELECT 'run-7' AS run_id, 'firehose-3' AS flush_id, count(*) AS n_rows FROM ({_STORED}) WHERE record_type = 'posts'", "collapsing_parsed"))
def run_stamping(spark, sf):
    from starling.sources import envelopes as E

    rows = E.parse_envelopes(E.decode(VW.collapsing_frames(spark, sf)))
    window = IN.window_rows(rows, "run-7", "firehose-3")
    return IN.type_rows(window, "posts").groupBy("run_id", "flush_id").agg(F.count("*").alias("n_rows"))


@query(
    "ST10_stream_gauges",
    duck(f"SELECT (SELECT max(time_us) FROM v_collapsing_parsed) AS cursor_us, 60.0::DOUBLE AS lag_seconds, (SELECT count(*) FROM ({_STORED})) AS rows_written, 0 :: BIGINT AS dead_letters, 0 :: BIGINT AS dropped, 1 :: BIGINT AS flushes", "collapsing_parsed"),
)
def stream_gauges(spark, sf):
    job = IN.IngestJob(scratch_path(spark, "gauges"), "run-1")
    run_stream(spark, sf, job)
    now = IN.read_cursor(spark, job.root) + 60_000_000
    return IN.gauges(spark, job.root, now).select(
        "cursor_us", "lag_seconds", "rows_written", "dead_letters", "dropped", "flushes"
    )


@query(
    "ST10_stream_listener",
    duck("SELECT 1 :: BIGINT AS batches, (SELECT count(*) FROM events) AS frames, true AS bytes_exact, 1 :: BIGINT AS ends, 1 :: BIGINT AS disconnects, 'going away' AS last_reason, (SELECT max(time_us) FROM v_collapsing_parsed) AS cursor_us", "collapsing_parsed"),
)
def stream_listener(spark, sf):
    """Frames and bytes of a stream from its listener, then a run that ends by a lost connection."""
    job = IN.IngestJob(scratch_path(spark, "listener"), "run-1", name="listened")
    frames = stream_frames(spark, sf)
    lost = frames.select(F.raise_error(F.lit("jetstream disconnected: going away")).cast("string").alias("value"))
    with SM.measured(spark, job.root, job.name):
        IN.start_ingest(SM.observed(frames), job, f"{job.root}/_checkpoint", every=None).awaitTermination()
        try:
            IN.start_ingest(SM.observed(lost), job, f"{job.root}/_second", every=None).awaitTermination()
        except StreamingQueryException:
            pass
    events = spark.read.schema(STREAM_SCHEMA).parquet(f"{sf}/events.parquet")
    sent = VW.frames_of(events, F.col("event_id") % 7).agg(F.sum(F.octet_length("value"))).scalar()
    totals = SM.stream_totals(spark, job.root, job.name).withColumn("bytes_exact", F.col("bytes") == sent).drop("bytes")
    return totals.withColumn("cursor_us", F.lit(IN.read_cursor(spark, job.root, job.name)).cast("bigint"))


_LOGGED = ", ".join(f"count_if(record_type = '{t}') AS {t}_rows" for t in ("posts", "likes", "reposts", "follows"))


@query("ST11_flush_log_line", duck(f"SELECT 'run-1' AS run_id, {_LOGGED}, count(*) AS total_rows, 0 :: BIGINT AS dead_letters, 0 :: BIGINT AS dropped, 'age' AS reason, true AS sized FROM ({_STORED})", "collapsing_parsed"))
def flush_log(spark, sf):
    """The line that the stream itself wrote about its flush."""
    job = IN.IngestJob(scratch_path(spark, "flush-log"), "run-1")
    run_stream(spark, sf, job)
    log = spark.read.parquet(f"{job.root}/_flush_log")
    sized = F.col("total_mb") > 0
    return log.select(
        "run_id", "posts_rows", "likes_rows", "reposts_rows", "follows_rows", "total_rows", "dead_letters", "dropped", "reason",
        sized.alias("sized"),
    )
