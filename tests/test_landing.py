"""Landing batches that survive a stop, and removal of runs and strays from storage."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starling.operators import expiry as EX
from starling.operators import landing as LZ
from starling.session import scratch_path
from starling.sources.tables import file_listing


class Stopped(Exception):
    pass


def stop_after(step):
    def after(reached):
        if reached == step:
            raise Stopped(step)

    return after


def land(spark, names, root, run="r", **more):
    users = spark.createDataFrame([(n, "gone" if n == "c" else None) for n in names], "did string, error string")
    # One user has a third of the rows; 'c' failed and has none; 'zz' is not among the users.
    rows = [(n, "posts" if i % 2 else "likes", f"{n}{i}") for n in (*names, "zz") if n != "c" for i in range(60 if n == "a" else 4)]
    records = spark.createDataFrame(rows, "did string, record_type string, uri string")
    return LZ.land(users, records, root, run, 2, **more)


def uris(spark, root):
    return sorted(r.uri for r in LZ.landed(spark, root).collect())


@pytest.mark.parametrize("step", LZ.STEPS)
def test_stopped_landing_is_taken_up(spark, step):
    root = scratch_path(spark, "land")
    with pytest.raises(Stopped):
        land(spark, "abcde", root, after=stop_after(step))
    finished = 3 if step == "manifest" else 0
    assert LZ.manifest(spark, root).count() == (5 if finished else 0)
    assert land(spark, "abcde", root, "again") == {"batches": 3, "finished": finished, "written": 3 - finished}
    assert len(uris(spark, root)) == len(set(uris(spark, root))) == 60 + 3 * 4
    before = file_listing(spark, root).count()
    assert land(spark, "abcde", root, "third")["written"] == 0
    assert file_listing(spark, root).count() == before
    listed = {r.did: r for r in LZ.manifest(spark, root).collect()}
    assert listed["c"].error == "gone" and listed["c"].posts == 0
    assert (listed["a"].posts, listed["a"].likes, listed["a"].batch_id) == (30, 30, 1)
    assert listed["a"].run_id == ("r" if step == "manifest" else "again")


def test_stop_between_commits_keeps_the_finished_batches(spark):
    root = scratch_path(spark, "land")
    seen = []

    def second_rows(step):
        seen.append(step)
        if seen.count("rows") == 2:
            raise Stopped(step)

    with pytest.raises(Stopped):
        land(spark, "abcde", root, per_commit=1, after=second_rows)
    assert sorted(r.did for r in LZ.manifest(spark, root).collect()) == ["a", "b"]
    assert land(spark, "abcde", root, per_commit=1) == {"batches": 3, "finished": 1, "written": 2}


def test_later_users_follow_in_new_batches(spark):
    root = scratch_path(spark, "land")
    land(spark, "bcd", root)
    assert land(spark, "abcde", root)["written"] == 1
    batches = {r.did: r.batch_id for r in LZ.manifest(spark, root).collect()}
    assert batches == {"b": 1, "c": 1, "d": 2, "a": 3, "e": 3}


def test_empty_landing(spark):
    root = scratch_path(spark, "land")
    assert land(spark, "", root) == {"batches": 0, "finished": 0, "written": 0}
    assert land(spark, "c", root)["written"] == 1  # a user without rows is listed all the same
    assert [r.error for r in LZ.manifest(spark, root).collect()] == ["gone"]
    with pytest.raises(FileNotFoundError):
        LZ.landed(spark, root)


def test_orphans_only_after_their_time(spark):
    root = scratch_path(spark, "land")
    with pytest.raises(Stopped):
        land(spark, "abcde", root, after=stop_after("rows"))
    land(spark, "abcde", root)
    files, rows = f"{root}/{LZ.ROWS}", uris(spark, root)
    used = LZ.landed(spark, root).select("path")
    early, late = dt.datetime(2020, 1, 1), dt.datetime.now() + dt.timedelta(days=1)
    assert EX.expire_orphans(spark, files, used, early, delete=True).count() == 0
    strays = EX.expire_orphans(spark, files, used, late).count()
    assert strays > 0
    before = file_listing(spark, files).count()
    EX.expire_orphans(spark, files, used, late, delete=True)
    assert file_listing(spark, files).count() == before - strays
    assert uris(spark, root) == rows


def test_many_batches_have_a_file_per_folder(spark):
    """A part of the shuffle that is large by its number of batches was split, each piece with files of its own."""
    root = scratch_path(spark, "land")
    users = spark.range(400).select(F.format_string("u%03d", "id").alias("did"), F.lit(None).cast("string").alias("error"))
    records = spark.range(0, 4000, 1, 8).select(
        F.format_string("u%03d", F.col("id") % 400).alias("did"), F.lit("posts").alias("record_type"), F.sha1(F.col("id").cast("string")).alias("uri")
    )
    confs = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {name: spark.conf.get(name) for name in confs}
    try:
        for name, value in confs.items():
            spark.conf.set(name, value)
        assert LZ.land(users, records, root, "r", 2)["written"] == 200
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = LZ.landed(spark, root).groupBy("batch_id").agg(F.count_distinct("path").alias("files"), F.count("*").alias("n"))
    assert [(r.batch_id, r.files, r.n) for r in files.orderBy("batch_id").collect()] == [(i, 1, 20) for i in range(1, 201)]


def test_folders_are_listed_by_a_few_tasks(spark):
    root = scratch_path(spark, "land")
    users = spark.range(100).select(F.format_string("u%03d", "id").alias("did"), F.lit(None).cast("string").alias("error"))
    # Types that look like numbers stay texts.
    LZ.land(users, users.select("did", F.lit("07").alias("record_type")), root, "r", 1)
    context = spark.sparkContext
    most = 4 * context.defaultParallelism
    confs = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
    before = [spark.conf.get(name, None) for name in confs]
    for name, read in (("files", lambda: file_listing(spark, f"{root}/{LZ.ROWS}")), ("rows", lambda: LZ.landed(spark, root))):
        context.setJobGroup(f"{root}-{name}", name)
        try:
            found = read()
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup(f"{root}-{name}") for s in tracker.getJobInfo(job).stageIds]
        tasks = [tracker.getStageInfo(s).numTasks for s in stages]
        assert tasks and max(tasks) <= most
        assert found.count() == 100
    assert file_listing(spark, f"{root}/{LZ.ROWS}").rdd.getNumPartitions() <= most
    row = LZ.landed(spark, root).orderBy("batch_id").first()
    assert (row.batch_id, row.record_type) == (1, "07")
    assert dict(LZ.landed(spark, root).dtypes)["batch_id"] == "bigint"
    assert [spark.conf.get(name, None) for name in confs] == before


def test_rows_of_strays_are_read_from_their_attempts(spark):
    root = scratch_path(spark, "land")
    for _ in range(2):
        with pytest.raises(Stopped):
            land(spark, "abcde", root, after=stop_after("rows"))
    land(spark, "abcde", root)
    files, late = f"{root}/{LZ.ROWS}", dt.datetime.now() + dt.timedelta(days=1)
    strays = EX.expire_orphans(spark, files, LZ.landed(spark, root).select("path"), late)
    rows = LZ.file_rows(spark, root, strays)
    assert rows.join(strays, "path", "left_anti").count() == 0  # the finished attempt is not opened
    want = {tuple(r): n for *r, n in LZ.landed(spark, root).groupBy("batch_id", "record_type").count().collect()}
    assert {tuple(r): n for *r, n in rows.groupBy("batch_id", "record_type").agg(F.sum("n_rows")).collect()} == {k: 2 * n for k, n in want.items()}
    assert LZ.file_rows(spark, root, strays.limit(0)).count() == 0


def test_folders_are_read_without_discovery(spark):
    root = scratch_path(spark, "land")
    kinds = ["posts", "a b+c/%41:é", None, "7"]
    users = spark.createDataFrame([(k, None) for k in "ab"], "did string, error string")
    records = spark.createDataFrame([(did, k, i) for did in "ab" for i, k in enumerate(kinds)], "did string, record_type string, n int")
    LZ.land(users, records, root, "r", 1)
    rows = LZ.landed(spark, root)
    got = sorted((r.did, r.n, r.batch_id, r.record_type) for r in rows.collect())
    assert got == [(did, i, b, k) for b, did in enumerate("ab", 1) for i, k in enumerate(kinds)]
    assert rows.columns == ["did", "n", "run_id", "batch_id", "record_type", "path"]
    # Spark's own discovery takes the square of the number of folders; files are left out all the same.
    one = rows.filter("batch_id = 2 AND record_type = 'posts'")
    assert [(r.did, r.n) for r in one.collect()] == [("b", 0)]
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.relation().partitionSchema().isEmpty()
    assert scan.metrics().apply("numFiles").value() == 1


def test_runs_with_odd_names_expire(spark):
    root = scratch_path(spark, "runs")
    rows = [("a b+c", "2024_01_01-00:00"), ("a b+c", "2024_02_01-00:00"), ("x%3A/y", "2024_01_01-00:00")]
    df = spark.createDataFrame([(f"u{i}", *r) for i, r in enumerate(rows)], "uri string, dataset_id string, run_dir string")
    df.write.partitionBy("dataset_id", "run_dir").parquet(root)
    assert EX.expire_runs(spark, root).agg(F.sum("expired")).first()[0] == 1
    assert spark.read.parquet(root).count() == 3  # a report removes nothing
    report = {r.dataset_id: r for r in EX.expire_runs(spark, root, delete=True).collect()}
    assert set(report) == {"a b+c", "x%3A/y"}
    assert report["a b+c"].kept_run == "2024_02_01-00:00" and report["a b+c"].expired_bytes > 0
    assert report["x%3A/y"].expired == 0
    assert sorted(r.uri for r in spark.read.parquet(root).collect()) == ["u1", "u2"]
