"""Writes, catalog, upkeep on disk and the ingestion stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starling.operators import diversity as D
from starling.operators import maintain as MT
from starling.sources import stages as ST
from starling.sources import tables as TB
from starling.streaming import ingest as IN
from starling.streaming import metrics as SM
from tests.test_parsing import TIME_US, frame


def test_append_needs_the_same_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1)], "uri string, n int")
    TB.append_records(rows, path)
    TB.append_records(rows.select("n", "uri"), path)
    assert spark.read.parquet(path).count() == 2
    for wrong in (rows.drop("n"), rows.withColumn("x", F.lit(1))):
        with pytest.raises(ValueError):
            TB.append_records(wrong, path)


def test_required_columns_fail_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1)], "uri string, n int")
    with pytest.raises(Exception, match="required column uri"):
        TB.append_records(rows, str(tmp_path / "t"), required=["uri"])


def test_require_tables_names_all_missing(spark):
    with pytest.raises(LookupError, match="posts, likes"):
        TB.require_tables(spark, "default", ["posts", "likes"])


def test_unload_day_skips_and_fails(spark, tmp_path):
    posts = TB.with_day(spark.createDataFrame([("u", "t", "2026-01-01 05:00:00")], "uri string, text string, c string").withColumn("created_at", F.to_timestamp("c")))
    assert TB.unload_day(posts, "2026-01-01", str(tmp_path)) is True
    assert TB.unload_day(posts, "2026-01-01", str(tmp_path)) is False
    with pytest.raises(ValueError):
        TB.unload_day(posts, "2026-01-02", str(tmp_path))


def test_stage_csv_blanks(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ST.load_stage(spark, str(tmp_path / "none"), "uri string")
    run = tmp_path / "run_dir=2026_01_01-00:00:00"
    run.mkdir()
    (run / "a.csv").write_text('uri,text\na,""\nb,x\n')
    kept = ST.load_stage(spark, str(tmp_path), "uri string, text string", "csv")
    assert {r["uri"]: r["text"] for r in kept.collect()} == {"a": "", "b": "x"}
    blank = ST.load_stage(spark, str(tmp_path), "uri string, text string", "csv", blanks_as_null=True)
    assert {r["uri"]: r["text"] for r in blank.collect()} == {"a": None, "b": "x"}


def day_table(spark, path, files=6):
    rows = spark.range(60).select(
        F.concat(F.lit("u"), F.col("id") % 40).alias("uri"), "id",
        F.timestamp_seconds(F.lit(1767225600) + F.col("id") * 7200).alias("created_at"),
        F.timestamp_seconds(F.lit(1767225600) + F.col("id")).alias("ingested_at"),
    )
    TB.with_day(rows).repartition(files).write.partitionBy(TB.DAY).parquet(path)


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    path = str(tmp_path / "t")
    day_table(spark, path)
    before = TB.file_stats(spark.read.parquet(path)).first()
    days = MT.compact_days(spark, path, "2026-01-04", min_small=2)
    after = TB.file_stats(spark.read.parquet(path)).first()
    assert days == ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert after["n_rows"] == before["n_rows"] == 60 and after["file_count"] < before["file_count"]
    assert MT.compact_days(spark, path, "2026-01-04") == []


def test_mask_table_keeps_one_row_per_uri(spark, tmp_path):
    path = str(tmp_path / "t")
    day_table(spark, path)
    MT.mask_table(spark, path, "2026-01-10")
    rows = spark.read.parquet(path)
    assert rows.count() == rows.select("uri").distinct().count() == 40


class Stop(Exception):
    pass


def stop_at(step):
    def after(reached):
        if reached == step:
            raise Stop(step)

    return after


@pytest.mark.parametrize("step", MT.STEPS)
@pytest.mark.parametrize("flushed", [False, True])
def test_a_stopped_swap_keeps_all_rows_and_is_repaired(spark, tmp_path, step, flushed):
    path = str(tmp_path / "out" / "t")
    if flushed:
        day_table(spark, str(tmp_path / "plain"))
        rows = spark.read.parquet(str(tmp_path / "plain")).withColumn("flush_id", F.concat(F.lit("f"), F.col("id") % 5))
        rows.write.partitionBy(TB.DAY, "flush_id").parquet(path)
        rows.select("flush_id").distinct().write.parquet(str(tmp_path / "out" / "_flush_log"))
    else:
        day_table(spark, path)
    rows_of = lambda df: sorted(tuple(r) for r in df.select("uri", "id", TB.DAY).collect())
    want = rows_of(spark.read.parquet(path))
    files = TB.file_stats(spark.read.parquet(path)).first()["file_count"]
    with pytest.raises(Stop):
        MT.compact_days(spark, path, "2026-02-01", days=90, min_small=2, after=stop_at(step))
    assert rows_of(TB.read_table(spark, path)) == want
    # Rows that come before the repair stay as well.
    late = TB.read_table(spark, path).limit(1).withColumn("id", F.lit(777).cast("bigint"))
    late = late.withColumn("flush_id", F.lit("f9")) if flushed else late
    late.write.mode("append").partitionBy(TB.DAY, *(["flush_id"] if flushed else [])).parquet(path)
    if flushed:
        spark.createDataFrame([("f9",)], "flush_id string").write.mode("append").parquet(str(tmp_path / "out" / "_flush_log"))
    assert len(rows_of(TB.read_table(spark, path))) == len(want) + 1
    MT.compact_days(spark, path, "2026-02-01", days=90, min_small=2)
    assert TB.list_names(spark, f"{path}/{TB.SWAPS}") == []
    after = spark.read.parquet(path)
    assert [r for r in rows_of(after) if r[1] != 777] == want and after.count() == len(want) + 1
    assert TB.file_stats(after).first()["file_count"] < files


def test_run_all_reports_and_raises(spark):
    report = MT.run_all(spark, {"good": lambda: None, "bad": lambda: 1 / 0, "later": lambda: None})
    assert [(r["table_name"], r["failed"]) for r in report.collect()] == [("good", False), ("bad", True), ("later", False)]
    with pytest.raises(RuntimeError, match="bad"):
        MT.require_success(report)


def test_embedding_cache_computes_each_text_once(spark, tmp_path):
    path = str(tmp_path / "cache")
    embed = lambda texts: [[float(len(t))] for t in texts]
    texts = spark.createDataFrame([("a",), ("bb",), ("a",)], "text string")
    assert D.refresh_embedding_cache(texts, path, embed, "m").count() == 3
    more = texts.union(spark.createDataFrame([("ccc",)], "text string"))
    assert D.refresh_embedding_cache(more, path, embed, "m").count() == 4
    assert spark.read.parquet(path).count() == 3


# -- stream ----------------------------------------------------------------------------------


def capture(folder, name, frames):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(frames) + "\n")


def like(rkey, time_us=TIME_US):
    return frame(commit__collection="app.bsky.feed.like", commit__rkey=rkey, commit__record__subject={"uri": "at://x"}, time_us=time_us)


def drain(spark, source, job):
    run = IN.start_ingest(IN.file_frames(spark, str(source)), job, f"{job.root}/_checkpoint", every=None)
    run.awaitTermination()


def test_stream_commits_resumes_and_moves_the_cursor(spark, tmp_path):
    source, job = tmp_path / "in", IN.IngestJob(str(tmp_path / "out"), "run-1")
    capture(source, "a.jsonl", [frame(), frame(), like("l1"), "broken", frame(kind="identity", time_us=TIME_US + 9)])
    drain(spark, source, job)
    assert spark.read.parquet(job.table("posts")).count() == 1
    assert IN.read_cursor(spark, job.root) == TIME_US + 9
    capture(source, "b.jsonl", [frame(), like("l2"), like("l1", TIME_US + 1)])
    drain(spark, source, job)
    posts, likes = spark.read.parquet(job.table("posts")), spark.read.parquet(job.table("likes"))
    # A uri of an earlier window comes again: windows forget, upkeep removes it.
    assert posts.count() == 2 and likes.count() == 3
    assert {r["run_id"] for r in posts.collect()} == {"run-1"}
    assert IN.read_cursor(spark, job.root) == TIME_US + 9
    log = spark.read.parquet(f"{job.root}/_flush_log").orderBy("flush_id").collect()
    assert [(r["posts_rows"], r["likes_rows"], r["follows_rows"], r["total_rows"]) for r in log] == [(1, 1, 0, 2), (1, 2, 0, 3)]


def test_uris_of_earlier_windows_stay_out_inside_the_horizon(spark, tmp_path):
    source, job, day = tmp_path / "in", IN.IngestJob(str(tmp_path / "out"), "run-1"), 86_400_000_000

    def later(rkey, days):
        at = dt.datetime.fromtimestamp((TIME_US + days * day) // 1_000_000, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        return frame(
            commit__collection="app.bsky.feed.like", commit__rkey=rkey, time_us=TIME_US + days * day,
            commit__record__subject={"uri": "at://x"}, commit__record__createdAt=at,
        )

    def drained():
        run = IN.start_ingest(IN.file_frames(spark, str(source)), job, str(tmp_path / "ck"), every=None, horizon="21 days")
        run.awaitTermination()
        likes = spark.read.parquet(job.table("likes")).select("uri", F.unix_micros("ingested_at").alias("at"))
        return sorted((r.uri.rsplit("/", 1)[1], (r.at - TIME_US) // day) for r in likes.collect())

    capture(source, "a.jsonl", [like("l1"), like("l1"), like("l2"), frame(), "broken", frame(kind="identity")])
    assert drained() == [("l1", 0), ("l2", 0)]
    # A restart; a repeat, one that is new, and one that moves time on.
    capture(source, "b.jsonl", [later("l1", 1), later("l3", -20), later("l4", 30)])
    assert drained() == [("l1", 0), ("l2", 0), ("l3", -20), ("l4", 30)]
    # Late is what lies over 21 days before the newest.
    capture(source, "c.jsonl", [later("l5", 8), later("l6", 10), later("l4", 31)])
    assert drained() == [("l1", 0), ("l2", 0), ("l3", -20), ("l4", 30), ("l6", 10)]
    # l1 is known until the newest is two horizons ahead of it, and then stored again.
    capture(source, "d.jsonl", [later("l1", 45), later("l7", 45)])
    assert ("l1", 45) not in drained()
    capture(source, "e.jsonl", [later("l1", 46)])
    assert drained()[:2] == [("l1", 0), ("l1", 46)]
    assert spark.read.parquet(job.table("posts")).count() == 1


def test_replay_replaces_its_own_partitions(spark, tmp_path):
    job = IN.IngestJob(str(tmp_path / "out"), "run-1")
    frames = spark.createDataFrame([(frame(),), (like("l1"),)], "value string")
    other = spark.createDataFrame([(frame(commit__rkey="k2"),)], "value string")
    IN.process_batch(job, frames, 0)
    IN.process_batch(job, other, 1)
    IN.process_batch(job, frames, 0)
    assert sorted(r["uri"][-2:] for r in spark.read.parquet(job.table("posts")).collect()) == ["k1", "k2"]


def test_second_checkpoint_keeps_rows_and_upkeep_reads_flushes(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(frame(),), (like("l1"),)], "value string")
    other = spark.createDataFrame([(frame(),), (frame(commit__rkey="k2"),)], "value string")
    first, second = IN.IngestJob(root, "run-1", checkpoint_id="a"), IN.IngestJob(root, "run-2", checkpoint_id="b")
    IN.process_batch(first, rows, 0)
    IN.process_batch(second, other, 0)
    path = first.table("posts")
    assert spark.read.parquet(path).count() == 3
    assert MT.compact_days(spark, path, "2100-01-01", days=40_000, min_small=2) != []
    assert MT.compact_days(spark, path, "2100-01-01", days=40_000, min_small=2) == []
    merged = spark.read.parquet(path)
    assert merged.count() == 3 and {r["run_id"] for r in merged.collect()} == {"run-1", "run-2"}
    IN.process_batch(first, rows, 0)  # replayed after the merge: its log says it is done
    assert spark.read.parquet(path).count() == 3
    IN.process_batch(IN.IngestJob(root, "run-3", checkpoint_id="c"), other, 0)
    MT.mask_table(spark, path, "2100-01-01", days=40_000)
    assert sorted(r["uri"][-2:] for r in spark.read.parquet(path).collect()) == ["k1", "k2"]


def test_large_days_settle(spark, tmp_path):
    """A day above the target size is merged into several files once, then left alone."""
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("uri"), F.timestamp_seconds(F.lit(1767225600)).alias("created_at"))
    TB.with_day(rows).repartition(12).write.partitionBy(TB.DAY).parquet(path)
    args = dict(days=40_000, min_small=2, target_bytes=400_000)
    assert MT.compact_days(spark, path, "2100-01-01", **args) == ["2026-01-01"]
    files = TB.file_stats(spark.read.parquet(path)).first()
    assert 2 <= files["file_count"] < 12 and files["n_rows"] == 20_000
    assert MT.compact_days(spark, path, "2100-01-01", **args) == []


def test_flush_reasons():
    assert IN.flush_due(0, 99, 10, 5) is None and IN.flush_due(3, 4, 10, 5) is None
    assert IN.flush_due(10, 9, 10, 5) == "size" and IN.flush_due(3, 5, 10, 5) == "age"


def test_flushes_go_on_after_clean_up_and_restart(spark, tmp_path):
    source, job, checkpoint = tmp_path / "in", IN.IngestJob(str(tmp_path / "out"), "run-1"), str(tmp_path / "check")

    def run(polls, **limits):
        left = [polls]

        def stop():
            left[0] -= 1
            return left[0] < 0

        return IN.flush_windows(spark, str(source), job, checkpoint, poll_seconds=0.2, stop=stop, **limits)

    assert run(1) == []
    capture(source, "a.jsonl", [like(f"a{i}") for i in range(50)])
    assert run(1, max_bytes=1000) == ["size"]
    (source / "a.jsonl").unlink()  # retention
    capture(source, "b b.jsonl", [like("b")])
    assert IN.waiting_files(spark, str(source), checkpoint).count() == 1
    assert run(30, max_age_seconds=0.5) == ["age"]
    assert IN.waiting_files(spark, str(source), checkpoint).count() == 0
    capture(source, "c.jsonl", [like("c")])
    assert run(0) == ["age"]  # what waits at the end is flushed
    likes = spark.read.parquet(job.table("likes"))
    assert likes.count() == likes.select("uri").distinct().count() == 52


def test_listener_counts_what_a_stream_received(spark, tmp_path):
    source, job = tmp_path / "in", IN.IngestJob(str(tmp_path / "out"), "run-1", name="counted")
    sizes = 0
    with SM.measured(spark, job.root, job.name) as listener:
        for name, lines in (("a.jsonl", [like("a"), frame(), "broken"]), ("b.jsonl", [like("b")])):
            capture(source, name, lines)
            sizes += sum(len(x.encode()) for x in lines)
            stream = SM.observed(IN.file_frames(spark, str(source)))
            IN.start_ingest(stream, job, f"{job.root}/_checkpoint", every=None).awaitTermination()
    listener._add("again", "batch", 7, 1, 1)
    listener._add("again", "batch", 7, 2, 10)
    assert listener.errors == []
    totals = SM.stream_totals(spark, job.root, job.name).first()
    assert tuple(totals) == (3, 6, sizes + 10, 2, 0, None)
    assert SM.stream_totals(spark, job.root, "other").first()["frames"] == 0


def test_disconnect_reasons():
    told = "x jetstream disconnected: going away SQLSTATE: P0001\n at y"
    assert SM.REASON.search(told)[1] == "going away" and SM.REASON.search("jetstream disconnected: reset")[1] == "reset"


def test_checkpoint_identity_is_stable(spark, tmp_path):
    one = IN.checkpoint_identity(spark, str(tmp_path / "a"))
    assert one == IN.checkpoint_identity(spark, str(tmp_path / "a")) != IN.checkpoint_identity(spark, str(tmp_path / "b"))


def test_dead_letters_replay_and_drop(spark, tmp_path, monkeypatch):
    def writer(rows, path):
        if path.endswith("/posts"):
            raise OSError("down")
        IN.write_flush(rows, path)

    rows = spark.createDataFrame([(frame(),), (like("l1"),)], "value string")
    job = IN.IngestJob(str(tmp_path / "out"), "run-1", writer=writer)
    for _ in range(2):
        IN.process_batch(job, rows, 0)
        TB.remove_path(spark, f"{job.root}/_flush_log")  # as if the batch ended before its log
    aside = spark.read.parquet(f"{job.root}/_dead_letters/posts").collect()
    assert [r["run_id"] for r in aside] == ["run-1"]

    def no_letters(*args, **kwargs):
        raise OSError("down too")

    monkeypatch.setattr(IN, "write_dead_letter", no_letters)
    IN.process_batch(job, rows, 1)
    assert job.dropped == {"posts": 1}
    gauges = IN.gauges(spark, job.root, TIME_US).first()
    assert (gauges["rows_written"], gauges["dead_letters"], gauges["dropped"]) == (1, 0, 1)


def test_failed_sink_goes_to_dead_letters_and_the_rest_commits(spark, tmp_path):
    tried = []

    def writer(rows, path):
        if path.endswith("/posts"):
            tried.append(path)
            raise OSError("down")
        IN.write_flush(rows, path)

    job = IN.IngestJob(str(tmp_path / "out"), "run-1", writer=writer)
    IN.process_batch(job, spark.createDataFrame([(frame(),), (like("l1"),)], "value string"), 0)
    assert len(tried) == IN.ATTEMPTS and len(job.failures) == IN.ATTEMPTS
    assert spark.read.parquet(f"{job.root}/_dead_letters/posts").count() == 1
    assert spark.read.parquet(job.table("likes")).count() == 1
    assert IN.read_cursor(spark, job.root) == TIME_US
    gauges = IN.gauges(spark, job.root, TIME_US + 5_000_000).first()
    assert (gauges["lag_seconds"], gauges["rows_written"], gauges["dead_letters"]) == (5.0, 1, 1)


def test_batch_without_rows_flushes_nothing_but_moves_the_cursor(spark, tmp_path):
    job = IN.IngestJob(str(tmp_path / "out"), "run-1")
    IN.process_batch(job, spark.createDataFrame([(json.dumps({"kind": "x", "time_us": 5}),)], "value string"), 0)
    assert IN.read_cursor(spark, job.root) == 5
    assert not TB.path_exists(spark, f"{job.root}/_flush_log")
