"""Pinned cases of filters, membership, rules, ranks, graphs, windows and upkeep."""

import shutil
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starling.functions import keep as KP
from starling.functions import ranking as RK
from starling.functions import scalars as S
from starling.functions import text as X
from starling.functions.plan import salted_semi_join
from starling.operators import accounts as A
from starling.operators import calllog as CL
from starling.operators import cohort as CO
from starling.operators import curate as K
from starling.operators import diversity as D
from starling.operators import graph as G
from starling.operators import labelling as LB
from starling.operators import ledger as LG
from starling.operators import maintain as MT
from starling.operators import membership as M
from starling.operators import preprocess as P
from starling.operators import records as R
from starling.streaming import microwindow as MW


def one(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("check", "text", "passes"),
    [
        (X.not_phone, "call 555-123-4567", False), (X.not_phone, "(555) 123-4567", False),
        (X.not_phone, "5551234567", False), (X.not_phone, "id 55512345678", True), (X.not_phone, "٥٥٥١٢٣٤٥٦٧", False),
        (X.no_urls, "see http://a.b", False), (X.no_urls, "the end.Then", False), (X.no_urls, "the end. Then", True),
        (X.no_external_urls, "x https://t.co/abc", True), (X.no_external_urls, "x https://a.co/abc", False),
        (X.body_not_removed, "  [Removed]\n", False), (X.body_not_removed, "[removed] ok", True),
        (X.no_mentions, "either/or r/x", False), (X.no_mentions, "or/and things", False), (X.no_mentions, "a/b", True),
        (X.no_markdown_links, "![a](b)", False), (X.no_markdown_links, "[a](b)", False), (X.no_markdown_links, "[a] (b)", True),
        (X.no_media_hosts, "on YouTube now", False), (X.no_media_hosts, "myimgurs", True),
        (X.not_automoderator, " AutoModerator ", False), (X.not_automoderator, "mod", True),
        (X.is_english, "  ", False), (X.is_english, "the cat and the dog", True), (X.is_english, "le chat et la souris", False),
    ],
)
def test_validators(spark, check, text, passes):
    assert one(spark, check, text) is passes


@pytest.mark.parametrize(("length", "passes"), [(49, False), (50, True), (280, True), (281, False)])
def test_twitter_length_counts_code_points(spark, length, passes):
    assert one(spark, lambda t: X.valid_length(t, 50, 280), "😀" * length) is passes


def test_length_is_judged_before_links_are_stripped(spark):
    text = "the cat and the dog " + "a" * 20 + " https://t.co/abcdefgh"
    df = spark.createDataFrame([("1", text)], "tweet_id string, text string")
    (row,) = P.preprocess(df, P.TWITTER).collect()
    assert len(text) >= 50 and len(row["text"]) < 50 and "t.co" not in row["text"]


@pytest.mark.parametrize(("word", "n"), [("cake", 1), ("the", 1), ("beautiful", 3), ("", 0), ("123", 0), ("bcd", 1)])
def test_syllables(spark, word, n):
    assert one(spark, X.syllables, word) == n


@pytest.mark.parametrize(
    ("message", "bucket"),
    [(None, None), ("", None), ("HTTP 429", "rate_limit"), ("RepoNotFound", "repo_not_found"), ("connect timeout", "timeout"),
     ("could not connect", "network"), ("DecodeError", "decode"), ("Name or service not known", "pds_unreachable"), ("?", "other")],
)
def test_error_buckets_in_order(spark, message, bucket):
    assert one(spark, S.classify_error, message) == bucket


@pytest.mark.parametrize(
    ("key", "kind"),
    [("t/metadata/v1.metadata.json", "metadata-json"), ("metadata/snap-1.avro", "manifest-list"), ("t/metadata/x.avro", "manifest"),
     ("t/metadata/x.parquet", "other"), ("a/raw/x.parquet", "raw"), ("a/x.parquet", "data"), ("a/data/x", "data"), ("", "other")],
)
def test_key_classes(spark, key, kind):
    assert one(spark, S.classify_key, key) == kind


@pytest.mark.parametrize(("p", "tier"), [(0.1, "low"), (0.11, "medium"), (0.69, "medium"), (0.7, "high"), (None, None)])
def test_toxicity_tiers(spark, p, tier):
    assert one(spark, S.toxicity_tier, p, "double") == tier


@pytest.mark.parametrize(("w", "q"), [("cats", "cats"), ("two words", '"two words"'), ('a"b', '"a\\"b"'), ("x:y", '"x:y"')])
def test_query_terms(spark, w, q):
    assert one(spark, R.quote_query_term, w) == q


# -- membership ----------------------------------------------------------------------


def test_history_removes_and_last_row_stays(spark):
    rows = spark.createDataFrame([("a", "r1", 0, "x"), ("b", "r1", 1, "old"), ("b", "r2", 0, "new")], "uri string, run_dir string, ordinal int, t string")
    history = spark.createDataFrame([("a",)], "uri string")
    kept = M.drop_already_preprocessed(rows, history, "uri", ["run_dir", "ordinal"]).collect()
    assert [(r["uri"], r["t"]) for r in kept] == [("b", "new")]
    assert M.skipped_by_history(rows, history, "uri").first()["skipped"] == 1
    assert M.anti_join_seen(rows, history, "uri").count() == 2


def test_window_dedupe_restarts_with_each_window(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (1, "b", 4), (2, "a", 9)], "w int, uri string, t int")
    got = {(r["w"], r["uri"], r["t"]) for r in M.window_dedupe(rows, ["t"], ["w"]).collect()}
    assert got == {(1, "a", 3), (1, "b", 4), (2, "a", 9)}


def test_upsert_order(spark):
    old = spark.createDataFrame([("x", 1, 0), ("b", 1, 1)], "k string, v int, ordinal int")
    new = spark.createDataFrame([("y", 2, 0), ("x", 2, 1)], "k string, v int, ordinal int")
    rows = M.upsert_by_key(old, new, "k", ["a", "b"]).orderBy("is_extra", "canonical_position", "first_new", "first_ordinal")
    assert [(r["k"], r["v"]) for r in rows.collect()] == [("b", 1), ("x", 2), ("y", 2)]


@pytest.mark.parametrize("pick", [KP.keep_last, KP.keep_first])
def test_keep_equals_window(spark, pick):
    rng = random.Random(1)
    data = [(rng.choice("aaaab"), rng.randrange(50), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, t int, i int")
    order = [F.desc("t"), F.desc("i")] if pick is KP.keep_last else [F.asc("t"), F.asc("i")]
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*order))).filter("r = 1").drop("r")
    assert sorted(pick(df, ["k"], ["t", "i"]).collect()) == sorted(want.collect())


# -- rules ----------------------------------------------------------------------------


def wide(spark):
    rows = [("True", "left", "opinion"), ("False", "left", "opinion"), ("true", None, "opinion"), (" YES ", "right", None)]
    return spark.createDataFrame(rows, "is_political string, stance string, category string")


def test_rules_on_null(spark):
    df = wide(spark)
    assert K.apply_rules(df, [K.Rule("stance", "in", ["left", "right"])]).count() == 3
    assert K.apply_rules(df, [K.Rule("stance", "ne", "left")]).count() == 2
    assert K.apply_rules(df, [K.Rule("category", "eq", "opinion")]).count() == 3
    assert K.apply_rules(df, [K.Rule("is_political", "eq", "true")]).count() == 3


def test_rule_steps_count_prefixes(spark):
    rules = [K.Rule("is_political", "eq", True), K.Rule("stance", "in", ["left", "right"]), K.Rule("category", "eq", "opinion")]
    steps = [(r["records_before"], r["records_passing"]) for r in K.rule_steps(wide(spark), rules).orderBy("step").collect()]
    assert steps == [(4, 3), (3, 2), (2, 1)]


def test_rule_errors(spark):
    for rule, error in ((K.Rule("nope", "eq", "x"), KeyError), (K.Rule("stance", "in", "x"), ValueError), (K.Rule("stance", "lt", "x"), ValueError)):
        with pytest.raises(error):
            K.apply_rules(wide(spark), [rule])


def test_consolidate_keeps_repeats_and_renames(spark):
    posts = spark.createDataFrame([(1,), (1,), (2,)], "comment_fullname int")
    news = spark.createDataFrame([("1", "t1", "news"), ("1", "t2", "opinion")], "uri string, label_timestamp string, category string")
    rows = K.consolidate(posts, {"is_news_or_opinion": news}, "comment_fullname").collect()
    assert sorted((r[0], r[1]) for r in rows if r[1]) == [(1, "opinion"), (1, "opinion")] and len(rows) == 3


# -- ranks over a hot key -----------------------------------------------------------------


def test_ranks_and_totals_over_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 9).alias("k"), "id", (F.col("id") * 7919 % 101).alias("v"))
    by = Window.partitionBy("k").orderBy("v", "id")
    want = df.withColumns({"r": F.row_number().over(by).cast("bigint"), "t": F.sum("id").over(by.rowsBetween(Window.unboundedPreceding, 0))})
    ranked = RK.running_total(RK.rank_within(df, ["k"], ["v", "id"], "r"), ["k"], ["v", "id"], F.col("id"), "t")
    assert ranked.select(*want.columns).exceptAll(want).isEmpty() and ranked.count() == 3000


def test_top_n_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    top = RK.top_n(df, ["k"], [F.desc("id")], 2, "r")
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 6


def test_large_top_n_equals_the_window(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), "id")
    top = RK.top_n(df, ["k"], [F.desc("id")], 1500, "r")
    want = df.filter("id >= 1000").withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("id"))).cast("bigint"))
    assert top.exceptAll(want).isEmpty() and top.count() == 3000


def percentile(values, pct):
    ordered = sorted(values)
    rank = (len(ordered) - 1) * pct / 100
    low = int(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] * (1 - rank + low) + ordered[high] * (rank - low)


def test_percentiles(spark):
    rng = random.Random(3)
    values = [float(rng.randrange(1000)) for _ in range(237)]
    df = spark.createDataFrame([("p", v) for v in values], "phase string, duration_ms double")
    stats = CL.latency_stats(df, ["phase"]).first()
    assert math.isclose(stats["p90"], percentile(values, 90)) and stats["executions"] == 237
    near = CL.nearest_rank_percentiles(df, ["phase"], "duration_ms", [50, 99]).first()
    assert near["p50"] == sorted(values)[round(0.5 * 237) - 1] and near["p99"] == sorted(values)[round(0.99 * 237) - 1]


def test_tier_stats_only_for_reached_scales(spark):
    calls = spark.createDataFrame([(i, float(i), 10, None, False) for i in range(1, 13)], "call_index bigint, duration_seconds double, repo_size_bytes int, error string, rate_limited boolean")
    rows = {r["scale"]: r for r in CL.tier_stats(calls).collect()}
    assert set(rows) == {1, 10} and rows[10]["median_seconds"] == 5.5 and rows[10]["p95_seconds"] == 10.0


def test_budget_counts_history_and_skips_the_rest(spark):
    rows = spark.createDataFrame([(t, i) for t in "abc" for i in range(4)], "task_id string, i int")
    tasks = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "task_id string, position bigint")
    kept, report = LG.row_budget(rows, tasks, 3, 7, [F.col("i")], already=2)
    assert {r["task_id"]: (r["allowed"], r["status"]) for r in report.collect()} == {"a": (3, "completed"), "b": (2, "completed"), "c": (0, "skipped")}
    assert kept.count() == 5


# -- graphs, trees, windows ---------------------------------------------------------------


def test_bfs_order_and_target(spark):
    edges = [("s", "b", 1), ("s", "a", 2), ("b", "c", 1), ("b", "s", 2), ("a", "c", 1), ("a", "d", 2), ("c", "e", 1)]
    df = spark.createDataFrame(edges, "account string, follower string, ordinal bigint")
    rows = G.bfs_followers(df, "s").orderBy("depth", "position").collect()
    assert [(r["did"], r["depth"]) for r in rows] == [("b", 1), ("a", 1), ("c", 2), ("d", 2), ("e", 3)]
    few = G.bfs_followers(df, "s", target=3)
    assert [r["did"] for r in few.orderBy("depth", "position").collect()] == ["b", "a", "c"]
    assert G.bfs_summary(few, 10).first().asDict() == {"found": 3, "max_depth": 2, "shortfall": 7}


def test_bfs_has_no_silent_depth(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 1) for i in range(100)], "account string, follower string, ordinal bigint")
    with pytest.raises(ValueError, match="beyond depth 14"):
        G.bfs_followers(chain, "n0", max_depth=14)
    short = chain.filter("length(account) < 3")
    assert G.bfs_followers(short, "n0", max_depth=10).count() == G.bfs_followers(short, "n0").count() == 10


def test_sortable_keeps_the_order_of_any_number(spark):
    numbers = [-(1 << 63), -5, 0, 7, 1234567890123, 1234567890124, (1 << 63) - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").withColumn("text", G.sortable(F.col("n")))
    assert [r["n"] for r in df.orderBy("text").collect()] == numbers


def test_original_posts_are_no_interactions(spark):
    post = '{"$type":"app.bsky.feed.post","text":"x","createdAt":"2024-02-01T00:00:00Z"}'
    reply = post.replace('"text"', '"reply":{"root":{"uri":"r"},"parent":{"uri":"p"}},"text"')
    rows = [("did:a", f"at://a/{i}", post) for i in range(25)] + [("did:b", "at://b/1", reply)]
    records = spark.createDataFrame(rows, "did string, uri string, raw string").select("did", "uri", F.parse_json("raw").alias("record"))
    got = {r["did"]: r for r in A.activity_counts(records, F.lit("2024-01-10").cast("timestamp")).collect()}
    assert (got["did:a"]["original_posts_6m"], got["did:a"]["interactions_6m"]) == (25, 0)
    assert (got["did:b"]["replies_6m"], got["did:b"]["interactions_6m"]) == (1, 1)


def test_deep_comment_chain(spark):
    rows = [(1, f"c{i}", None if i == 0 else f"c{i - 1}", i) for i in range(40)] + [(1, "z", "c0", 99)]
    df = spark.createDataFrame(rows, "submission_id int, comment_id string, parent_id string, ordinal int")
    tree = G.comment_tree(df).orderBy("path").collect()
    assert [r["comment_id"] for r in tree] == [f"c{i}" for i in range(40)] + ["z"]
    assert tree[39]["depth"] == 39


def walk(rows):
    """(submission, comment) -> (position, depth) by a plain depth-first walk."""
    known = {(s, c) for s, c, _, _ in rows}
    below, out, last = {}, {}, {}
    for s, c, up, n in rows:
        below.setdefault((s, up if (s, up) in known else None), []).append((n, c))
    for s in {r[0] for r in rows}:
        stack = [(c, 0) for _, c in sorted(below[(s, None)], reverse=True)]
        while stack:
            c, depth = stack.pop()
            last[s] = last.get(s, 0) + 1
            out[(s, c)] = (last[s], depth)
            stack += [(d, depth + 1) for _, d in sorted(below.get((s, c), []), reverse=True)]
    return out


def test_display_order_equals_the_walk(spark):
    rng = random.Random(4)
    rows = [(1, f"c{i:03}", None if i == 0 else f"c{i - 1:03}", i) for i in range(150)]  # a chain
    rows += [(2, f"c{i:03}", f"c{rng.randrange(i):03}" if i and rng.random() < 0.9 else None, rng.randrange(5)) for i in range(200)]
    rows += [(3, "a", "gone", -7), (3, "b", "a", 1), (3, "c", None, 3)]  # a parent that is missing; negative places
    df = spark.createDataFrame(rows, "submission_id int, comment_id string, parent_id string, ordinal int")
    got = {(r.submission_id, r.comment_id): (r.position, r.depth) for r in G.display_order(df).collect()}
    assert got == walk(rows)
    assert G.display_order(df.limit(0)).count() == 0
    ring = spark.createDataFrame([(1, "a", "b", 0), (1, "b", "a", 0)], df.schema)
    with pytest.raises(ValueError, match="cycle"):
        G.display_order(ring)


def fold(times, seconds):
    start, index, out = None, -1, []
    for t in sorted(times):
        if start is None or t - start >= seconds * 1_000_000:
            start, index = t, index + 1
        out.append((t, start, index))
    return out


@pytest.mark.parametrize("seconds", [1, 7, 60])
def test_chained_windows_equal_the_fold(spark, seconds):
    rng = random.Random(seconds)
    times = [rng.randrange(0, 300_000_000) for _ in range(200)] + [5_000_000_000, 5_000_000_000 + seconds * 1_000_000]
    df = spark.createDataFrame([(t,) for t in times], "time_us bigint")
    got = MW.assign_windows(df, seconds).collect()
    assert sorted((r["time_us"], r["window_start"], r["batch_index"]) for r in got) == fold(times, seconds)


# -- collapse and masks ---------------------------------------------------------------------


def log(spark, *rows):
    data = [(u, c, op, datetime(2026, 1, 1, 0, 0, t), str(t)) for u, c, op, t in rows]
    return spark.createDataFrame(data, "uri string, cid string, operation string, ingested_at timestamp, rev string")


def test_collapse_cases(spark):
    df = log(spark, ("a", "1", "create", 1), ("a", "1", "create", 2), ("b", "1", "create", 1), ("b", "2", "update", 3), ("c", "1", "create", 1), ("c", None, "delete", 2), ("d", None, "delete", 1), ("d", None, "delete", 2))
    stats = MT.collapse_stats(df).first().asDict()
    assert (stats["rows_before"], stats["rows_after"], stats["redelivered_duplicates"], stats["lifecycle_collapses"], stats["tombstones_dropped"]) == (8, 2, 2, 2, 2)
    final = MT.drop_tombstones(MT.collapse_to_latest(df))
    assert {(r["uri"], r["cid"]) for r in final.collect()} == {("a", "1"), ("b", "2")}
    assert MT.collapse_stats(df.limit(0)).first()["tombstone_pct"] == 0.0


def test_literal_mask_and_safe_form(spark):
    df = spark.createDataFrame([("a", "f1"), ("a", "f2"), ("b", "f1"), ("b", "f1"), ("c", "f3")], "uri string, path string")
    assert sorted(map(tuple, MT.mask_duplicates(df).collect())) == [("a", "f1"), ("c", "f3")]
    assert sorted(map(tuple, MT.keep_one(df, ["path"]).collect())) == [("a", "f1"), ("b", "f1"), ("c", "f3")]


# -- text metrics against brute force ---------------------------------------------------------


def test_linear_cosine_equals_pairs(spark):
    rng = random.Random(5)
    data = [(rng.choice("xy"), [rng.uniform(-1, 1) for _ in range(6)]) for _ in range(40)] + [("x", [0.0] * 6)]
    df = spark.createDataFrame(data, "group string, embedding array<double>")

    def cos(a, b):
        na, nb = math.hypot(*a), math.hypot(*b)
        return sum(p * q for p, q in zip(a, b)) / (na * nb) if na and nb else 0.0

    xs, ys = [v for g, v in data if g == "x"], [v for g, v in data if g == "y"]
    pairs = [cos(a, b) for i, a in enumerate(xs) for b in xs[i + 1 :]]
    got = {r["group"]: r["mean_cosine"] for r in D.mean_pairwise_cosine(df).collect()}
    assert math.isclose(got["x"], sum(pairs) / len(pairs), abs_tol=1e-12)
    cross = [cos(a, b) for a in xs for b in ys]
    assert math.isclose(D.mean_cross_cosine(df, "x", "y").first()[0], sum(cross) / len(cross), abs_tol=1e-12)


def test_sparse_gini_equals_dense(spark):
    texts = ["the cat sat on the mat", "dog dog dog", "", "a", "cat and dog and bird"]
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "group string, doc_id bigint, text string")
    weights = {}
    for r in D.tfidf(df).collect():
        weights.setdefault(r["doc_id"], {})[r["token"]] = r["weight"]
    vocabulary = sorted({t for w in weights.values() for t in w})
    got = {r["doc_id"]: r["gini"] for r in D.gini(df).collect()}
    for i in range(len(texts)):
        vector = sorted(weights.get(i, {}).get(t, 0.0) for t in vocabulary)
        n, total = len(vector), sum(vector)
        want = sum((2 * j - n - 1) * x for j, x in enumerate(vector, 1)) / (n * total) if total else 0.0
        assert math.isclose(got[i], want, abs_tol=1e-9)


# -- accounts and cohort -----------------------------------------------------------------------


def test_validity_reasons(spark):
    df = spark.createDataFrame([(10, 10, 20, 20, None), (None, 9, 20, 19, None), (10, 10, 20, 20, "429")], "followers int, followees int, original_posts_6m int, interactions_6m int, error string")
    rows = A.apply_validity(df).collect()
    assert [r["valid"] for r in rows] == [True, False, False]
    assert rows[1]["invalid_reasons"] == ["followers<10", "followees<10", "interactions_6m<20"]


def cohort(spark):
    members = spark.createDataFrame([(0, "d0", "h", 5), (1, "d1", "", 6), (2, "d2", "x", 7)], "ordinal int, did string, handle string, followers_count bigint")
    bundles = spark.createDataFrame([("d0", None), ("d1", "boom")], "did string, error string")
    post = '{"$type":"app.bsky.feed.post","createdAt":"%s","text":"t"%s}'
    follow = '{"$type":"app.bsky.graph.follow","createdAt":"2026-01-02T00:00:00Z","subject":"%s"}'
    quote = ',"embed":{"$type":"app.bsky.embed.record","record":{"uri":"at://q"}}'
    rows = [
        ("d0", "p1", post % ("2026-01-02T00:00:00Z", quote)), ("d0", "p2", post % ("2026-01-02T00:00:00", "")),
        ("d0", "p3", post % ("2026-01-03T00:00:00Z", ',"reply":{"parent":{"uri":"a"},"root":{"uri":"b"}}')),
        ("d0", "f1", follow % "d1"), ("d0", "f2", follow % "d1"), ("d0", "f3", follow % "d0"), ("d0", "f4", follow % "z"),
        ("d1", "f1", follow % "d0"),
    ]
    records = spark.createDataFrame(rows, "did string, uri string, j string").select("did", "uri", F.parse_json("j").alias("record"))
    bounds = (F.lit("2026-01-01").cast("timestamp"), F.lit("2026-01-31").cast("timestamp"))
    return members, bundles, records, bounds


def test_hot_accounts_are_shared_by_tasks(spark):
    """A third of all follows go to one account and a third come from another; joins never broadcast."""
    kept = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in kept}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        kind = F.col("id") % 3
        edges = spark.range(n).select(
            F.when(kind == 1, F.lit("fan")).otherwise(F.concat(F.lit("a"), F.col("id"))).alias("did"),
            F.when(kind == 0, F.lit("star")).otherwise(F.concat(F.lit("b"), F.col("id"))).alias("followed_did"),
        )
        members = edges.select(F.col("followed_did").alias("did")).distinct()
        bundles = edges.select("did").distinct().withColumn("error", F.lit(None).cast("string"))
        followers = CO.cohort_followers(edges.union(edges), members, bundles)
        for rows in (CO.cohort_followees(edges, members), followers):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < 3 * n / 16
        counted = followers.groupBy("did").agg(F.count("*").alias("n"))
        assert counted.filter("did = 'star'").first()["n"] == n // 3
        # The counts travel added up by task.
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(did")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cohort_stats(spark):
    members, bundles, records, bounds = cohort(spark)
    rows = CO.derive_stats(members, bundles, records, *bounds)
    d0, d1, d2 = rows.orderBy("ordinal").collect()
    assert (d0["original_posts"], d0["quoted_posts"], d0["replied_posts"], d0["follow_actions"]) == (1, 1, 1, 4)
    assert (d0["followees_count"], d0["cohort_followees"], d0["cohort_followers"]) == (4, 2, 0)
    assert d0["account_created_at"] is None and d0["saved_posts"] is None
    assert (d1["followees_count"], d1["cohort_followers"], d1["cohort_followees"], d1["handle"]) == (None, 1, 0, None)
    assert d2["followees_count"] is None and d2["followers_count"] == 7
    assert all(v == 0 for v in CO.unknowable_policy(rows).first())
    packed = CO.pack_lists(CO.activity_items(members, bundles, records, *bounds), 3)
    assert sorted(len(r["items"]) for r in packed.filter("list_name = 'follow_actions'").collect()) == [1, 3]


# -- labelling ----------------------------------------------------------------------------------

CALLS: list[int] = []


def flaky(texts):
    if any(t == "bad" for t in texts):
        raise RuntimeError("no")
    return [{"is_political": len(t) > 3} for t in texts]


def test_every_input_is_labelled_or_dead(spark):
    rows = spark.createDataFrame([(f"u{i}", "bad" if i == 5 else "text") for i in range(20)], "uri string, text string").coalesce(1)
    existing = spark.createDataFrame([("u0",)], "uri string")
    spec = LB.FEATURES["is_political"]
    labels, dead = LB.label_feature(rows, spec, flaky, existing, "t", chunk_size=4)
    (letter,) = dead.collect()
    assert letter["attempts"] == 4 and "u5" in letter["uris"] and len(letter["uris"]) == 4
    done = {r["uri"] for r in labels.collect()}
    assert len(done) == 15 and not done & set(letter["uris"])
    again = M.filter_unlabeled(rows, "uri", existing, labels)
    assert {r["uri"] for r in again.collect()} == set(letter["uris"])


def test_labelling_runs_resume_and_take_up_what_failed(spark, tmp_path):
    rows = spark.createDataFrame([(f"u{i:02}", "bad" if i in (5, 6, 13) else "text") for i in range(20)], "uri string, text string").repartition(5)
    spec, base = LB.FEATURES["is_political"], tmp_path / "is_political"
    ledger = LB.run_labelling(rows, spec, flaky, str(tmp_path), "t1", chunk_size=4)
    assert LB.run_counts(ledger).first()[:] == (12, 2, True)
    before = sorted(map(tuple, ledger.collect()))
    # A run that ended before its ledger does its own rows again; one with a ledger does nothing.
    shutil.rmtree(base / "ledger")
    assert sorted(map(tuple, LB.run_labelling(rows, spec, flaky, str(tmp_path), "t1", chunk_size=4).collect())) == before
    calm = lambda texts: [{"is_political": True} for _ in texts]
    assert sorted(map(tuple, LB.run_labelling(rows, spec, calm, str(tmp_path), "t1", chunk_size=4).collect())) == before
    second = LB.run_labelling(rows, spec, calm, str(tmp_path), "t2", chunk_size=4)
    assert LB.run_counts(second).first()[:] == (8, 0, True)
    labels = spark.read.parquet(str(base / "labels"))
    assert labels.count() == labels.select("uri").distinct().count() == 20
    assert {r["uri"] for r in labels.filter("label_timestamp = 't2'").collect()} == {f"u{i:02}" for i in (4, 5, 6, 7, 12, 13, 14, 15)}
    none = LB.run_labelling(rows, spec, calm, str(tmp_path), "t3", chunk_size=4)
    assert LB.run_counts(none).first()[:] == (0, 0, True)


def test_out_of_domain_labels_fail(spark):
    rows = spark.createDataFrame([("u", "t")], "uri string, text string")
    tagged = LB.score_chunks(rows, LB.FEATURES["political_stance"], lambda texts: [{"political_stance": "up"} for _ in texts])
    assert tagged.first()["ok"] is False


def test_feature_subset():
    assert [s.name for s in LB.select_features("is_political, political_stance")] == ["is_political", "political_stance"]
    with pytest.raises(ValueError):
        LB.select_features(["nope"])


def test_score_batches_retries_failed_items_only(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", ""), ("c", "yy")], "uri string, text string").coalesce(1)
    got = LB.score_batches(rows, lambda texts: [t or None for t in texts])
    assert {r["uri"]: (r["response"], r["attempts"]) for r in got.collect()} == {"a": ("x", 1), "b": (None, 4), "c": ("yy", 1)}
    short = LB.score_batches(rows, lambda texts: texts[:1] if len(texts) > 1 else texts)
    assert all(r["response"] is None and r["attempts"] == 4 for r in short.collect())


def test_latest_posts_leave_replies_out(spark):
    rows = [("a", f"p{k}", k, "at://parent" if k % 2 else None) for k in range(8)] + [("b", "q", 1, "at://parent")]
    posts = spark.createDataFrame(rows, "did string, uri string, at int, reply_parent_uri string")
    order = [F.desc("at"), F.col("uri")]
    got = A.latest_posts_per_user(posts, "did", order, "reply_parent_uri", 3).collect()
    assert sorted((r.did, r.position, r.uri) for r in got) == [("a", 1, "p6"), ("a", 2, "p4"), ("a", 3, "p2")]


def test_salted_semi_join_shuffles_the_keys_and_salts_hot_ones_only(spark):
    pairs = [(f"f{i}", "hot") for i in range(40)] + [("f1", "cold"), ("f1", "gone"), ("f2", None), (None, "cold")]
    rows = spark.createDataFrame(pairs, "did string, target string")
    keys = spark.createDataFrame([("hot",), ("cold",), ("cold",), (None,)], "target string")
    kept = salted_semi_join(rows, keys, "target", ["did"], salts=4, hot=10)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([p for p in pairs if p[1] in ("hot", "cold")], key=str)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin [target" in plan
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftSemi" in line]


def test_terms_are_counted_per_text_without_shuffling_tokens(spark):
    docs = [(1, "b a a"), (1, "B c"), (2, ""), (None, "ab AB"), (3, None), (4, "aa aa bb aa")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    longer = df.withColumn("text", F.regexp_replace("text", r"\b(\w)\b", "$1$1"))
    got = D.term_counts(longer)
    want = [(1, "aa", 2), (1, "bb", 1), (1, "BB", 1), (1, "cc", 1), (None, "ab", 2), (4, "aa", 3), (4, "bb", 1)]
    merged = {}
    for d, t, n in want:
        merged[d, t.lower()] = merged.get((d, t.lower()), 0) + n
    assert {(r.doc_id, r.token): r.tf for r in got.collect()} == merged
    plan = D.term_counts(longer)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(doc_id" in plan


def test_running_gini_repeats_no_token_before_the_join(spark, monkeypatch):
    docs = [("examples", 1, "cat dog cat", None), ("generated", 2, "cat bird", 1), ("generated", 3, "fish", 2),
            ("generated", 4, "", 2), ("generated", 4, "cat", 2), ("generated", None, "cat", 1)]
    df = spark.createDataFrame(docs, "group string, doc_id bigint, text string, call bigint")
    tables = {}

    def kept(rows, name):
        tables[name] = rows.count()
        return rows

    monkeypatch.setattr(D, "written", kept)
    rows = {(r["upto"], r["group"]): r["n_posts"] for r in D.running_gini(df).collect()}
    assert rows == {(1, "examples"): 1, (1, "generated"): 2, (2, "examples"): 1, (2, "generated"): 5}
    assert tables["running-counts"] == 6  # one per text id and token, whatever the number of calls


def test_whole_text_counts_equal_those_of_words_and_pieces(spark):
    pick = random.Random(3)
    texts = ["".join(pick.choice("aeiouybcdzstEIÉßİKΣ .!?\n'-1") for _ in range(pick.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in [*texts, "The table. a be idee", "", None]], "text string")
    by_word = F.aggregate(X.alphabetic_words(F.col("text")), F.lit(0), lambda total, word: total + X.syllables(word))
    pieces = F.greatest(F.lit(1), F.size(F.filter(F.split("text", r"[.!?]+"), lambda p: ~X.is_blank(p))))
    rows = df.select(
        by_word.alias("a"), X.syllable_count(F.col("text")).alias("b"), pieces.alias("c"), X.sentence_count(F.col("text")).alias("d")
    )
    assert rows.filter("NOT (a <=> b) OR NOT (c <=> d)").count() == 0
    plan = df.select(X.syllable_count(F.col("text")), X.sentence_count(F.col("text")))._jdf.queryExecution().optimizedPlan()
    assert "lambdafunction" not in plan.toString()  # no expression runs once per word
