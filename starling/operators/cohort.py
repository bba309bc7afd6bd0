"""Activity of a cohort from its members' repo records.

A member's lists are kept as child rows (did, list_name, uri, …), one row per element:
an account with a third of all records is then many rows, not one giant array. Lists as
arrays come in bounded chunks (`pack_lists`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.plan import salted_semi_join
from starling.functions.ranking import chunk_index
from starling.operators import records as R
from starling.session import written

KNOWABLE_LISTS = (
    "original_posts", "liked_posts", "reposted_posts", "quoted_posts", "replied_posts",
    "cohort_followers", "cohort_followees", "follow_actions",
)
UNKNOWABLE_LISTS = ("saved_posts", "unfollow_actions")


def observed_members(members: DataFrame, bundles: DataFrame) -> DataFrame:
    """Members whose repo was read; neither list of accounts passes through the driver."""
    read = bundles.filter(F.col("error").isNull()).select("did")
    return members.select("did").join(read.hint("merge"), "did", "left_semi")


def activity_items(
    members: DataFrame, bundles: DataFrame, records: DataFrame, start: Column, end: Column
) -> DataFrame:
    """One row per list element in the window; a post may be in two lists (quote + other)."""
    # Written, so that the join reads two tables and a prolific account's records can be split.
    mine = records.join(written(observed_members(members, bundles), "observed"), "did", "left_semi")
    posts, likes, follows = R.post_row(), R.like_or_repost_row(), R.follow_row()
    rows = R.classify_records(mine).select(
        "did", "uri", "output",
        R.created_text().alias("created_at"),
        F.when(F.col("output") == "posts", posts["text"]).alias("text"),
        *[posts[c].alias(c) for c in ("is_reply", "reply_parent_uri", "reply_root_uri", "quoted_post_uri")],
        *[likes[c].alias(c) for c in ("subject_uri", "subject_cid")],
        follows["followed_did"].alias("followed_did"),
    ).filter(R.in_window(F.col("created_at"), start, end))
    post = F.col("output") == "posts"
    lists = F.array_compact(
        F.array(
            F.when(post & ~F.col("is_reply"), F.lit("original_posts")),
            F.when(post & F.col("is_reply"), F.lit("replied_posts")),
            F.when(post & (F.col("quoted_post_uri") != ""), F.lit("quoted_posts")),
            F.when(F.col("output") == "likes", F.lit("liked_posts")),
            F.when(F.col("output") == "reposts", F.lit("reposted_posts")),
            F.when(F.col("output") == "follows", F.lit("follow_actions")),
        )
    )
    return rows.withColumn("list_name", F.explode(lists)).drop("output", "is_reply")


def follow_edges(records: DataFrame) -> DataFrame:
    """(did, followed_did) per follow record, repeats included."""
    follows = R.classify_records(records).filter(F.col("output") == "follows")
    return follows.select("did", R.follow_row()["followed_did"].alias("followed_did"))


def cohort_followees(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct (did, followed_did) whose target is in the cohort.

    Repeats go before the join, which deals a much followed account over many tasks.
    """
    pairs = written(edges.filter(F.col("followed_did") != "").select("did", "followed_did").distinct(), "follow-pairs")
    return salted_semi_join(pairs, members.select(F.col("did").alias("followed_did")), "followed_did", ["did"])


def followers_among(pairs: DataFrame, bundles: DataFrame) -> DataFrame:
    """(did, follower_did) of distinct follow pairs (a table) whose source has a readable repo."""
    read = bundles.filter(F.col("error").isNull())
    inside = salted_semi_join(pairs.filter(F.col("did") != F.col("followed_did")), read, "did", ["followed_did"])
    return inside.select(F.col("followed_did").alias("did"), F.col("did").alias("follower_did"))


def cohort_followers(edges: DataFrame, members: DataFrame, bundles: DataFrame) -> DataFrame:
    """Distinct (did, follower_did): cohort members with a readable repo following `did`."""
    return followers_among(written(cohort_followees(edges, members), "cohort-pairs"), bundles)


def derive_stats(
    members: DataFrame, bundles: DataFrame, records: DataFrame, start: Column, end: Column
) -> DataFrame:
    """One row per member in input order (`ordinal`), with the size of each list.

    NULL means unknowable, 0 known to be empty. A member whose repo failed or is missing
    keeps followers_count and cohort_followers; its own counts are those of empty lists and
    followees_count is NULL.
    """
    # Parsed once and written narrow: own counts and follow pairs both read it. Records are counted
    # per account before any join: an account is one partial row per task, whatever share it holds.
    parsed = R.classify_records(records).select(
        "did", "uri", "output",
        R.in_window(R.created_text(), start, end).alias("inside"),
        R.is_reply().alias("is_reply"),
        (R.quoted_post_uri() != "").alias("is_quote"),
        R.follow_row()["followed_did"].alias("followed_did"),
        F.when(F.col("output") == "profile", F.struct(*[c.alias(n) for n, c in R.profile_row().items()])).alias("profile"),
    )
    rows = written(parsed, "cohort-rows")
    inside, post = F.col("inside"), F.col("output") == "posts"
    own = rows.groupBy("did").agg(
        F.count_if(inside & post & ~F.col("is_reply")).alias("original_posts"),
        F.count_if(inside & post & F.col("is_reply")).alias("replied_posts"),
        F.count_if(inside & post & F.col("is_quote")).alias("quoted_posts"),
        F.count_if(inside & (F.col("output") == "likes")).alias("liked_posts"),
        F.count_if(inside & (F.col("output") == "reposts")).alias("reposted_posts"),
        F.count_if(inside & (F.col("output") == "follows")).alias("follow_actions"),
        F.count_if(F.col("output") == "follows").alias("_follows"),
        F.max_by("profile", F.when(F.col("profile").isNotNull(), F.col("uri"))).alias("_profile"),
    )
    edges = rows.filter(F.col("output") == "follows").select("did", "followed_did")
    pairs = written(cohort_followees(edges, members), "cohort-pairs")
    outgoing = pairs.groupBy("did").agg(F.count("*").alias("cohort_followees"))
    incoming = followers_among(pairs, bundles).groupBy("did").agg(F.count("*").alias("cohort_followers"))
    found = bundles.filter(F.col("error").isNull()).select("did", F.lit(True).alias("_seen")).distinct()
    out = members.select("ordinal", "did", F.nullif("handle", F.lit("")).alias("handle"), "followers_count")
    # One row per account in each: all are shuffled, none passes through the driver.
    for part in (own, outgoing, incoming, found):
        out = out.join(part.hint("merge"), "did", "left")
    zero = F.lit(0).cast("bigint")
    seen = F.col("_seen").isNotNull()

    def size(name: str) -> Column:
        """Lists of the member's own repo are empty where it was not read."""
        known = F.coalesce(F.col(name), zero)
        return (known if name == "cohort_followers" else F.when(seen, known).otherwise(zero)).alias(name)

    return out.select(
        "ordinal", "did", "handle",
        F.when(seen, F.col("_profile.display_name")).alias("display_name"),
        F.when(seen, F.col("_profile.description")).alias("bio"),
        F.when(seen, F.col("_profile.created_at")).alias("account_created_at"),
        start.alias("window_start"), end.alias("window_end"),
        *[size(n) for n in KNOWABLE_LISTS],
        *[F.lit(None).cast("bigint").alias(n) for n in UNKNOWABLE_LISTS],
        "followers_count",
        F.when(seen, F.coalesce("_follows", zero)).alias("followees_count"),
    )


def pack_lists(items: DataFrame, size: int = 1000) -> DataFrame:
    """(did, list_name, chunk, items): each list as arrays of at most `size` elements.

    Elements keep uri order inside and across chunks; no row holds more than `size`.
    """
    fields = [c for c in items.columns if c not in ("did", "list_name")]
    # Written, as the ranges are found by a first pass over the items, which would parse them twice.
    chunked = chunk_index(written(items, "list-items"), size, ["uri"], keys=["did", "list_name"])
    element = F.struct("uri", *[c for c in fields if c != "uri"])
    return chunked.groupBy("did", "list_name", "chunk").agg(
        F.sort_array(F.collect_list(element)).alias("items")
    )


def unknowable_policy(stats: DataFrame) -> DataFrame:
    """Per list how many rows break the policy: unknowable always NULL, knowable never."""
    return stats.agg(
        *[F.count_if(F.col(n).isNotNull()).alias(f"{n}_not_null") for n in UNKNOWABLE_LISTS],
        *[F.count_if(F.col(n).isNull()).alias(f"{n}_null") for n in KNOWABLE_LISTS],
    )


def flatten_list_columns(df: DataFrame) -> DataFrame:
    """Array columns as JSON text for CSV; scalars and NULLs unchanged."""
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def record_counts(records: DataFrame, key: str, errors: DataFrame | None = None) -> DataFrame:
    """Rows per record type and key; keys of `errors` (key, error) appear even without rows."""
    counted = records.groupBy(key).agg(
        *[F.count_if(F.col("record_type") == t).alias(t) for t in C.RECORD_TYPES]
    )
    if errors is None:
        return counted
    zero = F.lit(0).cast("bigint")
    joined = errors.select(key, "error").join(counted, key, "full")
    return joined.select(key, "error", *[F.coalesce(F.col(t), zero).alias(t) for t in C.RECORD_TYPES])
