"""Per-account activity, validity, discovery results and per-user feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions import variants as V
from starling.functions.ranking import top_n
from starling.functions.scalars import classify_error
from starling.operators import records as R


def activity_counts(records: DataFrame, cutoff: Column, record: str = "record") -> DataFrame:
    """One pass over (did, uri, record): lifetime and windowed counts, account creation.

    The profile's createdAt wins (last by uri); else the earliest parsable createdAt of any
    record; else any createdAt text.
    """
    rows = R.shred_records(records, record).select(
        "did",
        "uri",
        "kind",
        R.created_text().alias("created_text"),
        R.is_reply().alias("is_reply"),
        R.embed_kind().isin(C.QUOTE, C.QUOTE_WITH_MEDIA).alias("is_quote"),
    ).withColumn("created", V.parse_created_at(F.col("created_text")))
    recent = F.col("created") >= cutoff
    is_post = F.col("kind") == "app.bsky.feed.post"
    is_profile = F.col("kind") == C.PROFILE_TYPE
    counted = rows.groupBy("did").agg(
        F.count_if(F.col("kind") == "app.bsky.graph.follow").alias("followees"),
        F.count_if(is_post).alias("posts"),
        F.count_if(is_post & recent & ~F.col("is_reply")).alias("original_posts_6m"),
        F.count_if(is_post & recent & F.col("is_reply")).alias("replies_6m"),
        F.count_if(is_post & recent & F.col("is_quote")).alias("quotes_6m"),
        F.count_if((F.col("kind") == "app.bsky.feed.like") & recent).alias("likes_6m"),
        F.count_if((F.col("kind") == "app.bsky.feed.repost") & recent).alias("reposts_6m"),
        F.count_if(F.col("kind").isin(*C.BOOKMARK_TYPES) & recent).alias("bookmarks_6m"),
        F.max_by(F.when(is_profile, F.col("created_text")), F.when(is_profile, F.col("uri"))).alias("_profile"),
        F.min_by("created_text", "created").alias("_earliest"),
        F.min("created_text").alias("_any"),
    )
    parts = ["original_posts_6m", "replies_6m", "quotes_6m", "likes_6m", "reposts_6m", "bookmarks_6m"]
    # Original posts are what an account says, not how it interacts.
    total = F.col(parts[1])
    for name in parts[2:]:
        total = total + F.col(name)
    return counted.select(
        "did", "followees", "posts", *parts,
        total.alias("interactions_6m"),
        F.coalesce("_profile", "_earliest", "_any").alias("account_created_at"),
    )


def overlay_profiles(stats: DataFrame, profiles: DataFrame) -> DataFrame:
    """Handle and followers of a found profile; its creation time only when non-empty.

    `profiles`: (did, handle, followers, created_text, indexed_text), one row per did.
    """
    found = profiles.select(
        "did",
        F.col("handle").alias("_handle"),
        F.col("followers").alias("_followers"),
        F.coalesce(F.nullif("created_text", F.lit("")), F.nullif("indexed_text", F.lit(""))).alias("_created"),
        F.lit(True).alias("_found"),
    )
    joined = stats.join(found, "did", "left")
    seen = F.col("_found").isNotNull()
    return joined.withColumns(
        {
            "handle": F.when(seen, F.col("_handle")).otherwise(F.col("handle")),
            "followers": F.when(seen, F.col("_followers")).otherwise(F.col("followers")),
            "account_created_at": F.coalesce(F.col("_created"), F.col("account_created_at")),
        }
    ).drop("_handle", "_followers", "_created", "_found")


def apply_validity(stats: DataFrame) -> DataFrame:
    """Add invalid_reasons (fixed order) and valid."""
    limits = (
        ("followers", C.VALID_MIN_FOLLOWERS),
        ("followees", C.VALID_MIN_FOLLOWEES),
        ("original_posts_6m", C.VALID_MIN_ORIGINAL_POSTS),
        ("interactions_6m", C.VALID_MIN_INTERACTIONS),
    )
    reasons = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(c), F.lit(0)) < n, F.lit(f"{c}<{n}")) for c, n in limits])
    )
    marked = stats.withColumn("invalid_reasons", reasons)
    return marked.withColumn("valid", (F.size("invalid_reasons") == 0) & F.col("error").isNull())


def validity_summary(stats: DataFrame, group: str) -> DataFrame:
    """Per group: total, valid, invalid, rate; ranked, with the lead over the next group.

    The ranking window runs over one row per group.
    """
    counted = stats.groupBy(group).agg(
        F.count("*").alias("did_count"),
        F.count_if(F.col("valid")).alias("valid_count"),
        F.count_if(~F.col("valid")).alias("invalid_count"),
    )
    order = Window.orderBy(F.desc("valid_count"), group)
    return counted.withColumns(
        {
            "validity_rate": F.coalesce(F.try_divide("valid_count", "did_count"), F.lit(0.0)),
            "position": F.row_number().over(order).cast("bigint"),
            "delta_to_next": F.col("valid_count") - F.lead("valid_count").over(order),
        }
    )


def error_breakdown(rows: DataFrame, message: str) -> DataFrame:
    named = rows.withColumn("bucket", classify_error(F.col(message)))
    return named.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count("*").alias("errors"))


def status_counts(repos: DataFrame) -> DataFrame:
    """(status, accounts) over first occurrences of each did, plus 'inactive'.

    `repos`: (did, active, status, ordinal).
    """
    first = repos.filter(F.coalesce("did", F.lit("")) != "").groupBy("did").agg(
        F.min_by("status", "ordinal").alias("status"), F.min_by("active", "ordinal").alias("active")
    )
    by_status = first.filter(F.col("status") != "").groupBy("status").agg(F.count("*").alias("accounts"))
    inactive = first.agg(F.count_if(~F.col("active")).alias("accounts"))
    return by_status.union(inactive.select(F.lit("(inactive)").alias("status"), "accounts"))


def qualify_profiles(
    profiles: DataFrame,
    feed: DataFrame,
    as_of: Column,
    target: int | None,
    max_evaluated: int | None,
) -> DataFrame:
    """Followed widely and posting lately: the first `target` in order.

    `profiles`: (ordinal, did, handle, followers); `feed`: (did, post_uri, created_at).
    Recent posts are counted among the account's latest items only. The two limits are the
    job's own stop conditions; None removes one.
    """
    evaluated = profiles if max_evaluated is None else profiles.orderBy("ordinal").limit(max_evaluated)
    wide = evaluated.filter(F.coalesce("followers", F.lit(0)) > C.PROFILE_MIN_FOLLOWERS)
    latest = top_n(
        feed.join(wide.select("did"), "did", "left_semi"),
        ["did"], [F.desc("created_at"), F.col("post_uri")], C.PROFILE_FEED_ITEMS, "_rank",
    )
    recent = latest.filter(F.col("created_at") >= as_of - F.expr("INTERVAL 7 DAYS"))
    counted = recent.groupBy("did").agg(F.count("*").alias("posts_last_7_days"))
    joined = wide.join(counted, "did").filter(F.col("posts_last_7_days") >= C.PROFILE_MIN_RECENT_POSTS)
    rows = joined.select("ordinal", "handle", "did", "followers", "posts_last_7_days")
    return rows if target is None else rows.orderBy("ordinal").limit(target)


def latest_per_user(
    rows: DataFrame, user: str, order: Sequence[Column], n: int = C.USER_FEED_ITEMS
) -> DataFrame:
    return top_n(rows, [user], order, n, "position")


def latest_posts_per_user(
    posts: DataFrame, user: str, order: Sequence[Column], reply_to: str, n: int = C.USER_FEED_ITEMS
) -> DataFrame:
    """Each user's newest `n` posts that answer no other post; replies take no places."""
    return latest_per_user(posts.filter(F.col(reply_to).isNull()), user, order, n)


def liked_posts_lookup(likes: DataFrame, posts: DataFrame, n: int = C.USER_FEED_ITEMS) -> DataFrame:
    """Each user's newest `n` likes resolved to their posts; unresolved likes drop out."""
    newest = top_n(likes, ["author_id"], [F.desc("created_at"), F.desc("like_id")], n, "position")
    body = posts.select("post_id", F.col("author_id").alias("post_author"), "text")
    return newest.join(body, "post_id")


def authored_feed(feed: DataFrame, n: int, strict: bool = False) -> DataFrame:
    """Per actor the first `n` distinct own uris in feed order.

    `feed`: (actor, author, uri, ordinal). Actors with fewer than `n` are reported with
    `enough` false, or fail the job when `strict`.
    """
    own = feed.filter(F.col("actor") == F.col("author"))
    first = own.groupBy("actor", "uri").agg(F.min("ordinal").alias("ordinal"))
    sizes = first.groupBy("actor").agg(F.count("*").alias("found"))
    taken = top_n(first, ["actor"], [F.col("ordinal"), F.col("uri")], n, "position")
    enough = F.col("found") >= n
    if strict:
        message = F.concat(F.lit(f"fewer than {n} posts for "), F.col("actor"))
        enough = F.when(enough, True).otherwise(F.raise_error(message))
    return taken.join(sizes, "actor").select("actor", "uri", "position", "found", enough.alias("enough"))
