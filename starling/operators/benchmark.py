"""Feed questions over user, post, like and follow tables, and their data checks.

created_at is the contract timestamp text, whose string order is time order, so range
filters reach the Parquet scan as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.scalars import day_key


def posts_since(posts: DataFrame, start: str, limit: int = 100) -> DataFrame:
    """Newest first; the id breaks ties."""
    return (
        posts.filter(F.col("created_at") >= start)
        .orderBy(F.desc("created_at"), "post_id")
        .limit(limit)
    )


def top_posters(posts: DataFrame, start: str, limit: int = 100) -> DataFrame:
    counted = (
        posts.filter(F.col("created_at") >= start)
        .groupBy("author_id")
        .agg(F.count("*").alias("post_count"))
    )
    return counted.orderBy(F.desc("post_count"), "author_id").limit(limit)


def term_post_count(posts: DataFrame, start: str, term: str) -> DataFrame:
    recent = posts.filter(F.col("created_at") >= start)
    hit = F.lower("text").contains(term.lower())
    return recent.filter(hit).agg(F.count("*").alias("post_count"))


def posts_per_day(posts: DataFrame, start: str) -> DataFrame:
    recent = posts.filter(F.col("created_at") >= start)
    return (
        recent.groupBy(day_key(F.col("created_at")).alias("day"))
        .agg(F.count("*").alias("post_count"))
        .orderBy("day")
    )


def last_posts_by_author(posts: DataFrame, author: str, limit: int = 10) -> DataFrame:
    mine = posts.filter(F.col("author_id") == author)
    return mine.orderBy(F.desc("created_at"), "post_id").limit(limit)


def liked_posts(likes: DataFrame, posts: DataFrame, author: str, limit: int = 10) -> DataFrame:
    """The author's newest likes that have a post. The liker filter runs before the join."""
    mine = likes.filter(F.col("author_id") == author).select(
        "like_id", "post_id", F.col("created_at").alias("liked_at")
    )
    joined = mine.join(posts, "post_id")
    return joined.orderBy(F.desc("liked_at"), "like_id").limit(limit)


def stitch_liked_posts(likes: DataFrame, posts: DataFrame, author: str, limit: int = 10) -> DataFrame:
    """Newest likes first, then their posts: a like without a post makes the result shorter."""
    newest = (
        likes.filter(F.col("author_id") == author)
        .orderBy(F.desc("created_at"), "like_id")
        .limit(limit)
    )
    return posts.join(newest.select("post_id"), "post_id", "left_semi")


def self_likes(likes: DataFrame, posts: DataFrame) -> DataFrame:
    own = posts.select("post_id", F.col("author_id").alias("post_author"))
    joined = likes.join(own, "post_id").filter(F.col("author_id") == F.col("post_author"))
    return joined.select("like_id", "author_id", "post_id")


def duplicate_pairs(follows: DataFrame) -> DataFrame:
    counted = follows.groupBy("follower_id", "followee_id").agg(F.count("*").alias("copies"))
    return counted.filter(F.col("copies") > 1)


def sample_keys(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """`n` distinct keys without replacement; the same seed gives the same keys."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    return rows.select(key).distinct().orderBy(draw, key).limit(n)


def read_page(rows: DataFrame, ordinal: str, offset: int, limit: int) -> DataFrame:
    return rows.orderBy(ordinal).offset(offset).limit(limit)


def check_unique(rows: DataFrame, key: str) -> DataFrame:
    counted = rows.groupBy(key).agg(F.count("*").alias("copies"))
    return counted.filter(F.col("copies") > 1)


def check_format(rows: DataFrame, column: str, pattern: str, ordinal: str) -> DataFrame:
    """The first offending value, or no row."""
    bad = rows.filter(~F.col(column).rlike(pattern))
    first = bad.agg(F.min_by(column, ordinal).alias("first_bad"), F.count("*").alias("bad_rows"))
    return first.filter(F.col("bad_rows") > 0)


def check_caps(counts: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """(table_name, row_count, cap, ok) per table."""
    out: DataFrame | None = None
    for name, (rows, cap) in counts.items():
        one = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(cap).cast("bigint").alias("cap"),
            (F.col("row_count") <= cap).alias("ok"),
        )
        out = one if out is None else out.union(one)
    return out


def post_count_by_day(posts: DataFrame, days: list[str], created_at: Column) -> DataFrame:
    """Posts per date of the list, and a total row whose day is NULL."""
    day = F.to_date(created_at)
    picked = posts.withColumn("day", day).filter(F.col("day").isin(*[F.lit(d).cast("date") for d in days]))
    return picked.rollup("day").agg(F.count("*").alias("post_count"))
