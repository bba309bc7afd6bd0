"""Repo records, search results, tweets and submissions -> flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions import variants as V
from starling.functions.keep import keep_last
from starling.functions.plan import settle
from starling.functions.scalars import join_list, uri_rkey
from starling.functions.text import SPACE, is_blank, strip
from starling.sources import envelopes as E

# What the jobs read of a repo record, taken from it once as column `r`.
RECORD_FIELDS = (
    "struct<createdAt:variant,`$type`:variant,text:variant,langs:variant,reply:variant,"
    "embed:struct<`$type`:variant,record:struct<uri:variant,record:struct<uri:variant>>,"
    "media:struct<`$type`:variant>>,facets:variant,subject:variant,"
    "displayName:variant,description:variant>"
)


def shred_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Add `r` (see RECORD_FIELDS) and `kind`, the record's $type.

    `kind` is read on its own: filters on it run before a record is taken apart.
    """
    kind = V.as_str(F.try_variant_get(F.col(record), '$["$type"]', "variant"))
    return records.withColumns({"kind": kind, "r": V.shred(F.col(record), RECORD_FIELDS)})


def created_text() -> Column:
    return V.as_str(F.col("r.createdAt"))


def is_reply() -> Column:
    return V.is_present(F.col("r.reply"))


def reply_uri(which: str) -> Column:
    return V.field_str(F.col("r.reply"), f"{which}.uri")


def embed_kind() -> Column:
    return V.as_str(F.col("r.embed.`$type`"))


def quoted_post_uri() -> Column:
    return F.when(embed_kind() == C.QUOTE, V.as_str(F.col("r.embed.record.uri"))).when(
        embed_kind() == C.QUOTE_WITH_MEDIA, V.as_str(F.col("r.embed.record.record.uri"))
    )


def facet_values(kind: tuple[str, str]) -> Column:
    """Values of one feature kind over all facets, in order, joined with ';'."""
    feature_type, field = kind

    def features_of(facet: Column) -> Column:
        found = V.as_variant_list(F.try_variant_get(facet, "$.features", "variant"))
        return F.coalesce(found, F.array().cast("array<variant>"))

    features = F.flatten(F.transform(V.as_variant_list(F.col("r.facets")), features_of))
    wanted = F.filter(
        features,
        lambda item: F.try_variant_get(item, '$["$type"]', "string") == feature_type,
    )
    return join_list(F.transform(wanted, lambda item: F.try_variant_get(item, f"$.{field}", "string")))


def post_row() -> dict[str, Column]:
    return {
        "created_at": created_text(),
        "text": F.coalesce(V.as_str(F.col("r.text")), F.lit("")),
        "is_reply": is_reply(),
        "reply_parent_uri": reply_uri("parent"),
        "reply_root_uri": reply_uri("root"),
        "langs": join_list(V.as_str_list(F.col("r.langs"))),
        "embed_type": F.substring_index(embed_kind(), ".", -1),
        "quoted_post_uri": quoted_post_uri(),
        "mentioned_dids": facet_values(C.MENTION_FACET),
        "linked_uris": facet_values(C.LINK_FACET),
    }


def like_or_repost_row() -> dict[str, Column]:
    return {
        "created_at": created_text(),
        "subject_uri": V.field_str(F.col("r.subject"), "uri"),
        "subject_cid": V.field_str(F.col("r.subject"), "cid"),
    }


def follow_row() -> dict[str, Column]:
    return {"created_at": created_text(), "followed_did": V.as_str(F.col("r.subject"))}


def profile_row() -> dict[str, Column]:
    return {
        "display_name": V.as_str(F.col("r.displayName")),
        "description": V.as_str(F.col("r.description")),
        "created_at": created_text(),
    }


def classify_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Add `r`, `kind` and `output`: one of the four record types or 'profile'; others go."""
    shredded = shred_records(records, record)
    output = F.when(F.col("kind") == C.PROFILE_TYPE, "profile").otherwise(E.record_type_of(F.col("kind")))
    return shredded.withColumn("output", output).filter(F.col("output").isNotNull())


def typed_records(records: DataFrame, output: str, record: str = "record") -> DataFrame:
    """Rows of one output; profiles keep the last per account by uri."""
    builders = {"posts": post_row, "likes": like_or_repost_row, "reposts": like_or_repost_row,
                "follows": follow_row, "profile": profile_row}
    rows = classify_records(records, record).filter(F.col("output") == output)
    built = rows.select("did", "uri", *[c.alias(n) for n, c in builders[output]().items()])
    return keep_last(built, ["did"], ["uri"]) if output == "profile" else built


def backfill_rows(
    records: DataFrame, ingested_at: Column, days_back: int | None, record: str = "record"
) -> DataFrame:
    """Repo records (did, uri, cid, rev, record) as rows of the stream tables.

    The account-wide rev and the fetch clock stand in for the stream's per-commit rev
    and broker clock. `days_back` of None keeps every plausible record.
    """
    shredded = records.withColumn("r", V.shred(F.col(record), E.RECORD_FIELDS))
    rows = settle(
        shredded,
        {
            "ingested_at": ingested_at,
            "record_type": E.record_type_of(V.as_str(F.col("r.`$type`"))),
            "created_at": V.parse_created_at(created_text()),
            **E.payload("r"),
        },
        records.columns,
    )
    keep = F.col("record_type").isNotNull() & E.plausible(F.col("created_at"), F.col("ingested_at"))
    if days_back is not None:
        keep = keep & (
            F.col("created_at") >= F.col("ingested_at") - F.expr(f"INTERVAL {days_back} DAYS")
        )
    kept = rows.filter(keep).filter(E.required_present(F.col("record_type")))
    payload = dict.fromkeys(c for cs in E.PAYLOAD_COLUMNS.values() for c in cs)
    return kept.select("record_type", *E.COMMON_COLUMNS, *payload)


def since_cutoff(records: DataFrame, as_of: Column, days: int, record: str = "record") -> DataFrame:
    """Records of the four collections created in the last `days` days before `as_of`."""
    shredded = shred_records(records, record)
    typed = shredded.withColumn("record_type", E.record_type_of(F.col("kind")))
    recent = V.parse_created_at(created_text()) >= as_of - F.expr(f"INTERVAL {days} DAYS")
    return typed.filter(F.col("record_type").isNotNull() & recent)


def in_window(created: Column, start: Column, end: Column) -> Column:
    """Inside the closed interval; text without an offset is never inside."""
    at = F.when(V.has_offset(created), V.parse_created_at(created))
    return F.coalesce(at.between(start, end), F.lit(False))


def post_metrics(uris: DataFrame, records: DataFrame, record: str = "record") -> DataFrame:
    """One row per post uri; a uri without a record keeps its identity and NULLs.

    `records` holds one row per uri.
    """
    attached = V.as_str(F.col("r.embed.media.`$type`"))
    media = F.when(embed_kind() == C.QUOTE_WITH_MEDIA, attached).otherwise(embed_kind())
    found = F.col("_found").isNotNull()
    known = shred_records(records, record).withColumn("_found", F.lit(True))
    joined = uris.join(known, "uri", "left")
    return joined.select(
        F.col("uri").alias("post_uri"),
        uri_rkey(F.col("uri")).alias("post_rkey"),
        F.when(found, created_text()).alias("created_at"),
        F.lit("unknown").alias("deleted"),
        F.lit(None).cast("string").alias("deleted_at"),
        F.when(found, F.when(is_reply(), "reply").otherwise("original")).alias(
            "post_type"
        ),
        F.when(found, F.coalesce(media == C.IMAGES, F.lit(False))).alias("has_image"),
        F.when(found, F.coalesce(media == C.VIDEO, F.lit(False))).alias("has_video"),
        F.when(found, join_list(V.as_str_list(F.col("r.langs")))).alias("langs"),
    )


def enrich_with_engagement(rows: DataFrame, engagement: DataFrame, read_at: str) -> DataFrame:
    """Left join five counts by uri; every row gets the reading time.

    `engagement`: (post_uri, like_count, reply_count, repost_count, quote_count,
    bookmark_count), one row per post_uri.
    """
    counts = engagement.select(
        "post_uri", "like_count", "reply_count", "repost_count", "quote_count",
        F.col("bookmark_count").alias("save_count"),
    )
    return rows.join(counts, "post_uri", "left").withColumn("counts_read_at", F.lit(read_at))


def search_post(uri: Column, handle: Column) -> Column:
    """Web address of a post."""
    return F.concat(F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"), uri_rkey(uri))


def normalize_search_posts(posts: DataFrame) -> DataFrame:
    return posts.select(
        "uri", search_post(F.col("uri"), F.col("author_handle")).alias("url"), "author_handle",
        "text", "created_at", "like_count", "repost_count", "reply_count", "quote_count",
    )


def normalize_tweets(tweets: DataFrame, users: DataFrame, sync_timestamp: str) -> DataFrame:
    """Tweets with usernames from the page's user list, one row per user id."""
    names = users.select(F.col("id").cast("string").alias("author_id"), "username")
    tweet_id = F.col("id").cast("string")
    flat = tweets.withColumn("author_id", F.coalesce(F.col("author_id").cast("string"), F.lit("")))
    counts = ["like_count", "retweet_count", "reply_count", "quote_count"]
    return flat.join(names, "author_id", "left").select(
        tweet_id.alias("tweet_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        "author_id",
        F.coalesce("username", F.lit("")).alias("username"),
        F.coalesce(F.col("created_at").cast("string"), F.lit("")).alias("created_at"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        F.concat(F.lit("https://x.com/i/web/status/"), tweet_id).alias("url"),
        "keyword",
        F.lit(sync_timestamp).alias("sync_timestamp"),
    )


def epoch_iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ssxxx")


def author_name(author: Column) -> Column:
    return F.coalesce(author, F.lit(C.DELETED_AUTHOR))


def eligible_comment(body: Column, stickied: Column, distinguished: Column, min_length: int) -> Column:
    long_enough = F.length(strip(F.coalesce(body, F.lit("")))) >= min_length
    return ~stickied & distinguished.isNull() & long_enough


def canonicalize_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each canonical name from the first of its aliases that `df` has."""
    picked = []
    for name, options in aliases.items():
        present = [option for option in options if option in df.columns]
        if not present:
            raise KeyError(f"none of {list(options)} found for {name}")
        picked.append(F.col(present[0]).alias(name))
    return df.select(*picked)


def posts_for_api(posts: DataFrame) -> DataFrame:
    created = F.coalesce(F.col("created_at").cast("string"), F.lit(""))
    return posts.filter(F.col("uri").isNotNull()).select(
        "uri", F.coalesce("text", F.lit("")).alias("text"), created.alias("preprocessing_timestamp")
    )


def quote_query_term(keyword: Column) -> Column:
    special = keyword.rlike(f'{SPACE}|[":()]')
    escaped = F.replace(keyword, F.lit('"'), F.lit('\\"'))
    return F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(keyword)


def build_query(keyword: Column, lang: str = "en", exclude: Sequence[str] = tuple(C.EXCLUDE_CLAUSES)) -> Column:
    clauses = [C.EXCLUDE_CLAUSES[name] for name in exclude if name in C.EXCLUDE_CLAUSES]
    return F.concat_ws(" ", quote_query_term(keyword), F.lit(f"lang:{lang}"), *[F.lit(c) for c in clauses])


def drop_blank_text(responses: DataFrame, posts_column: str = "posts") -> DataFrame:
    """One row per generated post of each response, without blank texts."""
    rows = responses.select(
        *[c for c in responses.columns if c != posts_column], F.explode(posts_column).alias("text")
    )
    return rows.filter(~is_blank(F.col("text")))
