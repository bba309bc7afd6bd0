"""Sources, parsing and routing of firehose frames; repo records; event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions import variants as V
from starling.operators import records as R
from starling.plans import views as VW
from starling.plans.registry import big, duck_stamp, query, stamp
from starling.plans.views import duck
from starling.sources import envelopes as E

AS_OF = "2024-01-31 00:00:00"


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    return E.decode(VW.frames(spark, sf)).filter(F.col("event").isNotNull())


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return E.parse_envelopes(decoded(spark, sf))


@query("S1_read_envelopes", duck("SELECT value FROM v_frames WHERE json_valid(value)", "frames"))
def read_envelopes(spark, sf):
    return decoded(spark, sf).select("value")


@query(
    "P1_parse_common",
    duck(f"SELECT uri, did, cid, rev, {duck_stamp('ingested_at')} AS ingested, {duck_stamp('created_at')} AS created FROM v_parsed", "parsed"),
)
def parse_common(spark, sf):
    rows = E.parse_common(E.place(decoded(spark, sf)))
    return rows.select("uri", "did", "cid", "rev", stamp("ingested_at").alias("ingested"), stamp("created_at").alias("created"))


@query(
    "P2_type_guards",
    duck("SELECT did, text, created_text, langs_joined, subject_did FROM v_parsed", "parsed"),
)
def type_guards(spark, sf):
    record = "e.commit.record"
    return E.shred_frames(decoded(spark, sf)).select(
        V.as_str(F.col("e.did")).alias("did"),
        V.as_str(F.col(f"{record}.text")).alias("text"),
        V.as_str(F.col(f"{record}.createdAt")).alias("created_text"),
        F.array_join(V.as_str_list(F.col(f"{record}.langs")), ";").alias("langs_joined"),
        V.as_str(F.col(f"{record}.subject")).alias("subject_did"),
    )


@query("P3_parse_created_at", duck(f"SELECT created_text, {duck_stamp('created_raw')} AS created FROM v_parsed", "parsed"))
def parse_created_at(spark, sf):
    text = V.as_str(F.col("e.commit.record.createdAt"))
    return E.shred_frames(decoded(spark, sf)).select(text.alias("created_text")).withColumn(
        "created", stamp(V.parse_created_at(F.col("created_text")))
    )


@query("P4_parse_ingested_at", duck(f"SELECT time_us, {duck_stamp('ingested_at')} AS ingested FROM v_parsed", "parsed"))
def parse_ingested_at(spark, sf):
    return E.place(decoded(spark, sf)).select("time_us").withColumn(
        "ingested", stamp(V.parse_ingested_at(F.col("time_us")))
    )


def _rows_sql(record_type: str, columns: str) -> str:
    return duck(
        f"SELECT uri, did, {duck_stamp('created_at')} AS created, {columns} FROM v_stored WHERE record_type = '{record_type}'",
        "stored",
    )


def _rows(spark, sf, record_type, *columns):
    rows = E.rows_of(parsed(spark, sf), record_type)
    return rows.select("uri", "did", stamp("created_at").alias("created"), *columns)


@query("P5_parse_post", _rows_sql("posts", "text, langs_joined, reply_root_uri, reply_parent_uri, embed_type"))
def parse_post(spark, sf):
    langs = F.array_join("langs", ";").alias("langs_joined")
    return _rows(spark, sf, "posts", "text", langs, "reply_root_uri", "reply_parent_uri", "embed_type")


@query("P6_parse_like", _rows_sql("likes", "subject_uri, subject_cid"))
def parse_like(spark, sf):
    return _rows(spark, sf, "likes", "subject_uri", "subject_cid")


@query("P6_parse_repost", _rows_sql("reposts", "subject_uri, subject_cid"))
def parse_repost(spark, sf):
    return _rows(spark, sf, "reposts", "subject_uri", "subject_cid")


@query("P7_parse_follow", _rows_sql("follows", "subject_did"))
def parse_follow(spark, sf):
    return _rows(spark, sf, "follows", "subject_did")


@query(
    "P8_route_records",
    duck("SELECT record_type, count(*) AS n_rows FROM v_stored GROUP BY record_type", "stored"),
)
def route_records(spark, sf):
    routed = parsed(spark, sf).filter(F.col("record_type").isNotNull())
    return routed.groupBy("record_type").agg(F.count("*").alias("n_rows"))


@query(
    "P9_parse_event_log",
    duck(
        f"SELECT record_type, uri, cid, operation, {duck_stamp('created_at')} AS created, {duck_stamp('ingested_at')} AS ingested, "
        "created_at_fallback, CAST(length(text) AS BIGINT) AS text_length, embed_type, subject_uri FROM v_event_log",
        "event_log",
    ),
)
def parse_event_log(spark, sf):
    log = event_log(spark, sf)
    return log.select(
        "record_type", "uri", "cid", "operation", stamp("created_at").alias("created"),
        stamp("ingested_at").alias("ingested"), "created_at_fallback",
        big("text_length").alias("text_length"), "embed_type", "subject_uri",
    )


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return E.parse_event_log(E.decode(VW.collapsing_frames(spark, sf)))


@query(
    "A24_fallback_split",
    duck(
        "SELECT count(*) AS total_rows, count_if(created_at_fallback AND operation = 'delete') AS delete_fallbacks, "
        "count_if(created_at_fallback AND operation <> 'delete') AS malformed_fallbacks, "
        "round(count_if(created_at_fallback AND operation = 'delete') * 100.0::DOUBLE / count(*), 6) AS delete_pct, "
        "round(count_if(created_at_fallback AND operation <> 'delete') * 100.0::DOUBLE / count(*), 6) AS malformed_pct FROM v_event_log",
        "event_log",
    ),
)
def fallback_split(spark, sf):
    split = E.fallback_split(event_log(spark, sf))
    return split.withColumns({c: F.round(F.col(c), 6) for c in ("delete_pct", "malformed_pct")})


@query(
    "A28_capture_tally",
    duck(
        "SELECT count(*) AS frames, count_if(NOT json_valid(value)) AS unparseable, "
        + ", ".join(
            f"count_if(CASE WHEN json_valid(value) THEN json_extract_string(value, '$.commit.collection') = '{c}' ELSE false END) AS {t}"
            for c, t in C.COLLECTION_TO_RECORD_TYPE.items()
        )
        + " FROM v_frames",
        "frames",
    ),
)
def capture_tally(spark, sf):
    return E.capture_tally(VW.frames(spark, sf))


@query(
    "F1_required_non_null",
    duck(
        "SELECT tracked AS record_type, count(*) AS n_rows, count_if(uri IS NOT NULL AND created_at IS NOT NULL AND ingested_at IS NOT NULL "
        "AND (tracked = 'posts' OR (tracked IN ('likes','reposts') AND subject_uri IS NOT NULL) OR (tracked = 'follows' AND subject_did IS NOT NULL))) AS whole "
        "FROM v_parsed GROUP BY tracked",
        "parsed",
    ),
)
def required_non_null(spark, sf):
    placed = E.parse_common(E.place(decoded(spark, sf)))
    typed = placed.withColumn("record_type", E.record_type_of(F.col("collection")))
    whole = F.count_if(E.required_present(F.col("record_type")))
    return typed.groupBy("record_type").agg(F.count("*").alias("n_rows"), whole.alias("whole"))


_PLAUSIBLE_SQL = (
    "SELECT tracked AS record_type, count_if(created_raw IS NOT NULL) AS dated, count(created_at) AS plausible, "
    "count_if(created_raw < ingested_at - INTERVAL 7 DAY) AS too_old, count_if(created_raw > ingested_at + INTERVAL 1 DAY) AS too_new "
    "FROM v_parsed GROUP BY tracked"
)


def plausibility(spark, sf):
    rows = E.parse_common(E.place(decoded(spark, sf))).withColumnRenamed("created_raw", "raw")
    seen = F.col("ingested_at")
    return rows.groupBy(E.record_type_of(F.col("collection")).alias("record_type")).agg(
        F.count("raw").alias("dated"),
        F.count("created_at").alias("plausible"),
        F.count_if(F.col("raw") < seen - F.expr("INTERVAL 7 DAYS")).alias("too_old"),
        F.count_if(F.col("raw") > seen + F.expr("INTERVAL 1 DAYS")).alias("too_new"),
    )


query("F2_created_at_plausible", duck(_PLAUSIBLE_SQL, "parsed"))(plausibility)
query("ST4_late_data_policy", duck(_PLAUSIBLE_SQL, "parsed"))(plausibility)


@query(
    "F3_usable_position",
    duck(
        "SELECT count(*) AS positions, count_if(NOT coalesce(kind = 'commit' AND operation = 'create' AND tracked IS NOT NULL AND uri IS NOT NULL "
        "AND created_at IS NOT NULL AND (tracked = 'posts' OR (tracked IN ('likes','reposts') AND subject_uri IS NOT NULL) OR (tracked = 'follows' AND subject_did IS NOT NULL)), false)) AS unstored, "
        "max(time_us) AS last_time_us FROM v_parsed",
        "parsed",
    ),
)
def usable_position(spark, sf):
    return parsed(spark, sf).agg(
        F.count("*").alias("positions"),
        F.count_if(F.col("record_type").isNull()).alias("unstored"),
        F.max("time_us").alias("last_time_us"),
    )


_REPO_POSTS = "FROM v_repo WHERE did IS NOT NULL AND tracked = 'posts'"


@query(
    "P10_build_post_row",
    duck(
        "SELECT did, uri, created_text AS created_at, coalesce(text, '') AS text, is_reply, reply_parent_uri, reply_root_uri, "
        "coalesce(langs_joined, '') AS langs, regexp_extract(embed_type, '[^.]*$') AS embed_type, quoted_uri AS quoted_post_uri, "
        f"mentions AS mentioned_dids, links AS linked_uris {_REPO_POSTS}",
        "repo",
    ),
)
def build_post_row(spark, sf):
    return R.typed_records(VW.repo_records(spark, sf), "posts")


@query("P11_quoted_post_uri", duck(f"SELECT uri, embed_type, quoted_uri {_REPO_POSTS}", "repo"))
def quoted(spark, sf):
    posts = R.classify_records(VW.repo_records(spark, sf)).filter("output = 'posts'")
    return posts.select("uri", R.embed_kind().alias("embed_type"), R.quoted_post_uri().alias("quoted_uri"))


@query("P12_facet_extract", duck(f"SELECT uri, mentions, links {_REPO_POSTS}", "repo"))
def facets(spark, sf):
    posts = R.classify_records(VW.repo_records(spark, sf)).filter("output = 'posts'")
    return posts.select(
        "uri",
        R.facet_values(C.MENTION_FACET).alias("mentions"),
        R.facet_values(C.LINK_FACET).alias("links"),
    )


def _feed_uris(spark, sf):
    """Post uris of every frame that names a post, deletes included: some have no record."""
    rows = E.parse_common(E.place(decoded(spark, sf)))
    return rows.filter((F.col("collection") == "app.bsky.feed.post") & F.col("uri").isNotNull()).select("uri")


@query(
    "P13_post_metrics_row",
    duck(
        "SELECT p.uri AS post_uri, p.rkey AS post_rkey, created_text AS created_at, 'unknown' AS deleted, CAST(NULL AS VARCHAR) AS deleted_at, "
        "CASE WHEN f THEN CASE WHEN is_reply THEN 'reply' ELSE 'original' END END AS post_type, "
        "CASE WHEN f THEN coalesce(CASE WHEN embed_type = 'app.bsky.embed.recordWithMedia' THEN media_type ELSE embed_type END = 'app.bsky.embed.images', false) END AS has_image, "
        "CASE WHEN f THEN coalesce(CASE WHEN embed_type = 'app.bsky.embed.recordWithMedia' THEN media_type ELSE embed_type END = 'app.bsky.embed.video', false) END AS has_video, "
        "CASE WHEN f THEN coalesce(langs_joined, '') END AS langs "
        "FROM (SELECT *, operation = 'create' AS f FROM v_parsed) p WHERE collection = 'app.bsky.feed.post' AND uri IS NOT NULL",
        "parsed",
    ),
)
def post_metrics(spark, sf):
    posts = R.classify_records(VW.repo_records(spark, sf)).filter("output = 'posts'").select("uri", "record")
    return R.post_metrics(_feed_uris(spark, sf), posts)


@query(
    "J5_enrich_with_engagement",
    duck(
        "SELECT post_uri, like_count, reply_count, repost_count, quote_count, save_count, '2024-01-31T00:00:00+00:00' AS counts_read_at "
        "FROM (SELECT uri AS post_uri, post_id FROM v_posts) LEFT JOIN (SELECT uri AS post_uri, like_count, reply_count, repost_count, quote_count, post_id % 5 AS save_count "
        "FROM v_posts WHERE lang <> 'de') USING (post_uri)",
        "posts",
    ),
)
def engagement(spark, sf):
    posts = VW.posts(spark, sf)
    rows = posts.select(F.col("uri").alias("post_uri"))
    counts = posts.filter("lang <> 'de'").select(
        F.col("uri").alias("post_uri"), "like_count", "reply_count", "repost_count", "quote_count",
        (F.col("post_id") % 5).alias("bookmark_count"),
    )
    return R.enrich_with_engagement(rows, counts, "2024-01-31T00:00:00+00:00")


@query(
    "P14_normalize_search_post",
    duck(
        "SELECT uri, 'https://bsky.app/profile/' || author_handle || '/post/' || post_id AS url, author_handle, text, "
        f"{duck_stamp('created_at')} AS created_at, like_count, repost_count, reply_count, quote_count FROM v_posts",
        "posts",
    ),
)
def search_posts(spark, sf):
    return R.normalize_search_posts(VW.posts(spark, sf).withColumn("created_at", stamp("created_at")))


@query(
    "P15_normalize_tweet",
    duck(
        "SELECT CAST(o_orderkey AS VARCHAR) AS tweet_id, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END, '') AS text, CAST(o_custkey AS VARCHAR) AS author_id, "
        "coalesce(c_name, '') AS username, strftime(o_orderdate, '%Y-%m-%d') AS created_at, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END, 0) AS like_count, "
        "0 AS retweet_count, o_orderkey % 5 AS reply_count, 0 AS quote_count, 'https://x.com/i/web/status/' || o_orderkey AS url, o_orderstatus AS keyword, '2024_01_31-00:00:00' AS sync_timestamp "
        "FROM orders LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey"
    ),
)
def tweets(spark, sf):
    orders = VW.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    rows = orders.select(
        key.alias("id"), F.when(key % 7 != 0, F.col("o_orderpriority")).alias("text"),
        F.col("o_custkey").alias("author_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.when(key % 3 != 0, F.col("o_custkey")).alias("like_count"), F.lit(None).cast("int").alias("retweet_count"),
        (key % 5).alias("reply_count"), F.lit(None).cast("int").alias("quote_count"),
        F.col("o_orderstatus").alias("keyword"),
    )
    users = VW.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
    return R.normalize_tweets(rows, users.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username")), "2024_01_31-00:00:00")


@query(
    "P16_normalize_comment",
    duck(
        "SELECT comment_id, coalesce(CASE WHEN author <> 'system' AND ordinal <> 4 THEN author END, '[deleted]') AS author, body, "
        "strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS created_utc, score FROM v_comments",
        "comments",
    ),
)
def comments(spark, sf):
    rows = VW.comments(spark, sf)
    author = F.when((F.col("author") != "system") & (F.col("ordinal") != 4), F.col("author"))
    return rows.select(
        "comment_id", R.author_name(author).alias("author"), "body",
        R.epoch_iso(F.col("created_utc")).alias("created_utc"), "score",
    )


@query(
    "P17_canonicalize_columns",
    "SELECT doc_id AS post_id, source AS post_handle, text AS post, lang AS post_timestamp FROM documents",
)
def canonical(spark, sf):
    documents = VW.table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_primary_key"), F.col("source").alias("handle"),
        F.col("text").alias("original_text"), F.col("lang").alias("post_timestamp"),
    )
    return R.canonicalize_columns(documents, C.EXAMPLE_COLUMN_ALIASES)


@query(
    "P20_posts_for_api",
    duck(
        f"SELECT uri, coalesce(CASE WHEN post_id % 13 <> 0 THEN text END, '') AS text, coalesce(CASE WHEN post_id % 17 <> 0 THEN {duck_stamp('created_at')} END, '') AS preprocessing_timestamp "
        "FROM v_posts WHERE post_id % 19 <> 0",
        "posts",
    ),
)
def api_posts(spark, sf):
    k = F.col("post_id")
    rows = VW.posts(spark, sf).select(
        F.when(k % 19 != 0, F.col("uri")).alias("uri"), F.when(k % 13 != 0, F.col("text")).alias("text"),
        F.when(k % 17 != 0, stamp("created_at")).alias("created_at"),
    )
    return R.posts_for_api(rows)


@query(
    "P21_build_query",
    "SELECT p_name, term, term || ' lang:en -is:reply -is:retweet -is:quote' AS query FROM (SELECT DISTINCT p_name, "
    "CASE WHEN regexp_matches(p_name, '[ \":()]') THEN '\"' || replace(p_name, '\"', '\\\"') || '\"' ELSE p_name END AS term "
    "FROM (SELECT p_name FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT 'a\"b:' || p_brand FROM part))",
)
def build_query(spark, sf):
    part = VW.table(spark, sf, "part")
    words = part.select("p_name").union(part.select("p_type")).union(part.select(F.concat(F.lit('a"b:'), "p_brand")))
    name = F.col("p_name")
    return words.distinct().select("p_name", R.quote_query_term(name).alias("term"), R.build_query(name).alias("query"))


@query(
    "P22_project_to_schema",
    duck("SELECT uri, text, CAST(NULL AS VARCHAR) AS run_id, CAST(like_count AS VARCHAR) AS like_count FROM v_posts", "posts"),
)
def project(spark, sf):
    schema = spark.createDataFrame([], "uri string, text string, run_id string, like_count string").schema
    return E.project_to_schema(VW.posts(spark, sf), schema)


@query(
    "C4_classify_records",
    duck(
        "SELECT output, count(*) AS n FROM (SELECT tracked AS output FROM v_repo WHERE did IS NOT NULL UNION ALL SELECT 'profile' FROM customer) GROUP BY output",
        "repo",
    ),
)
def classify(spark, sf):
    return R.classify_records(VW.repo_records(spark, sf)).groupBy("output").agg(F.count("*").alias("n"))


@query(
    "C5_backfill_rows",
    duck(
        f"SELECT tracked AS record_type, uri, did, cid, rev, {duck_stamp('created_raw')} AS created, text, subject_uri, subject_did FROM v_repo "
        f"WHERE created_raw >= TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY AND created_raw <= TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY "
        "AND (tracked = 'posts' OR (tracked IN ('likes','reposts') AND subject_uri IS NOT NULL) OR (tracked = 'follows' AND subject_did IS NOT NULL))",
        "repo",
    ),
)
def backfill(spark, sf):
    at = F.lit(AS_OF).cast("timestamp")
    rows = R.backfill_rows(VW.repo_records(spark, sf), at, 5)
    return rows.select(
        "record_type", "uri", "did", "cid", "rev", stamp("created_at").alias("created"),
        "text", "subject_uri", "subject_did",
    )


@query(
    "F18_in_window",
    duck(
        "SELECT uri, created_text, coalesce(regexp_matches(created_text, 'T.*(Z|[+]02:00)$') AND created_raw >= TIMESTAMP '2024-01-10' AND created_raw <= TIMESTAMP '2024-01-20', false) AS inside "
        "FROM v_repo WHERE did IS NOT NULL",
        "repo",
    ),
)
def window_filter(spark, sf):
    shredded = R.shred_records(VW.repo_records(spark, sf)).filter(F.col("kind") != C.PROFILE_TYPE)
    rows = shredded.select("uri", R.created_text().alias("created_text"))
    low, high = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20").cast("timestamp")
    return rows.select("uri", "created_text", R.in_window(F.col("created_text"), low, high).alias("inside"))


@query(
    "F19_since_cutoff",
    duck(f"SELECT uri, tracked AS record_type FROM v_repo WHERE created_raw >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY", "repo"),
)
def recent_records(spark, sf):
    rows = R.since_cutoff(VW.repo_records(spark, sf), F.lit(AS_OF).cast("timestamp"), 10)
    return rows.select("uri", "record_type")


@query(
    "F20_is_eligible_comment",
    duck("SELECT comment_id FROM v_comments WHERE NOT stickied AND distinguished IS NULL AND length(trim(body, chr(10) || ' ')) >= 200", "comments"),
)
def eligible(spark, sf):
    rows = VW.comments(spark, sf)
    ok = R.eligible_comment(F.col("body"), F.col("stickied"), F.col("distinguished"), 200)
    return rows.filter(ok).select("comment_id")


@query(
    "F24_drop_blank_text",
    duck("SELECT doc_id, post AS text FROM (SELECT doc_id, unnest(string_split(replace(text, '. ', chr(10)), chr(10))) AS post FROM documents) WHERE trim(post) <> ''"),
)
def nonblank(spark, sf):
    responses = VW.table(spark, sf, "documents").select(
        "doc_id", F.split(F.replace("text", F.lit(". "), F.lit("\n")), "\n").alias("posts")
    )
    return R.drop_blank_text(responses)
