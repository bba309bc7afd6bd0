"""Firehose frames -> typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions import variants as V
from starling.functions.plan import settle

COMMON_COLUMNS = ("uri", "did", "cid", "rev", "created_at", "ingested_at")
PAYLOAD_COLUMNS = {
    "posts": ("text", "langs", "reply_root_uri", "reply_parent_uri", "embed_type"),
    "likes": ("subject_uri", "subject_cid"),
    "reposts": ("subject_uri", "subject_cid"),
    "follows": ("subject_did",),
}
RECORD_FIELDS = (
    "struct<createdAt:variant,`$type`:variant,text:variant,langs:variant,"
    "reply:struct<root:struct<uri:variant>,parent:struct<uri:variant>>,"
    "embed:struct<`$type`:variant>,subject:variant>"
)
FRAME_FIELDS = (
    "struct<did:variant,kind:variant,time_us:variant,commit:struct<rev:variant,cid:variant,"
    f"operation:variant,collection:variant,rkey:variant,record:{RECORD_FIELDS}>>"
)
#: What names a record, without the record itself.
IDENTITY_FIELDS = (
    "struct<did:variant,commit:struct<rev:variant,cid:variant,operation:variant,collection:variant,rkey:variant>>"
)
ROW_SCHEMAS = {
    "posts": "uri string, did string, cid string, rev string, created_at timestamp, "
    "ingested_at timestamp, text string, langs array<string>, reply_root_uri string, "
    "reply_parent_uri string, embed_type string, run_id string",
    "likes": "uri string, did string, cid string, rev string, created_at timestamp, "
    "ingested_at timestamp, subject_uri string, subject_cid string, run_id string",
    "reposts": "uri string, did string, cid string, rev string, created_at timestamp, "
    "ingested_at timestamp, subject_uri string, subject_cid string, run_id string",
    "follows": "uri string, did string, cid string, rev string, created_at timestamp, "
    "ingested_at timestamp, subject_did string, run_id string",
}


def read_frames(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One row per line of the (possibly gzipped) captures under `path`."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path)


def decode(frames: DataFrame, column: str = "value") -> DataFrame:
    """Add `event`: the frame as VARIANT, NULL for blank or undecodable frames.

    The JSON reader stops after the first value, so a frame that goes on after its closing
    brace is caught by its last character.
    """
    # A frame that repeats a key keeps its last value, whoever built the session.
    frames.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.col(column).cast("string")
    whole = ~text.startswith("{") | text.rlike(r"\}\s*\z")
    event = F.when(whole, F.try_parse_json(text))
    # Settled, so that filters on fields of the event do not parse the text again.
    return settle(frames, {"event": event}, frames.columns)


def shred_frames(decoded: DataFrame) -> DataFrame:
    """Add `e`: the fields the parsers read, taken from each frame once."""
    return decoded.withColumn("e", V.shred(F.col("event"), FRAME_FIELDS))


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return decode(read_frames(spark, path, streaming)).filter(F.col("event").isNotNull())


def capture_tally(frames: DataFrame, column: str = "value") -> DataFrame:
    """Frames, unparseable frames and frames per record type, in one pass."""
    decoded = shred_frames(decode(frames, column))
    collection = V.as_str(F.col("e.commit.collection"))
    tracked = decoded.withColumn("record_type", record_type_of(collection))
    per_type = [
        F.count_if(F.col("record_type") == name).alias(name) for name in C.RECORD_TYPES
    ]
    return tracked.agg(
        F.count("*").alias("frames"),
        F.count_if(F.col("event").isNull()).alias("unparseable"),
        *per_type,
    )


def record_type_of(collection: Column) -> Column:
    mapping = [F.lit(x) for pair in C.COLLECTION_TO_RECORD_TYPE.items() for x in pair]
    return F.try_element_at(F.create_map(*mapping), collection)


def tracked_type() -> Column:
    """Record type of a commit with a did and rkey on a tracked collection, any operation."""
    whole = (F.col("kind") == "commit") & (F.col("did") != "") & (F.col("rkey") != "")
    return F.when(whole, record_type_of(F.col("collection")))


def at_uri(did: Column, collection: Column, rkey: Column) -> Column:
    whole = (did != "") & (collection != "") & (rkey != "")
    return F.when(whole, F.concat(F.lit("at://"), did, F.lit("/"), collection, F.lit("/"), rkey))


def payload(record: str) -> dict[str, Column]:
    """Type-specific columns of the shredded record `record`; each NULL where absent."""
    return {
        "text": V.as_str(F.col(f"{record}.text")),
        "langs": V.as_str_list(F.col(f"{record}.langs")),
        "reply_root_uri": V.as_str(F.col(f"{record}.reply.root.uri")),
        "reply_parent_uri": V.as_str(F.col(f"{record}.reply.parent.uri")),
        "embed_type": V.as_str(F.col(f"{record}.embed.`$type`")),
        "subject_uri": V.field_str(F.col(f"{record}.subject"), "uri"),
        "subject_cid": V.field_str(F.col(f"{record}.subject"), "cid"),
        "subject_did": V.as_str(F.col(f"{record}.subject")),
    }


def plausible(created_at: Column, ingested_at: Column) -> Column:
    """Within the backdate and look-ahead limits, or no ingest time to compare with."""
    low = ingested_at - F.expr(f"INTERVAL {C.MAX_BACKDATE.days} DAYS")
    high = ingested_at + F.expr(f"INTERVAL {C.MAX_AHEAD.days} DAYS")
    return ingested_at.isNull() | created_at.between(low, high)


def required_present(record_type: Column) -> Column:
    """Every required column of the row's own type is non-null."""
    check = F.lit(False)
    for name, columns in C.REQUIRED_COLUMNS.items():
        whole = F.lit(True)
        for column in columns:
            whole = whole & F.col(column).isNotNull()
        check = F.when(record_type == name, whole).otherwise(check)
    return check


def place(decoded: DataFrame) -> DataFrame:
    """Add `time_us`; frames without an integer position have no place in the stream."""
    position = V.as_bigint(F.try_variant_get(F.col("event"), "$.time_us", "variant"))
    return decoded.withColumn("time_us", position).filter(F.col("time_us").isNotNull())


def parse_common(placed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """uri, did, cid, rev, created_at (NULL when implausible), ingested_at and the payload.

    Each frame is read once: the typed values are settled before anything filters on them.
    """
    created = V.as_str(F.col("e.commit.record.createdAt"))
    raw = settle(
        shred_frames(placed),
        {
            "did": V.as_str(F.col("e.did")),
            "kind": V.as_str(F.col("e.kind")),
            "cid": V.as_str(F.col("e.commit.cid")),
            "rev": V.as_str(F.col("e.commit.rev")),
            "operation": V.as_str(F.col("e.commit.operation")),
            "collection": V.as_str(F.col("e.commit.collection")),
            "rkey": V.as_str(F.col("e.commit.rkey")),
            "created_raw": V.parse_created_at(created),
            **payload("e.commit.record"),
        },
        ["time_us", *keep],
    ).withColumn("ingested_at", V.parse_ingested_at(F.col("time_us")))
    return raw.withColumns(
        {
            "uri": at_uri(F.col("did"), F.col("collection"), F.col("rkey")),
            "created_at": F.when(
                plausible(F.col("created_raw"), F.col("ingested_at")), F.col("created_raw")
            ),
        }
    )


def parse_identity(placed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """uri, did, cid, rev and operation as `parse_common` gives them, without reading the record."""
    raw = settle(
        placed.withColumn("e", V.shred(F.col("event"), IDENTITY_FIELDS)),
        {
            "did": V.as_str(F.col("e.did")),
            "cid": V.as_str(F.col("e.commit.cid")),
            "rev": V.as_str(F.col("e.commit.rev")),
            "operation": V.as_str(F.col("e.commit.operation")),
            "collection": V.as_str(F.col("e.commit.collection")),
            "rkey": V.as_str(F.col("e.commit.rkey")),
        },
        list(keep),
    )
    return raw.withColumn("uri", at_uri(F.col("did"), F.col("collection"), F.col("rkey"))).drop("collection", "rkey")


def parse_envelopes(decoded: DataFrame) -> DataFrame:
    """Every placed frame; `record_type` is NULL where there is no row to store.

    Frames that are dropped stay as positions: they move the cursor.
    """
    rows = parse_common(place(decoded))
    stored = (F.col("kind") == "commit") & (F.col("operation") == "create")
    routed = rows.withColumn("_type", F.when(stored, record_type_of(F.col("collection"))))
    kept = routed.withColumn(
        "record_type", F.when(required_present(F.col("_type")), F.col("_type"))
    )
    columns = [*COMMON_COLUMNS, *dict.fromkeys(c for cs in PAYLOAD_COLUMNS.values() for c in cs)]
    return kept.select("time_us", "record_type", *columns)


def rows_of(parsed: DataFrame, record_type: str) -> DataFrame:
    """The rows of one record type with that table's columns."""
    columns = [*COMMON_COLUMNS, *PAYLOAD_COLUMNS[record_type]]
    return parsed.filter(F.col("record_type") == record_type).select(*columns)


def parse_event_log(decoded: DataFrame) -> DataFrame:
    """All operations on tracked collections; an unusable created_at becomes ingested_at."""
    rows = settle(
        shred_frames(decoded),
        {
            "did": V.as_str(F.col("e.did")),
            "kind": V.as_str(F.col("e.kind")),
            "collection": V.as_str(F.col("e.commit.collection")),
            "rkey": V.as_str(F.col("e.commit.rkey")),
            "cid": V.as_str(F.col("e.commit.cid")),
            "rev": V.as_str(F.col("e.commit.rev")),
            "operation": F.coalesce(V.as_str(F.col("e.commit.operation")), F.lit("unknown")),
            "ingested_at": V.parse_ingested_at(
                F.coalesce(V.as_bigint(F.col("e.time_us")), F.lit(0).cast("bigint"))
            ),
            "_created": V.parse_created_at(V.as_str(F.col("e.commit.record.createdAt"))),
            **payload("e.commit.record"),
        },
        [],
    )
    rows = rows.withColumn("record_type", tracked_type()).filter(F.col("record_type").isNotNull())
    limit = int(C.EVENT_LOG_MAX_SKEW.total_seconds() * 1_000_000)
    distance = F.abs(F.unix_micros("_created") - F.unix_micros("ingested_at"))
    usable = F.coalesce(distance <= limit, F.lit(False))
    return rows.select(
        "record_type",
        at_uri(F.col("did"), F.col("collection"), F.col("rkey")).alias("uri"),
        "did", "collection", "rkey", "cid", "rev", "operation",
        F.when(usable, F.col("_created")).otherwise(F.col("ingested_at")).alias("created_at"),
        "ingested_at",
        (~usable).alias("created_at_fallback"),
        "text", "langs", "reply_root_uri", "reply_parent_uri", "embed_type",
        F.length("text").alias("text_length"),
        "subject_uri", "subject_cid", "subject_did",
    )


def fallback_split(event_log: DataFrame) -> DataFrame:
    """Fallbacks caused by deletes and by unusable text, with their share of all rows."""
    deletes = F.count_if(F.col("created_at_fallback") & (F.col("operation") == "delete"))
    others = F.count_if(F.col("created_at_fallback") & (F.col("operation") != "delete"))
    total = F.count("*")
    return event_log.agg(
        total.alias("total_rows"),
        deletes.alias("delete_fallbacks"),
        others.alias("malformed_fallbacks"),
        F.coalesce(F.try_divide(deletes * 100.0, total), F.lit(0.0)).alias("delete_pct"),
        F.coalesce(F.try_divide(others * 100.0, total), F.lit(0.0)).alias("malformed_pct"),
    )


def project_to_schema(df: DataFrame, schema) -> DataFrame:
    """Declared columns in declared order; missing ones NULL, extras dropped."""
    columns = []
    for field in schema.fields:
        column = F.col(field.name) if field.name in df.columns else F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)
