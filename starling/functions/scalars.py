"""Small scalar functions over ids, timestamps, labels and billing keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.text import strip


def toxicity_tier(prob: Column) -> Column:
    return (
        F.when(prob <= C.TIER_LOW_MAX, "low")
        .when(prob >= C.TIER_HIGH_MIN, "high")
        .when(prob.isNotNull(), "medium")
    )


def normalize_bool(value: Column) -> Column:
    word = F.lower(strip(value.cast("string")))
    return F.when(word.isin(*C.TRUE_WORDS), True).when(word.isin(*C.FALSE_WORDS), False)


def format_contract_timestamp(ts: Column) -> Column:
    return F.date_format(ts, C.CONTRACT_TIMESTAMP_FORMAT)


def parse_contract_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(C.CONTRACT_TIMESTAMP_FORMAT))


def day_key(contract_timestamp: Column) -> Column:
    return F.substring(contract_timestamp, 1, 10)


def is_dataset_id(value: Column) -> Column:
    return value.rlike(C.DATASET_ID_PATTERN)


def require_dataset_id(value: Column) -> Column:
    message = F.concat(F.lit("dataset_id must match {platform}_{uuid}: "), value)
    return F.when(is_dataset_id(value), value).otherwise(F.raise_error(message))


def uri_rkey(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def uri_did(uri: Column) -> Column:
    return F.split_part(uri, F.lit("/"), F.lit(3))


def uri_collection(uri: Column) -> Column:
    return F.split_part(uri, F.lit("/"), F.lit(4))


def classify_error(message: Column) -> Column:
    lowered = F.lower(message)
    bucket = F.when(F.coalesce(message, F.lit("")) == "", F.lit(None))
    for name, needles in C.ERROR_BUCKETS:
        hit = lowered.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | lowered.contains(needle)
        bucket = bucket.when(hit, name)
    return bucket.otherwise("other")


def classify_key(key: Column) -> Column:
    tail = F.substring_index(key, "/", -1)
    metadata = key.contains("/metadata/") | key.startswith("metadata/")
    return (
        F.when(metadata & tail.endswith(".metadata.json"), "metadata-json")
        .when(metadata & tail.startswith("snap-") & tail.endswith(".avro"), "manifest-list")
        .when(metadata & tail.endswith(".avro"), "manifest")
        .when(metadata, "other")
        .when(key.contains("/raw/"), "raw")
        .when(key.contains("/data/") | tail.endswith(".parquet"), "data")
        .otherwise("other")
    )


def cost_tier(service: Column, operation: Column) -> Column:
    return (
        F.when(service == "glue", "glue")
        .when(operation.isin(*C.DELETE_TIER_OPERATIONS), "delete")
        .when(operation.isin(*C.PUT_TIER_OPERATIONS), "put")
        .otherwise("get")
    )


def tier_price(tier: Column) -> Column:
    price = F.when(F.lit(False), F.lit(0.0))
    for name, value in C.TIER_PRICES.items():
        price = price.when(tier == name, value)
    return price


def row_bytes(*columns: str) -> Column:
    """UTF-8 size of the row written as JSON."""
    return F.octet_length(F.to_json(F.struct(*columns)))


def hash_text(text: Column) -> Column:
    return F.sha2(text, 256)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def join_list(values: Column) -> Column:
    return F.coalesce(F.array_join(values, ";"), F.lit(""))


def normalize_subreddit(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "^r/", ""))


def label_from_prob(prob: Column) -> Column:
    return F.when(prob < 0.5, 0).when(prob.isNotNull(), 1)
