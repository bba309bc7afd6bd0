"""Type-strict reads from JSON held as VARIANT.

A field of the wrong JSON type reads as NULL; it is never converted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instants outside years 1..9999 do not exist as timestamps.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999


def shred(v: Column, schema: str) -> Column:
    """The fields of `schema` (structs with VARIANT leaves) in one pass over the value.

    A struct where the JSON has something else is NULL, and so are its leaves.
    """
    return F.try_variant_get(v, "$", schema)


def leaf_type(leaf: Column) -> Column:
    return F.schema_of_variant(leaf)


def as_str(leaf: Column) -> Column:
    return F.when(leaf_type(leaf) == "STRING", leaf.cast("string"))


def as_bigint(leaf: Column) -> Column:
    return F.when(leaf_type(leaf) == "BIGINT", F.try_variant_get(leaf, "$", "bigint"))


def field_str(leaf: Column, name: str) -> Column:
    """String field of an object held in one VARIANT leaf."""
    return as_str(F.try_variant_get(leaf, f"$.{name}", "variant"))


def is_present(leaf: Column) -> Column:
    """There, and not a JSON null."""
    return F.coalesce(leaf_type(leaf) != "VOID", F.lit(False))


def as_variant_list(leaf: Column) -> Column:
    """Members of a list as VARIANTs; NULL for anything else."""
    return F.when(leaf_type(leaf).startswith("ARRAY<"), F.try_variant_get(leaf, "$", "array<variant>"))


def as_str_list(leaf: Column) -> Column:
    """String members of a list; NULL for anything that is no list, [] stays []."""
    strings = F.filter(as_variant_list(leaf), lambda item: leaf_type(item) == "STRING")
    return F.transform(strings, lambda item: F.try_variant_get(item, "$", "string"))


_CLOCK = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_OFFSET = r"Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}"
ISO_PATTERN = rf"^(?:{_DATE})(?:[\s\S](?:{_CLOCK})(?:{_OFFSET})?)?\z"
OFFSET_PATTERN = rf"^(?:{_DATE})[\s\S](?:{_CLOCK})(?:{_OFFSET})\z"

#: The spelling that needs no change: none of the steps below finds anything to replace in it.
PLAIN_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-](?:[01]\d|2[0-3]):[0-5]\d)\z"

_YMD = r"^(\d{4})-?(\d{2})-?(\d{2})"
_END = r"(?=[Z+-]|\z)"
# (pattern, replacement) steps that bring every accepted spelling to one:
# yyyy-MM-ddTHH:mm:ss[.ffffff] and Z or ±hh:mm.
_CANONICAL = (
    (_YMD + r"[\s\S](\d{2}):?(\d{2}):?(\d{2})", "$1-$2-$3T$4:$5:$6"),
    (_YMD + r"[\s\S](\d{2}):?(\d{2})" + _END, "$1-$2-$3T$4:$5:00"),
    (_YMD + r"[\s\S](\d{2})" + _END, "$1-$2-$3T$4:00:00"),
    (_YMD + r"\z", "$1-$2-$3T00:00:00"),
    (r"(T[\d:]+)[.,](\d{1,6})\d*", "$1.$2"),
    (r"([+-]\d{2})(\d{2})\z", "$1:$2"),
    (r"(T[\d:.]+[+-]\d{2})\z", "$1:00"),
    (r"(T[\d:.]+)\z", "$1Z"),
)


def has_offset(text: Column) -> Column:
    return F.coalesce(text.rlike(OFFSET_PATTERN), F.lit(False))


def parse_created_at(text: Column) -> Column:
    """ISO-8601 text as an instant; no offset means UTC; anything else is NULL.

    Calendar and basic dates are read, with or without a clock. Week dates and offsets with
    seconds are not.
    """
    canonical = text
    for pattern, replacement in _CANONICAL:
        canonical = F.regexp_replace(canonical, pattern, replacement)
    plain = F.when(text.rlike(PLAIN_PATTERN), text.try_cast("timestamp"))
    return plain.when(text.rlike(ISO_PATTERN), canonical.try_cast("timestamp"))


def parse_ingested_at(micros: Column) -> Column:
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.timestamp_micros(micros))
