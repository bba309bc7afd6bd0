"""Platform text filters applied in one pass, then the platform's text transform."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions import text as X

TextCheck = Callable[[Column], Column]


@dataclass(frozen=True)
class PlatformSpec:
    """Where a platform keeps id and text, and what its texts have to satisfy.

    Checks are Column -> Column, cheapest first: lengths before patterns.
    """

    name: str
    id_column: str
    text_column: str
    feature_id_column: str
    text_checks: Sequence[TextCheck]
    author_checks: Sequence[TextCheck] = ()
    transform: TextCheck | None = None


BLUESKY = PlatformSpec(
    "bluesky", "uri", "text", "uri",
    (lambda t: X.valid_length(t, 100, 300), X.not_phone, X.no_urls, X.is_english),
)
REDDIT = PlatformSpec(
    "reddit", "comment_fullname", "body", "uri",
    (X.body_not_removed, X.no_mentions, X.no_markdown_links, X.no_media_hosts, X.no_urls,
     X.not_phone, X.is_english),
    author_checks=(X.not_automoderator,),
)
TWITTER = PlatformSpec(
    "twitter", "tweet_id", "text", "uri",
    (lambda t: X.valid_length(t, 50, 280), X.not_phone, X.no_external_urls, X.is_english),
    transform=X.strip_tco,
)
PLATFORMS = {spec.name: spec for spec in (BLUESKY, REDDIT, TWITTER)}


def as_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def passes(spec: PlatformSpec, language_known: Column | None = None) -> Column:
    """All checks of the platform as one predicate.

    `language_known` replaces the English detector where the data carries a language.
    """
    checks = []
    for check in spec.text_checks:
        if check is X.is_english and language_known is not None:
            checks.append(F.coalesce(language_known, F.lit(False)))
        else:
            checks.append(check(as_text(spec.text_column)))
    checks += [check(as_text("author")) for check in spec.author_checks]
    return reduce(lambda a, b: a & b, checks)


def filter_records(df: DataFrame, spec: PlatformSpec, language_known: Column | None = None) -> DataFrame:
    return df.filter(passes(spec, language_known))


def apply_text_transform(df: DataFrame, spec: PlatformSpec) -> DataFrame:
    if spec.transform is None:
        return df
    return df.withColumn(spec.text_column, spec.transform(F.col(spec.text_column)))


def preprocess(df: DataFrame, spec: PlatformSpec, language_known: Column | None = None) -> DataFrame:
    """Filter, then transform: lengths are judged on the text as collected."""
    return apply_text_transform(filter_records(df, spec, language_known), spec)
