"""Wide table of posts and their labels, and declarative rules over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.scalars import normalize_bool

# Feature -> (value column in its table, column in the wide table).
FEATURE_COLUMNS: dict[str, tuple[tuple[str, str], ...]] = {
    "is_political": (("is_political", "is_political"),),
    "is_likely_spam": (("is_likely_spam", "is_likely_spam"),),
    "is_self_contained": (("is_self_contained", "is_self_contained"),),
    "is_structurally_complete": (("is_structurally_complete", "is_structurally_complete"),),
    "is_news_or_opinion": (("category", "news_or_opinion_category"),),
    "political_stance": (("political_stance", "political_stance"),),
    "is_toxic_tiered": (("toxicity_prob", "toxicity_prob"), ("toxicity_tier", "toxicity_tier")),
}


def feature_dedupe(feature: DataFrame, values: Sequence[str]) -> DataFrame:
    """One row per uri: the latest label, ties by value."""
    latest = F.max(F.struct("label_timestamp", *values)).alias("_row")
    return feature.groupBy("uri").agg(latest).select("uri", "_row.*")


def wide_features(features: Mapping[str, DataFrame]) -> DataFrame:
    """All feature tables as one row per uri.

    The tables are unioned and grouped once, so the labels shuffle once however many
    features there are, and each map task sends one partial row per uri.
    """
    tagged: DataFrame | None = None
    for name, feature in features.items():
        values = [F.col(source).alias(target) for source, target in FEATURE_COLUMNS[name]]
        part = feature.select(
            F.col("uri").cast("string").alias("uri"), F.lit(name).alias("_feature"), "label_timestamp", *values
        )
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    latest = []
    for name in features:
        columns = [target for _, target in FEATURE_COLUMNS[name]]
        row = F.when(F.col("_feature") == name, F.struct("label_timestamp", *columns))
        latest.append(F.max(row).alias(f"_{name}"))
    grouped = tagged.groupBy("uri").agg(*latest)
    return grouped.select(
        "uri",
        *[F.col(f"_{name}.{target}").alias(target) for name in features for _, target in FEATURE_COLUMNS[name]],
    )


def consolidate(posts: DataFrame, features: Mapping[str, DataFrame], id_column: str = "uri") -> DataFrame:
    """Posts LEFT JOIN every feature; repeated posts stay, missing labels are NULL."""
    labels = wide_features(features).withColumnRenamed("uri", "_uri")
    joined = posts.join(labels, F.col(id_column).cast("string") == F.col("_uri"), "left")
    return joined.drop("_uri")


@dataclass(frozen=True)
class Rule:
    column: str
    op: str
    value: str | bool | list


def _equals(column: str, value: str | bool) -> Column:
    if column in C.BOOLEAN_RULE_COLUMNS or isinstance(value, bool):
        wanted = value if isinstance(value, bool) else str(value).strip().lower() in C.TRUE_WORDS
        return F.coalesce(normalize_bool(F.col(column)) == wanted, F.lit(False))
    return F.coalesce(F.col(column).cast("string") == str(value), F.lit(False))


def rule_predicate(rule: Rule, columns: Sequence[str]) -> Column:
    """A rule as a two-valued predicate. NULL fails eq and in, and passes ne."""
    if rule.column not in columns:
        raise KeyError(f"rule column not in the table: {rule.column}")
    if rule.op == "eq":
        return _equals(rule.column, rule.value)
    if rule.op == "ne":
        return ~_equals(rule.column, rule.value)
    if rule.op == "in":
        if not isinstance(rule.value, list):
            raise ValueError(f"'in' needs a list: {rule.column}")
        hit = F.lit(False)
        for item in rule.value:
            hit = hit | _equals(rule.column, item)
        return hit
    raise ValueError(f"unknown rule op: {rule.op}")


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    keep = F.lit(True)
    for rule in rules:
        keep = keep & rule_predicate(rule, df.columns)
    return df.filter(keep)


def rule_steps(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(step, rule_column, records_before, records_passing) from a single pass.

    Step k passes the rows that satisfy rules 1..k; all prefixes are counted together.
    """
    prefix = F.lit(True)
    counts = [F.count("*").alias("_0")]
    for k, rule in enumerate(rules, 1):
        prefix = prefix & rule_predicate(rule, df.columns)
        counts.append(F.count_if(prefix).alias(f"_{k}"))
    steps = F.array(
        *[
            F.struct(
                F.lit(k).cast("bigint").alias("step"),
                F.lit(rule.column).alias("rule_column"),
                F.lit(rule.op).alias("op"),
                F.col(f"_{k - 1}").alias("records_before"),
                F.col(f"_{k}").alias("records_passing"),
            )
            for k, rule in enumerate(rules, 1)
        ]
    )
    return df.agg(*counts).select(F.inline(steps))


def curate_counts(preprocessed: DataFrame, wide: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(stage, records): preprocessed, wide, after_filters and each step."""
    steps = rule_steps(wide, rules)
    last = F.max_by("records_passing", "step")
    totals = preprocessed.agg(F.count("*").alias("records")).select(F.lit("preprocessed").alias("stage"), "records")
    first = F.min_by("records_before", "step")
    ends = steps.agg(first.alias("w"), last.alias("f")).select(
        F.inline(
            F.array(
                F.struct(F.lit("wide").alias("stage"), F.col("w").alias("records")),
                F.struct(F.lit("after_filters").alias("stage"), F.col("f").alias("records")),
            )
        )
    )
    each = steps.select(F.concat(F.lit("step_"), "step").alias("stage"), F.col("records_passing").alias("records"))
    return totals.union(ends).union(each)


DEFAULT_RULES = (
    Rule("news_or_opinion_category", "eq", "opinion"),
    Rule("is_political", "eq", True),
    Rule("is_likely_spam", "eq", False),
    Rule("political_stance", "in", ["left", "right"]),
    Rule("is_self_contained", "eq", True),
    Rule("is_structurally_complete", "eq", True),
)
