"""Toxicity responses -> label rows, and averages and coverage over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.scalars import label_from_prob, safe_divide
from starling.functions.text import is_blank

RESPONSE_SCHEMA = (
    "error string, attributeScores map<string, struct<summaryScore struct<value double>>>"
)
PRESENCE_SCHEMA = "attributeScores map<string, map<string, string>>"


def malformed_scores(response: Column) -> Column:
    """One message per attribute without summaryScore or value, joined; NULL when whole."""
    scores = F.from_json(response, PRESENCE_SCHEMA)["attributeScores"]

    def message(entry: Column) -> Column:
        name, fields = entry["key"], entry["value"]
        summary = F.try_element_at(fields, F.lit("summaryScore"))
        return (
            F.when(summary.isNull(), F.concat(F.lit("Missing required field: summaryScore for "), name))
            .when(
                F.get_json_object(summary, "$.value").isNull(),
                F.concat(F.lit("Missing required field: value in summaryScore for "), name),
            )
        )

    messages = F.filter(F.transform(F.map_entries(scores), message), lambda m: m.isNotNull())
    return F.when(F.size(messages) > 0, F.array_join(messages, "; "))


def score_columns(response: Column, with_labels: bool = True) -> dict[str, Column]:
    """prob_* (and label_*) of every attribute; constructive repeats reasoning."""
    scores = F.from_json(response, RESPONSE_SCHEMA)["attributeScores"]
    out: dict[str, Column] = {}
    for attribute, suffix in C.SCORE_ATTRIBUTES.items():
        out[f"prob_{suffix}"] = F.try_element_at(scores, F.lit(attribute))["summaryScore"]["value"]
    out["prob_constructive"] = out["prob_reasoning"]
    if with_labels:
        for name in [n for n in out if n.startswith("prob_")]:
            out["label_" + name.removeprefix("prob_")] = label_from_prob(out[name])
    return out


def labels_from_scores(responses: DataFrame, response: str = "response") -> DataFrame:
    """uri, failure and the prob_/label_ columns; all NULL for a failed response."""
    text = F.col(response)
    error = F.from_json(text, RESPONSE_SCHEMA)["error"]
    failure = F.when(text.isNull(), C.NO_RESPONSE_REASON).otherwise(
        F.coalesce(error, malformed_scores(text))
    )
    marked = responses.withColumn("failure", failure)
    ok = F.col("failure").isNull()
    columns = [F.when(ok, c).alias(n) for n, c in score_columns(text).items()]
    return marked.select("uri", "failure", *columns)


def create_labels(posts: DataFrame, responses: DataFrame, label_timestamp: str) -> DataFrame:
    """Exactly one row per post: scored, failed, or blank and never scored.

    `responses` holds at most one row per uri; alignment is by uri, not by position.
    """
    scored = labels_from_scores(responses).drop(*[f"label_{s}" for s in _suffixes()])
    joined = posts.join(scored.withColumn("_answered", F.lit(True)), "uri", "left")
    reason = (
        F.when(is_blank(F.col("text")), C.EMPTY_TEXT_REASON)
        .when(F.col("_answered").isNull(), C.NO_RESPONSE_REASON)
        .otherwise(F.col("failure"))
    )
    probs = [F.when(reason.isNull(), F.col(f"prob_{s}")).alias(f"prob_{s}") for s in _suffixes()]
    return joined.select(
        "uri", "text", "preprocessing_timestamp",
        reason.isNull().alias("was_successfully_labeled"),
        reason.alias("reason"),
        F.lit(label_timestamp).alias("label_timestamp"),
        *probs,
    )


def _suffixes() -> list[str]:
    return [*C.SCORE_ATTRIBUTES.values(), "constructive"]


def prob_columns(labels: DataFrame) -> list[str]:
    return sorted(c for c in labels.columns if c.startswith("prob_"))


def daily_averages(labels: DataFrame, day: Column) -> DataFrame:
    """Mean of every prob_ column over successful rows per day; a day without any fails."""
    ok = F.col("was_successfully_labeled")
    counted = labels.groupBy(day.alias("day")).agg(
        F.count_if(ok).alias("n_success"),
        *[F.avg(F.when(ok, F.col(c))).alias(c) for c in prob_columns(labels)],
    )
    message = F.concat(F.lit("no successfully labeled rows for "), F.col("day").cast("string"))
    checked = F.when(F.col("n_success") > 0, F.col("n_success")).otherwise(F.raise_error(message))
    return counted.withColumn("n_success", checked)


def hourly_averages(labels: DataFrame, posts: DataFrame) -> DataFrame:
    """(hour, attribute, mean) in long form; attributes without a mean are left out.

    The hour is that of the post, found by inner join on uri.
    """
    probs = prob_columns(labels)
    ok = labels.filter(F.col("was_successfully_labeled")).select("uri", *probs)
    timed = ok.join(posts.select("uri", "created_at"), "uri")
    hour = F.date_format("created_at", "yyyy-MM-dd:HH").alias("hour")
    means = timed.groupBy(hour).agg(*[F.avg(c).alias(c) for c in probs])
    return means.unpivot(["hour"], probs, "attribute", "mean_prob").filter(F.col("mean_prob").isNotNull())


def label_coverage(posts: DataFrame, labels: DataFrame, days: Sequence[str] | None = None) -> DataFrame:
    """Per day: posts, labeled, successfully_labeled, coverage; `interim` if any day lacks labels.

    Both sides carry `day`.
    """
    counted = posts.groupBy("day").agg(F.count("*").alias("posts"))
    scored = labels.groupBy("day").agg(
        F.count("*").alias("labeled"),
        F.count_if("was_successfully_labeled").alias("successfully_labeled"),
    )
    joined = counted.join(scored, "day", "full")
    if days is not None:
        joined = joined.filter(F.col("day").isin(*days))
    zero = F.lit(0).cast("bigint")
    rows = joined.select(
        "day",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("posts", "labeled", "successfully_labeled")],
    ).withColumn("coverage", safe_divide(F.col("labeled").cast("double"), F.col("posts").cast("double")))
    lowest = rows.agg(F.min("coverage")).scalar()
    return rows.withColumn("interim", lowest < C.COVERAGE_COMPLETE)


def feature_contract_violations(wide: DataFrame) -> DataFrame:
    """Labelled values outside their domain, counted per feature."""
    def bad(name: str, domain: Sequence[str]) -> Column:
        return F.count_if(F.col(name).isNotNull() & ~F.col(name).isin(*domain))

    return wide.agg(
        bad("news_or_opinion_category", C.NEWS_DOMAIN).alias("bad_category"),
        bad("political_stance", C.STANCE_DOMAIN).alias("bad_stance"),
        bad("toxicity_tier", C.TIER_DOMAIN).alias("bad_tier"),
        F.count_if(~F.col("toxicity_prob").between(0, 1)).alias("bad_prob"),
        F.count("is_political").alias("labelled_rows"),
    )
