"""Feature labelling with injected scorers: chunks, retries, dead letters, counts.

A scorer is a picklable function from a list of texts to a list of label dicts of the same
length. It runs inside the tasks; rows are scored where Spark put them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.ranking import chunk_index
from starling.operators.membership import filter_unlabeled
from starling.session import durable
from starling.sources.tables import path_exists

Scorer = Callable[[list[str]], list[dict]]


@dataclass(frozen=True)
class FeatureSpec:
    """Name, value columns (DDL) and the allowed values of each column, if limited."""

    name: str
    values: Mapping[str, str]
    domains: Mapping[str, Sequence[str]]


FEATURES: dict[str, FeatureSpec] = {
    spec.name: spec
    for spec in (
        FeatureSpec("is_news_or_opinion", {"category": "string"}, {"category": C.NEWS_DOMAIN}),
        FeatureSpec("is_political", {"is_political": "boolean"}, {}),
        FeatureSpec("is_likely_spam", {"is_likely_spam": "boolean"}, {}),
        FeatureSpec("is_self_contained", {"is_self_contained": "boolean"}, {}),
        FeatureSpec("is_structurally_complete", {"is_structurally_complete": "boolean"}, {}),
        FeatureSpec(
            "is_toxic_tiered",
            {"toxicity_prob": "double", "toxicity_tier": "string"},
            {"toxicity_tier": C.TIER_DOMAIN},
        ),
        FeatureSpec("political_stance", {"political_stance": "string"}, {"political_stance": C.STANCE_DOMAIN}),
    )
}


def select_features(names: Sequence[str] | str | None) -> list[FeatureSpec]:
    """A subset by name, comma-separated or listed; unknown names are an error."""
    if names is None:
        return list(FEATURES.values())
    parts = [names] if isinstance(names, str) else list(names)
    wanted = [n.strip() for part in parts for n in part.split(",") if n.strip()]
    unknown = sorted(set(wanted) - set(FEATURES))
    if unknown:
        raise ValueError(f"unknown features: {', '.join(unknown)}")
    return [FEATURES[n] for n in dict.fromkeys(wanted)]


TAGGED_SCHEMA = "uri string, ok boolean, label string, error string, attempts int, chunk bigint"

TAGGED_COLUMNS = ["uri", "ok", "label", "error", "attempts", "chunk"]


def _valid(label: object, spec: FeatureSpec) -> bool:
    if not isinstance(label, dict) or set(label) != set(spec.values):
        return False
    return all(label[c] in domain for c, domain in spec.domains.items())


def score_chunks(
    rows: DataFrame, spec: FeatureSpec, scorer: Scorer, chunk_size: int = C.LABEL_CHUNK, retries: int = C.LABEL_RETRIES
) -> DataFrame:
    """Every input (uri, text) exactly once, as a label or as an error.

    Chunks are runs of `chunk_size` rows in uri order, so a repeated task has the same ones. A chunk
    that fails is tried again up to `retries` times; after that its uris carry the error and the
    other chunks go on.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uri")
        uris, texts, number = part["uri"].tolist(), part["text"].tolist(), int(part["chunk"].iloc[0])
        labels, error, tried = None, None, 0
        while labels is None and tried <= retries:
            tried += 1
            try:
                got = scorer(texts)
                if len(got) != len(texts) or not all(_valid(g, spec) for g in got):
                    raise ValueError("labels do not match the feature's schema")
                labels = got
            except Exception as problem:
                error = str(problem)
        if labels is None:
            out = [(uri, False, None, error, tried, number) for uri in uris]
        else:
            out = [(uri, True, json.dumps(label), None, tried, number) for uri, label in zip(uris, labels, strict=True)]
        return pd.DataFrame(out, columns=TAGGED_COLUMNS)

    chunked = chunk_index(rows.select("uri", "text"), chunk_size, ["uri"])
    return chunked.groupBy("chunk").applyInPandas(run, TAGGED_SCHEMA)


def label_rows(tagged: DataFrame, spec: FeatureSpec, label_timestamp: str) -> DataFrame:
    schema = ", ".join(f"{n} {t}" for n, t in spec.values.items())
    parsed = F.from_json("label", schema)
    return tagged.filter("ok").select(
        "uri", F.lit(label_timestamp).alias("label_timestamp"), *[parsed[n].alias(n) for n in spec.values]
    )


def dead_letters(tagged: DataFrame, spec: FeatureSpec, stamp: str) -> DataFrame:
    """One record per failed chunk; a chunk holds at most `chunk_size` uris."""
    failed = tagged.filter(~F.col("ok"))
    return failed.groupBy("chunk").agg(
        F.lit(spec.name).alias("feature"),
        F.sort_array(F.collect_list("uri")).alias("uris"),
        F.max("error").alias("error"),
        F.max("attempts").alias("attempts"),
        F.lit(stamp).alias("timestamp"),
    )


def label_feature(
    records: DataFrame,
    spec: FeatureSpec,
    scorer: Scorer,
    existing: DataFrame,
    label_timestamp: str,
    chunk_size: int = C.LABEL_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """(new label rows, dead letters) for records without a label.

    Scores are written to the checkpoint folder first: both outputs read them, and no text
    is scored twice. Failed uris stay unlabelled, so the next run takes them up.
    """
    todo = filter_unlabeled(records, "uri", existing)
    tagged = durable(score_chunks(todo, spec, scorer, chunk_size))
    return label_rows(tagged, spec, label_timestamp), dead_letters(tagged, spec, label_timestamp)


def run_labelling(
    records: DataFrame, spec: FeatureSpec, scorer: Scorer, root: str, label_timestamp: str, chunk_size: int = C.LABEL_CHUNK
) -> DataFrame:
    """One run over the records without a label: labels appended, failed chunks kept aside, a ledger last.

    Below `root`/feature lie `labels` and `dead_letters`, each with a folder per run, and `ledger`
    with a row per chunk. A run repeated before its ledger was written replaces its own folders; one
    whose ledger is there is done, and its ledger is returned. The next run takes up what failed.
    """
    spark = records.sparkSession
    base = f"{root.rstrip('/')}/{spec.name}"
    ledger = f"{base}/ledger/run={label_timestamp.replace(':', '_')}"
    if not path_exists(spark, f"{ledger}/_SUCCESS"):
        schema = "uri string, label_timestamp string, " + ", ".join(f"{n} {t}" for n, t in spec.values.items())
        labelled = spark.createDataFrame([], schema)
        if path_exists(spark, f"{base}/labels"):
            labelled = spark.read.schema(schema).parquet(f"{base}/labels")
        # Labels of a run that stopped before its ledger are made anew.
        todo = filter_unlabeled(records, "uri", labelled.filter(F.col("label_timestamp") != label_timestamp))
        planned = -(-todo.count() // chunk_size)
        tagged = durable(score_chunks(todo, spec, scorer, chunk_size))
        name = ledger.rsplit("/", 1)[1]
        label_rows(tagged, spec, label_timestamp).write.mode("overwrite").parquet(f"{base}/labels/{name}")
        dead_letters(tagged, spec, label_timestamp).write.mode("overwrite").parquet(f"{base}/dead_letters/{name}")
        chunk_ledger(tagged, planned).write.mode("overwrite").parquet(ledger)
    return spark.read.parquet(ledger)


def chunk_ledger(tagged: DataFrame, planned: int) -> DataFrame:
    """(chunk, rows, ok, attempts, planned): what became of every chunk, and how many the run had."""
    chunks = tagged.groupBy("chunk").agg(F.count("*").alias("rows"), F.bool_and("ok").alias("ok"), F.max("attempts").alias("attempts"))
    return chunks.withColumn("planned", F.lit(planned).cast("bigint"))


def run_counts(ledger: DataFrame) -> DataFrame:
    """Labeled rows, failed chunks, and whether every planned chunk was seen."""
    return ledger.agg(
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("rows"))), F.lit(0).cast("bigint")).alias("labeled"),
        F.count_if(~F.col("ok")).alias("failed_batches"),
        F.coalesce(F.count("*") == F.max("planned"), F.lit(True)).alias("completed"),
    )


Requester = Callable[[list[str]], list[str | None]]
RESPONSE_SCHEMA = "uri string, response string, attempts int"


def score_batches(rows: DataFrame, requester: Requester, chunk_size: int = C.SCORE_CHUNK, attempts: int = 4) -> DataFrame:
    """(uri, response, attempts): failed members of a batch are asked again on their own.

    A reply whose length is not that of the request fails the whole request.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            uris, texts = batch["uri"].tolist(), batch["text"].tolist()
            replies: list[str | None] = [None] * len(uris)
            tried = [0] * len(uris)
            for start in range(0, len(uris), chunk_size):
                waiting = list(range(start, min(start + chunk_size, len(uris))))
                for _ in range(attempts):
                    if not waiting:
                        break
                    got = requester([texts[i] for i in waiting])
                    answers = got if len(got) == len(waiting) else [None] * len(waiting)
                    for i, answer in zip(waiting, answers, strict=True):
                        tried[i] += 1
                        replies[i] = answer
                    waiting = [i for i in waiting if replies[i] is None]
            yield pd.DataFrame({"uri": uris, "response": replies, "attempts": tried})

    return rows.select("uri", "text").mapInPandas(run, RESPONSE_SCHEMA)


# -- scorers that need no model --------------------------------------------------------
