"""Language-model scoring: stupid backoff on n-gram counts of the whole corpus.

Counts are partitioned by the hash of the n-gram. Bundles of documents explode their n-grams, send
each distinct one with its count inside the bundle to its slice of the table, and join the summed
counts that come back to every place in their texts; the log scores are summed per document.

A word's score is the relative frequency after the longest context whose n-gram is in the
table, times `backoff` for every context given up; an n-gram of two or more words is in the table
if the corpus holds it at least `min_count` times. (Every n-gram of a text is in its own corpus
once, so a table of all n-grams would never back off.)

Defined results: a null or wordless text has n_words 0, log_score 0 and null for the per-word
values. Repeated rows count each time and are scored row by row. Words are runs of bytes that are
not white space, A-Z lower-cased. An n-gram never crosses texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import saved
from starling.llm.exchange import (
    ASK,
    Layout,
    answer,
    ask_rows,
    ask_table,
    bundled,
    ordered,
    pack_counts,
    packed,
    replies_of,
    text_schema,
    unpack_counts,
    unpacked,
)
from starling.llm.registry import query
from starling.llm.words import LOWER, NOT_SPACE, U64, gram_hashes, hash_spans, pieces, run_starts, spans

ORDER = 3
BACKOFF = 0.4
MIN_COUNT = 2
#: Hash bits of a key, at every size of the input.
BITS = 64
#: Bundles larger than others (n-grams that repeat inside one are sent once), compression of their texts.
BUNDLE_TIMES = 1.5
TEXT_LEVEL = 9


def _words(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, bounds of the texts) of a bundle."""
    words, bounds = [np.zeros(0, U64)], [np.zeros(1, np.int64)]
    for piece in pieces(table.column("text")):
        data = LOWER[piece.data]
        starts, ends, edges = spans(piece, NOT_SPACE)
        words.append(hash_spans(data, starts, ends))
        bounds.append(edges[1:] + bounds[-1][-1])
    return np.concatenate(words), np.concatenate(bounds)


def _grams(words: np.ndarray, bounds: np.ndarray, order: int):
    """(per n the places where an n-gram starts, all keys one order after the other)."""
    places, keys = [], []
    for n in range(1, order + 1):
        place = np.flatnonzero(run_starts(bounds, n))
        places.append(place)
        keys.append(gram_hashes(words, n)[place] if len(place) else np.zeros(0, U64))
    return places, np.concatenate(keys)


def _add_up(asked, counts):
    if not asked:
        return []
    sizes = [len(k) for k in asked]
    keys, numbers = np.concatenate(asked), np.concatenate(counts)
    order = np.argsort(keys)
    keys, numbers = keys[order], numbers[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    total = np.add.reduceat(numbers, np.flatnonzero(new))
    out = np.empty(len(keys), U64)
    out[order] = total[np.cumsum(new) - 1]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return [pack_counts(out[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def lm_scores(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score, perplexity) of every row."""
    layout = Layout.of(docs, BUNDLE_TIMES)
    slices = layout.slices(layout.words // 2 * order)
    rows = packed(bundled(docs.select("doc_id", "text"), layout), TEXT_LEVEL)
    schema = text_schema(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def ask(table: pa.Table) -> pa.Table:
        words, bounds = _words(ordered(unpacked(table, schema)))
        keys, counts = np.unique(_grams(words, bounds, order)[1], return_counts=True)
        return ask_table(ask_rows(table.column("bundle")[0].as_py(), keys, counts, slices, BITS))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = ordered(unpacked(texts, schema))
        words, bounds = _words(texts)
        places, keys = _grams(words, bounds, order)
        _, back = np.unique(keys, return_inverse=True)
        known = [unpack_counts(reply) for _, _, reply in replies_of(answers)]
        totals = np.concatenate([*known, np.zeros(0, U64)]).astype(float)[back]
        counts, begin = [], 0
        for place in places:
            own = np.zeros(len(words))
            own[place] = totals[begin : begin + len(place)]
            begin += len(place)
            counts.append(own)
        # By the place of the last word: the single word, then longer and longer contexts.
        since = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
        value, single = np.log(np.maximum(counts[0], 1)), np.ones(len(words), bool)
        for n in range(2, order + 1):
            fits = np.flatnonzero(since >= n - 1)
            start = fits - n + 1
            seen = counts[n - 1][start] >= min_count
            at = fits[seen]
            value[fits[~seen]] += math.log(backoff)
            value[at] = np.log(counts[n - 1][start[seen]] / counts[n - 2][start[seen]])
            single[at] = False
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_words": pa.array(np.diff(bounds).astype(np.int64)),
                "part": pa.array(np.bincount(text, value, len(bounds) - 1)),
                "n_single": pa.array(np.bincount(text, single, len(bounds) - 1).astype(np.int64)),
            }
        )

    counted = answer(rows.groupBy("bundle").applyInArrow(ask, ASK), _add_up)
    scored = saved(
        rows.groupBy("bundle")
        .cogroup(counted.groupBy("bundle"))
        .applyInArrow(score, f"doc_id {kind}, n_words long, part double, n_single long"),
        "lm-parts",
    )
    total = scored.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("part") - F.col("n_single") * F.lit(math.log(max(total, 1)))
    mean = F.when(F.col("n_words") > 0, log_score / F.col("n_words"))
    return scored.select(
        "doc_id",
        "n_words",
        log_score.alias("log_score"),
        mean.alias("mean_log_score"),
        F.exp(-mean).alias("perplexity"),
    )


@query("op5_lm_scoring")
def op5_lm_scoring(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return lm_scores(docs)
