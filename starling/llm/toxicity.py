"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a character n-gram inside a word (with marks at its ends); its value is the number
of distinct words of the text that hold it, times the log ratio of its smoothed shares in toxic
and clean training texts. Logistic regression on a bounded labelled sample gives the weights;
weight and ratio are folded into one number per n-gram, kept in a sorted hash array.

Defined results: a null or empty text gets the score of a text without features. Without
labelled rows of both kinds every score is 0. Labels other than 0 and 1 or without a text are not
used; a doc_id with several labels counts as toxic if one of them says so. Repeated rows are
scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import smallest_hashes, with_broadcast
from starling.llm.language import id_hash
from starling.llm.letters import Remembered, Words, code_values, gram_ends, padded, text_pieces
from starling.llm.registry import query
from starling.llm.words import U64, hash_spans

ORDERS = (3, 4, 5, 6)
#: Labelled rows of each kind that the classifier is fitted on (the bound of the training sample).
SAMPLE_ROWS = {1: 2000, 0: 4000}
STEPS = 200
RATE = 0.02
SPARSITY = 1e-3
#: N-grams seen fewer times than this (once per distinct word of a text) are not used.
MIN_WORDS = 4
THRESHOLD = 0.7
#: N-grams numbered at once.
NUMBERED = 1 << 18


def word_grams(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram hash) of marked words laid end to end; a whole word is an n-gram too."""
    word = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    offset = np.arange(len(flat)) - bounds[:-1][word]
    words = [np.arange(len(bounds) - 1, dtype=np.int32)]
    grams = [hash_spans(flat, bounds[:-1], bounds[1:], code_values)]
    for n in ORDERS:
        place = np.flatnonzero(offset >= n - 1)
        words.append(word[place])
        grams.append(gram_ends(flat, n)[place])
    return np.concatenate(words), np.concatenate(grams)


@dataclass
class ToxicityModel:
    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, codes, starts, ends) -> np.ndarray:
        words, grams = word_grams(*padded(codes, starts, ends, 1, 1))
        at = np.minimum(np.searchsorted(self.keys, grams), max(len(self.keys) - 1, 0))
        value = np.where(self.keys[at] == grams, self.weights[at], 0.0) if len(self.keys) else np.zeros(len(grams))
        return np.bincount(words, value, len(starts))[:, None]


def _distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, place of the word's first occurrence): each distinct word of each text once."""
    texts = words.texts_of()
    order = np.lexsort((words.hashes, texts))
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (texts[a] != texts[b]) | (words.hashes[a] != words.hashes[b])
    return texts[order[new]], order[new]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Vocabulary:
    """The distinct words of a sample, marked and laid end to end, read piece by piece."""

    def __init__(self, texts: list[str]):
        keys, flats, sizes, pairs, first = np.zeros(0, U64), [], [], [], 0
        for piece in text_pieces(texts):
            words = Words(piece)
            text, at = _distinct_words(words)
            pairs.append(((text + first).astype(np.int32), words.hashes[at]))
            distinct, own = np.unique(words.hashes, return_index=True)
            fresh = ~np.isin(distinct, keys)
            flat, bounds = padded(words.codes, words.starts[own[fresh]], words.ends[own[fresh]], 1, 1)
            keys = np.concatenate([keys, distinct[fresh]])
            flats.append(flat)
            sizes.append(np.diff(bounds))
            first += len(piece)
        order = np.argsort(keys)
        self.words = len(keys)
        self.flat = np.concatenate(flats)
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        self.text = np.concatenate([t for t, _ in pairs])
        self.word = order[np.searchsorted(keys[order], np.concatenate([h for _, h in pairs]))].astype(np.int32)

    def grams(self, least: int, step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """(word, n-gram) of n-grams that `least` texts may hold; a counting pass drops most others."""
        counts = np.zeros(1 << 22, np.int32)
        texts = np.bincount(self.word, minlength=self.words)
        for again in (False, True):
            words, grams = [np.zeros(0, np.int32)], [np.zeros(0, U64)]
            for a in range(0, self.words, step):
                bounds = self.bounds[a : a + step + 1]
                word, gram = word_grams(self.flat[bounds[0] : bounds[-1]], bounds - bounds[0])
                bucket = (gram >> U64(42)).astype(np.int64)
                if again:
                    often = counts[bucket] >= least
                    words.append(word[often] + np.int32(a))
                    grams.append(gram[often])
                else:
                    counts += np.bincount(bucket, texts[a + word], len(counts)).astype(np.int32)
        # The parts of one go before those of the other are laid together.
        every = np.concatenate(words)
        words.clear()
        return every, np.concatenate(grams)


def fit(texts: list[str], toxic: np.ndarray) -> ToxicityModel:
    vocabulary = Vocabulary(texts)
    text, word = vocabulary.text, vocabulary.word
    gram_word, grams = vocabulary.grams(MIN_WORDS)
    # Numbered piece by piece: `return_inverse` would hold several arrays as long as `grams` at once.
    keys = np.unique(grams)
    gram = np.empty(len(grams), np.int32)
    for a in range(0, len(grams), NUMBERED):
        gram[a : a + NUMBERED] = np.searchsorted(keys, grams[a : a + NUMBERED])
    del grams
    texts_n, words_n, grams_n = len(texts), vocabulary.words, len(keys)

    def to_texts(weights):
        per_word = np.bincount(gram_word, weights[gram], words_n)
        return np.bincount(text, per_word[word], texts_n)

    def to_grams(values):
        per_word = np.bincount(word, values[text], words_n)
        return np.bincount(gram, per_word[gram_word], grams_n)

    y = toxic.astype(float)
    in_toxic, in_clean = 1 + to_grams(y), 1 + to_grams(1 - y)
    ratio = np.log(in_toxic / in_toxic.sum()) - np.log(in_clean / in_clean.sum())
    ratio[in_toxic + in_clean < 2 + MIN_WORDS] = 0
    # Adam on the logistic loss, each step followed by soft thresholding: n-grams that only
    # follow the sample's noise end at zero, so the length of a text adds nothing to its score.
    weights, bias = np.zeros(grams_n), -1.0
    mean, spread, mean_b, spread_b = np.zeros(grams_n), np.zeros(grams_n), 0.0, 0.0
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, STEPS + 1):
        error = (_sigmoid(bias + to_texts(weights * ratio)) - y) * share
        slope, slope_b = to_grams(error) * ratio, error.sum()
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        mean_b, spread_b = 0.9 * mean_b + 0.1 * slope_b, 0.99 * spread_b + 0.01 * slope_b**2
        up, down = 1 - 0.9**step, 1 - 0.99**step
        rate = RATE / (np.sqrt(spread / down) + 1e-3)
        weights -= rate * mean / up
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * SPARSITY, 0)
        bias -= 0.05 * (mean_b / up) / (np.sqrt(spread_b / down) + 1e-8)
    folded = weights * ratio
    used = folded != 0
    return ToxicityModel(keys[used], folded[used], float(bias))


def train(docs: DataFrame, labels: DataFrame, rows: dict[int, int] = SAMPLE_ROWS) -> ToxicityModel | None:
    """Fit on at most `rows[label]` documents of each label (those of smallest id hash); of rows that
    repeat a doc_id, the smallest text."""
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    wanted = F.when(F.col("toxic") == 1, rows[1]).otherwise(rows[0])
    ids = smallest_hashes(known, "toxic", wanted, max(rows.values()))
    chosen = docs.select("doc_id", "text").filter("text IS NOT NULL")
    chosen = chosen.join(with_broadcast(ids.select("doc_id", "toxic")), "doc_id")
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = chosen.toPandas().sort_values(["doc_id", "text"])
    if sample["toxic"].nunique() < 2:
        return None
    return fit(list(sample["text"]), sample["toxic"].to_numpy())


def score_texts(model: ToxicityModel, texts: list[str | None], memory: Remembered | None = None) -> np.ndarray:
    memory = memory or Remembered(model.score, 1)
    out = []
    for piece in text_pieces(texts):
        words = Words(piece)
        scores, place = memory.of(words)
        text, at = _distinct_words(words)
        out.append(np.bincount(text, scores[place[at], 0], len(piece)))
    total = np.concatenate(out) if out else np.zeros(0)
    return _sigmoid(model.bias + total)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        memory = Remembered(model.score, 1)
        for batch in batches:
            score = score_texts(model, batch.column(1).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int"
    return rows.mapInArrow(run, schema)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.coalesce(id_hash() % 3 == 1, F.lit(False))
    model = train(docs, labels.filter(~held_out))
    return score_toxicity(docs, model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "score", "predicted"
    )
