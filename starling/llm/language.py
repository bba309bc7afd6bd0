"""Language identification with interpolated Kneser-Ney character models.

One model per language over the characters of single words, trained on a bounded sample of
labelled rows. The models of all languages share, per order, a sorted array of n-gram hashes
with a probability part and a back-off weight per language. A text takes the language of lowest
cross-entropy per character; its score is a probability whose sharpness is fitted on the rest
of the sample, and `rejected` marks texts that are less likely than what the sample shows.

Defined results: a null text or one without a letter gets `und`, score 0 and rejected. Ties go to
the language that sorts first. Without any labelled row everything is `und`. Repeated rows are
scored row by row; columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import smallest_hashes, with_broadcast
from starling.llm.letters import Remembered, Words, gram_ends, padded, sums, text_pieces
from starling.llm.registry import query
from starling.llm.words import U64

ORDER = 4
#: Labelled rows per language that a model is fitted on (the bound of the training sample).
SAMPLE_ROWS = 400
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    order: int
    keys: list[np.ndarray]  # per order, sorted n-gram hashes
    parts: list[np.ndarray]  # per order, (n-gram, language) discounted probability
    contexts: list[np.ndarray]  # per order, sorted context hashes
    weights: list[np.ndarray]  # per order, (context, language) share left to the lower order
    floor: float
    sharpness: float = 1.0
    limit: float = float("inf")

    def score(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(word, language) negative log-likelihood, and the number of characters as last column."""
        flat, bounds = padded(codes, starts, ends, self.order - 1, 1)
        place = np.ones(len(flat), bool)
        for k in range(self.order - 1):
            place[bounds[:-1] + k] = False
        target = np.flatnonzero(place)
        word = np.repeat(np.arange(len(starts)), np.diff(bounds) - (self.order - 1))
        chance = np.full((len(target), len(self.languages)), self.floor)
        for n in range(1, self.order + 1):
            grams = gram_ends(flat, n)[target]
            before = gram_ends(flat, n - 1)[target - 1] if n > 1 else np.zeros(len(target), U64)
            chance = _rows(self.keys[n - 1], self.parts[n - 1], grams, 0.0) + chance * _rows(
                self.contexts[n - 1], self.weights[n - 1], before, 1.0
            )
        loss = np.concatenate([-np.log(chance), np.ones((len(target), 1))], axis=1)
        return sums(loss, word, len(starts))

    def judge(self, loss: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, score, rejected) from summed losses and character counts."""
        letters = loss[:, -1]
        rate = loss[:, :-1] / np.maximum(letters, 1)[:, None]
        best = rate.argmin(axis=1) if rate.shape[1] else np.zeros(len(loss), int)
        power = self.sharpness * np.sqrt(np.maximum(letters, 1))
        chance = np.exp((rate.min(axis=1, initial=np.inf)[:, None] - rate) * power[:, None])
        score = np.where(letters > 0, 1 / np.maximum(chance.sum(axis=1), 1), 0.0)
        return best, score, (letters == 0) | (rate.min(axis=1, initial=np.inf) > self.limit)


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if len(keys) == 0:
        return np.full((len(wanted), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], missing)


def fit(texts: dict[str, list[str]], order: int = ORDER) -> LanguageModel:
    """Kneser-Ney counts of the texts of each language, turned into the shared tables."""
    languages = sorted(texts)
    found: list[dict[str, tuple]] = [{} for _ in range(order)]
    alphabet: set[int] = set()
    for language in languages:
        words = Words(texts[language])
        distinct, first, times = np.unique(words.hashes, return_index=True, return_counts=True)
        flat, bounds = padded(words.codes, words.starts[first], words.ends[first], order - 1, 1)
        alphabet |= set(np.unique(flat).tolist())
        place = np.ones(len(flat), bool)
        for k in range(order - 1):
            place[bounds[:-1] + k] = False
        target = np.flatnonzero(place)
        weight = np.repeat(times, np.diff(bounds) - (order - 1))
        hashes = [gram_ends(flat, n) for n in range(order + 1)]
        longer = None
        for n in range(order, 0, -1):
            grams, at, back = np.unique(hashes[n][target], return_index=True, return_inverse=True)
            # Below the top order an n-gram counts by the distinct characters before it.
            counts = np.bincount(back, weight if longer is None else None, len(grams))
            if longer is not None:
                counts = np.bincount(np.searchsorted(grams, hashes[n][target][longer]), minlength=len(grams))
            above = hashes[n - 1][target[at] - 1] if n > 1 else np.zeros(len(grams), U64)
            found[n - 1][language] = (grams, above, counts.astype(float))
            longer = at
    tables = ([], [], [], [])
    for n in range(order):
        keys = np.unique(np.concatenate([found[n][x][0] for x in languages]))
        contexts = np.unique(np.concatenate([found[n][x][1] for x in languages]))
        parts = np.zeros((len(keys), len(languages)))
        weights = np.ones((len(contexts), len(languages)))
        for k, language in enumerate(languages):
            grams, above, counts = found[n][language]
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            place = np.searchsorted(contexts, above)
            total = np.bincount(place, counts, len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            parts[np.searchsorted(keys, grams), k] = np.maximum(counts - discount, 0) / total[place]
            seen = total > 0
            weights[seen, k] = discount * kinds[seen] / total[seen]
        for table, value in zip(tables, (keys, parts, contexts, weights), strict=True):
            table.append(value)
    return LanguageModel(languages, order, *tables, floor=1 / (len(alphabet) + 1))


def train(labelled: DataFrame, rows: int = SAMPLE_ROWS, order: int = ORDER) -> LanguageModel | None:
    """Fit on at most `rows` labelled texts of each language (those of smallest hash of id and text,
    each once, however many rows repeat it).

    A quarter of them is kept back to fit the sharpness of the score and the limit of rejection.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("_key"))
    ids = smallest_hashes(known.select(F.col("_key").alias("doc_id"), "lang").distinct(), "lang", F.lit(rows), rows)
    ids = ids.select(F.col("doc_id").alias("_key"), "lang", "_rank").dropDuplicates(["_key", "lang"])
    chosen = known.join(with_broadcast(ids), ["_key", "lang"]).dropDuplicates(["_key", "lang"])
    sample = chosen.select("lang", "text", "_rank", "doc_id").toPandas().sort_values(["lang", "_rank", "doc_id", "text"])
    if sample.empty:
        return None
    kept = sample["_rank"] % 4 == 0
    model = fit({x: list(part["text"]) for x, part in sample[~kept].groupby("lang")} if (~kept).any() else {x: list(p["text"]) for x, p in sample.groupby("lang")}, order)
    test = sample[kept & sample["lang"].isin(model.languages)]
    if len(test) < 8:
        return model
    loss = text_losses(model, list(test["text"]))
    truth = np.array([model.languages.index(x) for x in test["lang"]])
    rate = loss[:, :-1] / np.maximum(loss[:, -1:], 1)
    own = rate[np.arange(len(truth)), truth]
    model.limit = float(np.quantile(own, 0.99) * 1.25)

    def badness(sharpness: float) -> float:
        power = sharpness * np.sqrt(np.maximum(loss[:, -1:], 1))
        scaled = (rate.min(axis=1, keepdims=True) - rate) * power
        chance = np.exp(scaled) / np.exp(scaled).sum(axis=1, keepdims=True)
        return -np.log(np.maximum(chance[np.arange(len(truth)), truth], 1e-12)).mean()

    model.sharpness = min((0.25, 0.5, 1.0, 2.0, 4.0, 8.0), key=badness)
    return model


def text_losses(model: LanguageModel, texts: list[str | None], memory: Remembered | None = None) -> np.ndarray:
    memory = memory or Remembered(model.score, len(model.languages) + 1)
    out = []
    for piece in text_pieces(texts):
        words = Words(piece)
        scores, place = memory.of(words)
        out.append(sums(scores[place], words.texts_of(), len(piece)))
    return np.concatenate(out) if out else np.zeros((0, len(model.languages) + 1))


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean"
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    if model is None:
        return rows.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        memory = Remembered(model.score, len(model.languages) + 1)
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            loss = text_losses(model, batch.column(1).to_pylist(), memory)
            best, score, rejected = model.judge(loss)
            best = np.where(loss[:, -1] > 0, best, len(model.languages))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(run, schema)


def id_hash(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_hash() % 4 == 2, F.lit(False))
    model = train(docs.filter(~held_out & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", "text"), model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )
