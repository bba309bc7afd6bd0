"""Training samples where one doc_id, or none, stands on a large share of the rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from starling.llm import language, toxicity

WORDS = {"en": ["the", "house", "with", "light", "water"], "de": ["das", "haus", "mit", "licht", "wasser"]}


def sentence(rng, lang):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(12))


def test_languages_do_not_vanish_and_samples_stay_bounded(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(7, sentence(rng, "en"), "en") for _ in range(3000)] + [(None, sentence(rng, "de"), "de") for _ in range(3000)]
    rows += [(8, "repeated text of one row", "en")] * 3000
    sizes = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda texts, *rest: sizes.extend(map(len, texts.values())) or fit(texts, *rest))
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), rows=100)
    assert model is not None and sorted(model.languages) == ["de", "en"]
    assert all(50 <= n <= 100 for n in sizes)


def test_toxicity_takes_one_text_of_a_repeated_id(spark, monkeypatch):
    rng = random.Random(2)
    docs = [(i, sentence(rng, "en" if i % 2 else "de")) for i in range(60)] + [(1, sentence(rng, "en")) for _ in range(3000)]
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    sizes = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks: sizes.append(len(texts)) or fit(texts, marks))
    assert toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"), labels) is not None
    assert sizes == [60]
