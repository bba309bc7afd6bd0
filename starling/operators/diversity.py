"""Lexical diversity, readability, tf-idf and similarity of groups of texts.

`docs` is (group, doc_id, text) with one row per doc_id. Pairwise similarity is never
computed pair by pair: on unit vectors the sum over all pairs is a function of the
vectors' sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.functions import text as X
from starling.functions.plan import settle
from starling.functions.scalars import hash_text
from starling.session import written
from starling.sources.tables import path_exists


def distinct_1(docs: DataFrame) -> DataFrame:
    tokens = docs.select("group", F.explode(X.split_words(F.col("text"))).alias("token"))
    return _distinct_ratio(docs, tokens, ["token"], "distinct_1")


def distinct_2(docs: DataFrame) -> DataFrame:
    """Bigrams never cross texts."""
    split = settle(docs, {"t": X.split_words(F.col("text"))}, ["group"])
    # Words hold no space, so two of them joined by one are a pair and no other.
    before = F.expr("slice(t, 1, greatest(size(t) - 1, 0))")
    after = F.expr("slice(t, 2, greatest(size(t) - 1, 0))")
    pairs = F.zip_with(before, after, lambda a, b: F.concat_ws(" ", a, b))
    bigrams = split.select("group", F.explode(pairs).alias("pair"))
    return _distinct_ratio(docs, bigrams, ["pair"], "distinct_2")


def _distinct_ratio(docs: DataFrame, items: DataFrame, keys: list[str], name: str) -> DataFrame:
    counted = items.groupBy("group", *keys).agg(F.count("*").alias("n"))
    ratio = counted.groupBy("group").agg(F.round(F.count("*") / F.sum("n"), 4).alias(name))
    groups = docs.select("group").distinct()
    return groups.join(ratio, "group", "left").fillna({name: 0.0})


def readability_counts(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        "group", "doc_id",
        F.size(X.alphabetic_words(text)).alias("words"),
        X.sentence_count(text).alias("sentences"),
        X.syllable_count(text).alias("syllables"),
        F.length(text).alias("n_chars"),
    )


def readability(docs: DataFrame) -> DataFrame:
    counted = readability_counts(docs)
    grade, ease = X.readability(F.col("words"), F.col("sentences"), F.col("syllables"))
    return counted.withColumns({"grade_level": grade, "reading_ease": ease})


def _terms(docs: DataFrame, *lists: Column) -> DataFrame:
    """(doc_id, lists, token, tf): texts are dealt by doc_id, and each is cut, sorted and counted in its task.

    A text is shuffled once instead of its tokens, and no hash table of tokens is held.
    """
    whole = docs.groupBy("doc_id").agg(F.collect_list(F.lower("text")).alias("texts"), *lists)
    kept = [c for c in whole.columns if c != "texts"]
    found = F.flatten(F.transform("texts", lambda t: F.regexp_extract_all(t, F.lit(f"{X.WORD}{{2,}}"), F.lit(0))))
    cut = settle(whole, {"tokens": F.sort_array(found)}, kept)
    tokens = F.col("tokens")
    starts = F.transform("tokens", lambda t, i: F.when((i == 0) | (t != tokens[F.greatest(i - 1, F.lit(0))]), i))
    runs = settle(cut, {"place": F.array_compact(starts)}, [*kept, "tokens"])
    after = lambda j: F.coalesce(F.get("place", j + 1), F.size("tokens"))
    counted = F.transform(
        "place", lambda p, j: F.struct(tokens[p].alias("token"), (after(j) - p).cast("bigint").alias("tf"))
    )
    return runs.select(*kept, F.inline(counted))


def term_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, token, tf); the tokens of one text are counted before they leave its task."""
    return _terms(docs)


def idf(n_docs: Column, df: Column) -> Column:
    return F.log((1 + n_docs) / (1 + df)) + 1


def tfidf_raw(docs: DataFrame) -> tuple[DataFrame, Column]:
    """(doc_id, token, weight) before normalisation, and the vocabulary size.

    The texts are cut into tokens once; counts and document frequencies are written, so that the
    join reads two tables. A token in most texts is a hot key on the counts' side only, whose
    partition AQE splits; the other side has one row per token and is hashed, so neither is sorted.
    """
    counts = written(term_counts(docs), "term-counts")
    frequency = written(counts.groupBy("token").agg(F.count("*").alias("df")), "term-frequency")
    n_docs = docs.agg(F.count("*")).scalar()
    vocabulary = frequency.agg(F.count("*")).scalar()
    weights = counts.join(frequency.hint("shuffle_hash"), "token").select(
        "doc_id", "token", (F.col("tf") * idf(n_docs, F.col("df"))).alias("weight")
    )
    return weights, vocabulary


def tfidf(docs: DataFrame) -> DataFrame:
    """L2-normalised tf-idf over the vocabulary of all groups together."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("doc_id")))
    return tfidf_raw(docs)[0].withColumn("norm", norm).select(
        "doc_id", "token", (F.col("weight") / F.col("norm")).alias("weight")
    )


def _gini_sums(weights: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, s1, s0, k) from non-zero weights (keys, weight), for `_gini_value`."""
    ranked = weights.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("weight")))
    return ranked.groupBy(*keys).agg(
        F.sum(F.col("r") * F.col("weight")).alias("s1"), F.sum("weight").alias("s0"), F.count("*").alias("k")
    )


def _gini_value(v: Column) -> Column:
    """Gini over the full vocabulary of `v` tokens.

    With k non-zeros the zeros take the first v − k places, so only ranks among the
    non-zeros of one text are needed. Scaling a text's weights leaves the value unchanged.
    """
    return (2 * F.col("s1") / F.col("s0") + v - 2 * F.col("k") - 1) / v


def gini(docs: DataFrame) -> DataFrame:
    """(group, doc_id, gini); texts without tokens have 0."""
    weights, vocabulary = tfidf_raw(docs)
    # The vocabulary size meets one row per text, not every weight.
    sums = _gini_sums(weights.select("doc_id", "weight"), ["doc_id"])
    values = sums.select("doc_id", _gini_value(vocabulary).alias("gini"))
    return docs.select("group", "doc_id").join(values, "doc_id", "left").fillna({"gini": 0.0})


def group_metrics(docs: DataFrame) -> DataFrame:
    """Mean length, ease, grade, gini and distinct-1/2 per group, rounded to 4."""
    read = readability(docs).groupBy("group").agg(
        F.round(F.avg("n_chars"), 4).alias("mean_post_length"),
        F.round(F.avg("reading_ease"), 4).alias("mean_post_reading_ease"),
        F.round(F.avg("grade_level"), 4).alias("mean_post_reading_grade_level"),
    )
    spread = gini(docs).groupBy("group").agg(F.round(F.avg("gini"), 4).alias("mean_gini"))
    return read.join(spread, "group").join(distinct_1(docs), "group").join(distinct_2(docs), "group")


def running_gini(docs: DataFrame) -> DataFrame:
    """Mean gini per (call, group) over all texts generated up to that call.

    `docs` also has `call`: NULL for the examples, 1.. for generated texts. Every call has
    its own document frequencies, so each text counts once for each call it is part of.
    """
    last = docs.agg(F.max("call")).scalar()
    member = docs.withColumn("first", F.coalesce(F.col("call"), F.lit(1).cast("bigint"))).withColumn("last", last)
    calls = F.sequence("first", "last")
    # A text is counted once, with the calls it is part of; its tokens are repeated for them only after
    # the join, as numbers. Texts without an id have no weights.
    named = member.filter(F.col("doc_id").isNotNull())
    counts = written(_terms(named, F.flatten(F.collect_list(calls)).alias("calls")), "running-counts")
    frequency = written(
        counts.select("token", F.explode("calls").alias("upto")).groupBy("upto", "token").agg(F.count("*").alias("df")),
        "running-frequency",
    )
    by_token = frequency.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("upto", "df"))).alias("dfs"))
    member = member.select("group", "doc_id", F.explode(calls).alias("upto"))
    # One row per call.
    sizes = member.groupBy("upto").agg(F.count("*").alias("n_docs"))
    vocabulary = frequency.groupBy("upto").agg(F.count("*").alias("v"))
    joined = counts.join(by_token.hint("shuffle_hash"), "token").select("doc_id", "tf", "dfs", F.explode("calls").alias("upto"))
    weights = joined.join(F.broadcast(sizes), "upto").select(
        "upto", "doc_id", (F.col("tf") * idf(F.col("n_docs"), F.col("dfs")[F.col("upto")])).alias("weight")
    )
    sums = _gini_sums(weights, ["upto", "doc_id"]).join(F.broadcast(vocabulary), "upto")
    values = sums.select("upto", "doc_id", _gini_value(F.col("v")).alias("gini"))
    every = member.join(values, ["upto", "doc_id"], "left").fillna({"gini": 0.0})
    return every.groupBy("upto", "group").agg(
        F.round(F.avg("gini"), 4).alias("mean_gini"), F.count("*").alias("n_posts")
    )


def unit_vectors(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(group, pos, x): components of each vector divided by its length."""
    values = F.col(embedding).cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform(values, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))
    return vectors.select("group", F.posexplode(unit).alias("pos", "x"))


def _vector_sums(vectors: DataFrame, embedding: str) -> DataFrame:
    return unit_vectors(vectors, embedding).groupBy("group", "pos").agg(
        F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n")
    )


def mean_pairwise_cosine(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """(group, mean cosine over unordered pairs); 0 below two vectors.

    Σ over pairs i≠j of u_i·u_j = |Σu|² − Σ|u|².
    """
    sums = _vector_sums(vectors, embedding).groupBy("group").agg(
        F.sum(F.col("s") * F.col("s")).alias("total"), F.sum("q").alias("own"), F.max("n").alias("n")
    )
    n = F.col("n")
    mean = F.when(n >= 2, (F.col("total") - F.col("own")) / (n * (n - 1))).otherwise(0.0)
    return sums.select("group", mean.alias("mean_cosine"))


def mean_cross_cosine(
    vectors: DataFrame, left: str, right: str, embedding: str = "embedding"
) -> DataFrame:
    """Mean cosine over all pairs of two groups: Σa·Σb / (n_a·n_b)."""
    sums = _vector_sums(vectors.filter(F.col("group").isin(left, right)), embedding)
    by_pos = sums.groupBy("pos").agg(
        F.sum(F.when(F.col("group") == left, F.col("s"))).alias("a"),
        F.sum(F.when(F.col("group") == right, F.col("s"))).alias("b"),
        F.max(F.when(F.col("group") == left, F.col("n"))).alias("na"),
        F.max(F.when(F.col("group") == right, F.col("n"))).alias("nb"),
    )
    return by_pos.agg((F.sum(F.col("a") * F.col("b")) / (F.max("na") * F.max("nb"))).alias("mean_cosine"))


def tfidf_similarity(docs: DataFrame, generated: str, examples: str) -> DataFrame:
    """Mean pairwise cosine inside `generated` and mean cosine to `examples`, on tf-idf."""
    weights = tfidf(docs).join(docs.select("doc_id", "group"), "doc_id")
    by_token = weights.groupBy("token").agg(
        F.coalesce(F.sum(F.when(F.col("group") == generated, F.col("weight"))), F.lit(0.0)).alias("g"),
        F.coalesce(F.sum(F.when(F.col("group") == examples, F.col("weight"))), F.lit(0.0)).alias("e"),
    )
    # Lengths of normalised texts are 1; texts without tokens add nothing.
    own = weights.filter(F.col("group") == generated).agg(F.count_distinct("doc_id")).scalar()
    n_g = docs.agg(F.count_if(F.col("group") == generated)).scalar()
    n_e = docs.agg(F.count_if(F.col("group") == examples)).scalar()
    sums = by_token.agg(F.sum(F.col("g") * F.col("g")).alias("gg"), F.sum(F.col("g") * F.col("e")).alias("ge"))
    return sums.select(
        ((F.col("gg") - own) / (n_g * (n_g - 1))).alias("mean_cos_sim"),
        (F.col("ge") / (n_g * n_e)).alias("mean_sim_to_examples"),
    )


Embedder = Callable[[list[str]], list[list[float]]]
CACHE_SCHEMA = "hash string, text string, embedding array<double>, metadata string"


def missing_embeddings(texts: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct texts whose hash the cache does not hold."""
    hashed = texts.select(hash_text(F.col("text")).alias("hash"), "text")
    unique = hashed.groupBy("hash").agg(F.min("text").alias("text"))
    return unique.join(cache.select("hash"), "hash", "left_anti")


def compute_embeddings(missing: DataFrame, embedder: Embedder, model: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = embedder(batch["text"].tolist())
            yield pd.DataFrame(
                {"hash": batch["hash"], "text": batch["text"], "embedding": vectors,
                 "metadata": f'{{"model": "{model}"}}'}
            )

    return missing.mapInPandas(run, CACHE_SCHEMA)


def refresh_embedding_cache(texts: DataFrame, cache_path: str, embedder: Embedder, model: str) -> DataFrame:
    """Append the missing texts to the cache table and return texts with their vectors."""
    spark = texts.sparkSession
    reader = spark.read.schema(CACHE_SCHEMA)
    cache = reader.parquet(cache_path) if path_exists(spark, cache_path) else spark.createDataFrame([], CACHE_SCHEMA)
    fresh = compute_embeddings(missing_embeddings(texts, cache), embedder, model)
    fresh.write.mode("append").option("compression", "zstd").parquet(cache_path)
    whole = reader.parquet(cache_path).select("hash", "embedding").dropDuplicates(["hash"])
    return texts.withColumn("hash", hash_text(F.col("text"))).join(whole, "hash")
