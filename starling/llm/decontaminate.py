"""Benchmark decontamination by winnowing.

Of every `window - gram + 1` consecutive gram hashes the smallest is kept, on both sides; two texts
that share `window` consecutive words therefore share a kept hash. Documents and benchmark are
joined on kept hashes, and each document found is extended: its windows are compared with those
of the benchmark as strings, so a hit is exact and every shared span is found.

Items with fewer than `window` words are one window each; their length is added to the grams of
the documents only where such items exist.

Defined results: a null text has no words (no hits, no windows; an item without words occurs
nowhere). Repeated items or rows change nothing. Rows that share a doc_id count as one document:
each row gets the hits found in any of them. A row without doc_id is a document of its own (equal
texts have equal hits). Words are read from whole texts, A-Z lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import head, lower_ascii, saved, shifted, with_broadcast
from starling.llm.registry import query

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 4


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _slide(array: Column, by: int, fold) -> Column:
    """fold(element, element `by` places on), as long as both exist."""
    return F.zip_with(head(array, by), shifted(array, by), fold)


def _mix(turn: int):
    """Join two hashes of neighbouring runs; the turn differs by step, so order counts."""

    def join(a: Column, b: Column) -> Column:
        turned = F.shiftleft(a, turn).bitwiseXOR(F.shiftrightunsigned(a, 64 - turn))
        return turned.bitwiseXOR(b)

    return join


def _grams(frame: DataFrame, hashes: str, n: int, out: str) -> DataFrame:
    """Add `out`: hashes of all n-grams, by doubling, each step a projection of its own."""
    width, frame = 1, frame.withColumn(out, F.col(hashes))
    while width < n:
        step = min(width, n - width)
        frame = frame.withColumn(out, _slide(F.col(out), step, _mix(5 + 12 * width % 53)))
        width += step
    return frame


def _minima(frame: DataFrame, column: str, n: int) -> DataFrame:
    """Replace `column` by the minima of its n-element windows, by doubling."""
    width = 1
    while width < n:
        step = min(width, n - width)
        frame = frame.withColumn(column, _slide(F.col(column), step, lambda a, b: F.least(a, b)))
        width += step
    return frame


def fingerprints(
    texts: DataFrame, key: str, window: int, gram: int, short: list[int], text: str = "text"
) -> DataFrame:
    """(key, n_words, prints): the winnowed hashes, and all n-gram hashes for the short lengths."""
    frame = texts.select(F.col(key), _words(F.col(text)).alias("_words"))
    frame = frame.select(
        key,
        F.size("_words").cast("bigint").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    frame = _minima(_grams(frame, "_h", gram, "_g"), "_g", window - gram + 1)
    prints = [F.col("_g")]
    for n in short:
        frame = _grams(frame, "_h", n, f"_s{n}")
        prints.append(_of_length(f"_s{n}", n))
    return frame.select(key, "n_words", F.array_distinct(F.concat(*prints)).alias("prints"))


def _of_length(hashes: str, n: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(n)))


def _runs(words: Column, n: int) -> Column:
    """Every run of n words: (at, length, words)."""
    found = F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)),
        lambda i: F.struct(
            i.alias("at"),
            F.lit(n).alias("length"),
            F.array_join(F.slice(words, i, n), " ").alias("words"),
        ),
    )
    none = F.array().cast("array<struct<at:int,length:int,words:string>>")
    return F.when(F.size(words) >= n, found).otherwise(none)


def _windows(texts: DataFrame, key: str, lengths: list[int], text: str = "text") -> DataFrame:
    """(key, at, length, words): every run of one of the lengths, as a string."""
    frame = texts.select(F.col(key), _words(F.col(text)).alias("_w"))
    runs = F.flatten(F.array(*[_runs(F.col("_w"), n) for n in lengths]))
    return frame.select(key, F.inline(runs))


def _document() -> Column:
    """What a row counts under: its doc_id, or the hash of its text where it has none."""
    text = F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256))
    return F.struct(F.col("doc_id").alias("doc_id"), text.alias("text"))


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_words), (document, at, length) hits, (document, item_id) pairs."""
    docs = docs.select(_document().alias("document"), "text")
    items = benchmark.select("item_id", "text", F.size(_words(F.col("text"))).alias("_n"))
    short = [
        r["_n"]
        for r in items.filter((F.col("_n") > 0) & (F.col("_n") < window)).select("_n").distinct().collect()
    ]
    short.sort()
    long_items = items.filter(F.col("_n") >= window)
    bench_prints = fingerprints(long_items, "item_id", window, gram, []).select(
        F.explode("prints").alias("print")
    )
    bench_windows = _windows(long_items, "item_id", [window])
    for n in short:
        own = items.filter(F.col("_n") == n)
        hashed = own.select(F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("_h"))
        bench_prints = bench_prints.unionByName(
            _grams(hashed, "_h", n, "_g").select(
                F.explode(_of_length("_g", n)).alias("print")
            )
        )
        bench_windows = bench_windows.unionByName(_windows(own, "item_id", [n]))
    bench_prints = saved(bench_prints.distinct(), "bench-prints")
    bench_windows = saved(bench_windows.select("item_id", "words").distinct(), "bench-windows")

    known = saved(fingerprints(docs, "document", window, gram, short), "doc-prints")
    found = (
        known.select("document", F.explode("prints").alias("print"))
        .join(with_broadcast(bench_prints), "print")
        .select("document")
        .distinct()
    )
    # Documents are never null; the nulls inside of them are equal.
    chosen = docs.join(saved(found, "candidates"), "document", "left_semi")
    wanted = with_broadcast(saved(bench_windows.select("words").distinct(), "windows"))
    hits = saved(
        _windows(chosen, "document", [window, *short]).join(wanted, "words", "left_semi"), "hits"
    )
    pairs = (
        hits.select("document", "words")
        .distinct()
        .join(with_broadcast(bench_windows), "words")
        .select("document", "item_id")
        .distinct()
    )
    return known.select("document", "n_words"), hits.select("document", "at", "length").distinct(), pairs


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) per row of `docs`."""
    rows, hits, pairs = benchmark_hits(docs, benchmark, window, gram)
    # Overlapping runs of one document, joined end to end; never more than its words.
    spans = hits.groupBy("document").agg(
        F.sort_array(F.collect_list(F.struct("at", "length"))).alias("_spans")
    )
    covered = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["at"] + s["length"]).alias("end"),
            (
                acc["n"]
                + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(acc["end"], s["at"]))
            ).cast("bigint").alias("n"),
        ),
        lambda acc: acc["n"],
    )
    items = pairs.groupBy("document").agg(
        F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")
    )
    marked = spans.select("document", covered.alias("n_hit")).join(items, "document", "left")
    none = F.array().cast("array<string>")
    return rows.join(marked, "document", "left").select(
        "document.doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.size(F.when(F.col("item_ids").isNotNull(), F.col("item_ids"))), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any word of a benchmark window."""
    _, hits, _ = benchmark_hits(docs.select("doc_id", "text"), benchmark)
    dirty = hits.select(F.col("document").alias("__dirty")).distinct()
    return docs.join(dirty, _document() == F.col("__dirty"), "left_anti")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, len(s) AS n, array_to_string(s, ' ') AS k FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS s
    FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT doc_id, n, i, k FROM dw WHERE k IN (SELECT k FROM bw)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit JOIN bw USING (k) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op6_benchmark_decontamination", OP6_SQL)
def op6_benchmark_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate(docs, bench).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
