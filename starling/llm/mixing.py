"""Mixing sources to target weights by hash thresholds, without sorting documents.

Every source gets a target number of words: its weight's share of the budget, at most `most` times
the words it has; what a source cannot take is shared again by weight among the others. A target is
so many whole rounds of the source plus a rest; the rest is taken from the documents whose hash lies
below a threshold. Thresholds are nested: a larger budget takes every document a smaller one takes.

A threshold comes from a histogram of words by source and leading hash bits. Only the bucket in
which the running sum passes the rest is read again, with further bits, until it holds one hash
value; that last document is taken if this brings the source nearer to its target, so a source
misses its target by at most half of one document. At most `1 << BITS` buckets of a source meet in
one task; the documents of a hot source never do.

Defined results: a null or wordless text has size 0 and nothing is taken of it. The hash covers
doc_id and text, so rows that share a doc_id are drawn apart; equal rows share a hash, and as
many of them are taken as come nearest to the target. A missing source is a source of its own,
the last one. Other columns of the input, whatever their names, are not looked at. An empty table
gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import rank_within, running_total
from starling.llm.common import saved, with_broadcast
from starling.llm.registry import query

#: Hash bits in all, and those by which a level of the histogram splits a bucket.
HASH_BITS, BITS = 60, 10
#: Everything in a text but the last character of each word.
NOT_LAST = r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])"


def word_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_LAST, "")).cast("bigint")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of doc_id and text: the same in every run, engine and layout."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def source_targets(sources: DataFrame, budget: int, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size).

    The sources, in order of their code points, weigh `weights`, repeating. Ordered by size over
    weight, the sources that reach their limit come first, and the first one that does not gives the
    share of a unit of weight; whole numbers decide, in 38 digits.
    """
    listed = sources.withColumn("_none", F.col("source").isNull())
    placed = rank_within(listed, [], ["_none", "source"], "_place")
    cycle = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    weighed = placed.withColumn("weight", cycle[((F.col("_place") - 1) % len(weights)).cast("int")])
    unit = F.lit(math.lcm(*weights)).cast("bigint")
    weighed = weighed.withColumn("_fill", F.col("source_size") * (unit / F.col("weight")).cast("bigint"))
    sized = running_total(weighed, [], ["_fill", "_place"], F.col("source_size"), "_size_to")
    level = saved(running_total(sized, [], ["_fill", "_place"], F.col("weight"), "_weight_to"), "mix-sources")
    total = level.agg(F.sum("weight")).first()[0] or 0
    wide = "decimal(38,0)"
    left = F.lit(budget).cast(wide) - (F.col("_size_to") - F.col("source_size")).cast(wide) * most
    heavy = F.lit(total) - (F.col("_weight_to") - F.col("weight"))
    limit = F.col("source_size").cast(wide) * most
    open_ = level.filter(left * F.col("weight") <= limit * heavy).orderBy("_fill", "_place")
    first = open_.select(left.cast("double").alias("left"), heavy.cast("double").alias("heavy")).first()
    target = F.col("source_size").cast("double") * most
    if first is not None:
        target = F.least(target, F.lit(first["left"]) * F.col("weight") / F.lit(first["heavy"]))
    return level.select("source", "source_size", target.alias("target"))


def _histogram(rows: DataFrame, open_: DataFrame, shift: int) -> DataFrame:
    """Of every open source the bucket in which the sum passes what it needs."""
    from pyspark.sql import Window

    counted = (
        rows.groupBy("source", F.shiftright("hash", shift).alias("bucket"))
        .agg(F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    )
    joined = counted.alias("c").join(with_broadcast(open_).alias("o"), _same_source("c", "o"))
    # At most 1 << BITS buckets of a source.
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = joined.select("c.*", "o.need").withColumn("_to", F.sum("words").over(order))
    passed = (F.col("_to") - F.col("words") < F.col("need")) & (F.col("need") <= F.col("_to"))
    return summed.filter(passed).withColumn("need", F.col("need") - F.col("_to") + F.col("words")).drop("_to")


def thresholds(sized: DataFrame, needs: DataFrame) -> DataFrame:
    """(source, edge, words, rows, need): the hash at which each source's sum passes its need.

    Documents below `edge` are taken; `need` words are then left for the `rows` documents at it.
    """
    rows, open_, found = sized.filter("size > 0"), needs.filter("need > 0"), []
    shift = HASH_BITS - BITS
    while True:
        passed = saved(_histogram(rows, open_, shift), "mix-buckets")
        settled = passed.filter("low = high")
        found.append(settled.select("source", F.col("low").alias("edge"), "words", "rows", "need"))
        buckets = passed.filter("low < high").select("source", "bucket", "need")
        if shift == 0 or buckets.limit(1).count() == 0:
            return reduce(DataFrame.unionByName, found)
        inside = _same_source("r", "b") & (F.shiftright("r.hash", shift) == F.col("b.bucket"))
        rows = saved(rows.alias("r").join(with_broadcast(buckets).alias("b"), inside).select("r.*"), "mix-rows")
        open_, shift = buckets.drop("bucket"), shift - BITS


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    budget: int | None = None,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row.

    `budget` counts words and is all of them unless given; `taken` counts a document's words once
    per round in which the mix takes it.
    """
    body = F.col(f"`{text}`")
    sized = saved(
        docs.select(
            "doc_id",
            F.col(f"`{source}`").cast("string").alias("source"),
            word_count(body).alias("size"),
            document_hash(F.col("doc_id"), body).alias("hash"),
        ),
        "mix-sized",
    )
    sources = saved(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    if budget is None:
        budget = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    targets = source_targets(sources, budget, weights, most)
    goal = F.floor(F.col("target") + 0.5)
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.greatest("source_size", F.lit(1)))).otherwise(0)
    needs = saved(
        targets.withColumn("rounds", rounds.cast("bigint")).withColumn(
            "need", goal - F.col("rounds") * F.col("source_size")
        ),
        "mix-needs",
    )
    edges = saved(thresholds(sized, needs.select("source", "need")), "mix-edges")
    plan = needs.alias("n").join(edges.alias("e"), _same_source("n", "e"), "left").select(
        "n.source", "n.source_size", "n.target", "n.rounds", "e.edge",
        # How many of the documents at the edge come nearest to what is left.
        F.floor((2 * F.col("e.need") * F.col("e.rows") + F.col("e.words")) / (2 * F.col("e.words"))).alias("at_edge"),
        F.col("e.rows").alias("edge_rows"),
    )
    plan = saved(plan, "mix-plan")
    rows = sized.alias("d").join(with_broadcast(plan).alias("p"), _same_source("d", "p"))
    rows = rows.select("d.*", "p.source_size", "p.target", "p.rounds", "p.edge", "p.at_edge", "p.edge_rows")
    split = F.coalesce((F.col("hash") == F.col("edge")) & F.col("at_edge").between(1, F.col("edge_rows") - 1), F.lit(False))
    below = (F.col("hash") < F.col("edge")) | ((F.col("hash") == F.col("edge")) & (F.col("at_edge") > 0))
    extra = F.coalesce(below, F.lit(False)).cast("bigint")
    if plan.filter("at_edge between 1 and edge_rows - 1").limit(1).count():
        # Equal rows share the edge: any `at_edge` of them are taken.
        equal = saved(rows.filter(split & (F.col("size") > 0)).withColumn("_row", F.monotonically_increasing_id()), "mix-equal")
        drawn = rank_within(equal, ["source"], ["_row"], "_rank")
        drawn = drawn.withColumn("_extra", (F.col("_rank") <= F.col("at_edge")).cast("bigint")).drop("_rank", "_row")
        rows = rows.filter(~(split & (F.col("size") > 0))).withColumn("_extra", extra).unionByName(drawn)
    else:
        rows = rows.withColumn("_extra", extra)
    taken = F.col("size") * (F.col("rounds") + F.col("_extra"))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, CAST(sum(source_size) OVER () AS HUGEINT) AS budget,
         CAST(coalesce(sum(source_size) OVER o, 0) AS HUGEINT) AS size_before,
         CAST(sum(w) OVER () AS HUGEINT) - CAST(coalesce(sum(w) OVER o, 0) AS HUGEINT) AS heavy,
         row_number() OVER (ORDER BY source_size * 6 // w, source NULLS LAST) AS place
  FROM s WINDOW o AS (ORDER BY source_size * 6 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT budget - 3 * size_before AS lft, heavy FROM f
  WHERE (budget - 3 * size_before) * w <= 3 * CAST(source_size AS HUGEINT) * heavy ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size,
         coalesce(least(source_size * CAST(3 AS DOUBLE), (SELECT CAST(lft AS DOUBLE) FROM l) * w / (SELECT CAST(heavy AS DOUBLE) FROM l)),
                  source_size * CAST(3 AS DOUBLE)) AS target
  FROM f
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS rounds,
         CAST(floor(target + 0.5) AS BIGINT)
         - CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END * source_size AS need
  FROM t
), c AS (
  SELECT d.*, source_size, target, rounds, need,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (rounds + CASE WHEN upto - size < need AND (upto < need OR 2 * (need - upto + size) >= size) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM c
"""


@query("op13_source_mix", OP13_SQL)
def op13_source_mix(spark, sf_dir):
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
