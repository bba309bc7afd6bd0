"""Membership tests against history, duplicate removal and set operations.

Anti and semi joins are plain Spark joins: AQE broadcasts a side it has measured to be
small and splits a skewed stream side otherwise. Keep-one operators are aggregates
(functions.keep), so a key with many copies never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.keep import keep_first, keep_last


def anti_join_seen(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose id history does not hold; repeats inside the batch stay."""
    return batch.join(history.select(key), key, "left_anti")


def anti_join_counts(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """(kept, skipped) of `anti_join_seen` from one join."""
    seen = history.select(key).distinct().withColumn("_seen", F.lit(True))
    marked = batch.join(seen, key, "left")
    return marked.agg(
        F.count_if(F.col("_seen").isNull()).alias("kept"),
        F.count_if(F.col("_seen").isNotNull()).alias("skipped"),
    )


def seen_ids(on_disk: DataFrame, history: DataFrame, key: str, scope: dict[str, str]) -> DataFrame:
    """Distinct non-empty ids of the current run and of the history in scope."""
    scoped = history
    for column, value in scope.items():
        scoped = scoped.filter(F.col(column) == value)
    ids = on_disk.select(key).union(scoped.select(key))
    return ids.filter(F.col(key) != "").distinct()


def filter_unlabeled(records: DataFrame, key: str, *label_tables: DataFrame) -> DataFrame:
    """Records without a label in any store; label tables carry their id as `uri`."""
    labelled = label_tables[0].select(F.col("uri").cast("string").alias("_id"))
    for more in label_tables[1:]:
        labelled = labelled.union(more.select(F.col("uri").cast("string").alias("_id")))
    return records.join(labelled, F.col(key).cast("string") == F.col("_id"), "left_anti")


def check_new(batch: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Ids of the batch the store does not hold, with the batch's own ordinals."""
    return batch.join(store.select(key), key, "left_anti")


def already_labeled(
    posts: DataFrame, consolidated: DataFrame, chunks: DataFrame, order: Sequence[str], limit: int | None
) -> DataFrame:
    """Posts in neither label store; a limit takes the first of them in order."""
    done = consolidated.select("uri").union(chunks.select("uri"))
    rest = posts.join(done, "uri", "left_anti")
    return rest if limit is None else rest.orderBy(*order).limit(limit)


def drop_already_preprocessed(
    rows: DataFrame, history: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """Ids not in history, one row per id, the last in `order` (run, then position)."""
    return keep_last(anti_join_seen(rows, history, key), [key], order)


def skipped_by_history(rows: DataFrame, history: DataFrame, key: str) -> DataFrame:
    return anti_join_counts(rows, history, key).select("skipped")


def consolidate_labels(existing: DataFrame, chunks: DataFrame, key: str = "uri") -> DataFrame:
    """Existing rows first, then chunks by name; the last row per id stays.

    `chunks` carries `chunk` (its name); both carry `ordinal` (position in its file).
    """
    first = existing.withColumn("chunk", F.lit(""))
    together = first.unionByName(chunks)
    return keep_last(together, [key], ["chunk", "ordinal"]).drop("chunk", "ordinal")


def window_dedupe(rows: DataFrame, order: Sequence[str], window: Sequence[str] = ()) -> DataFrame:
    """First row per uri inside each flush window (one window when none is named)."""
    return keep_first(rows, [*window, "uri"], order)


def unique_ordered(rows: DataFrame, key: str, ordinal: str, limit: int | None = None) -> DataFrame:
    """Distinct non-null ids by first occurrence; a limit stops at that many."""
    first = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(ordinal).alias("first_seen"))
    return first if limit is None else first.orderBy("first_seen").limit(limit)


def union_all(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; columns a part lacks are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def upsert_by_key(old: DataFrame, new: DataFrame, key: str, canonical: Sequence[str]) -> DataFrame:
    """New rows replace old ones; canonical keys come first in their order, then extras.

    Both sides hold one row per key. `position` orders the result: canonical index, then
    old rows' `ordinal`, then new rows' `ordinal`.
    """
    tagged = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    latest = keep_last(tagged, [key], ["_new", "ordinal"])
    first = tagged.groupBy(key).agg(F.min(F.struct("_new", "ordinal")).alias("_first"))
    known = F.array_position(F.array(*[F.lit(c) for c in canonical]), F.col(key))
    # 0 = not canonical: extras follow, oldest first.
    joined = latest.drop("_new").join(first, key)
    return joined.select(
        *[c for c in old.columns],
        (known == 0).alias("is_extra"),
        known.alias("canonical_position"),
        F.col("_first._new").alias("first_new"),
        F.col("_first.ordinal").alias("first_ordinal"),
    )


def validate_resume_sets(stored: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Ids in exactly one of the two sets, with the side that has them."""
    left, right = stored.select(key).distinct(), current.select(key).distinct()
    only_stored = left.join(right, key, "left_anti").withColumn("side", F.lit("stored_only"))
    only_current = right.join(left, key, "left_anti").withColumn("side", F.lit("current_only"))
    return only_stored.union(only_current)


def stream_backfill_union(
    stream: DataFrame, backfill: DataFrame, cutoff: Column, order: Sequence[str]
) -> DataFrame:
    """Stream rows from the cut-over on, backfill rows before it, one row per uri."""
    newer = stream.filter(F.col("created_at") >= cutoff).withColumn("origin", F.lit("stream"))
    older = backfill.filter(F.col("created_at") < cutoff).withColumn("origin", F.lit("backfill"))
    return keep_last(newer.unionByName(older), ["uri"], ["origin", *order])
