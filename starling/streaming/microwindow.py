"""Flush windows of a replayed capture: each opens at the first event after the last closed.

A window opens at an event and closes when an event arrives `seconds` or more later, which
opens the next one. Every start depends on the one before; still no task walks the stream.
`next(t)`, the first event at or after t + seconds, is computed for all events at once, and
the events reached from the first one by `next` are found by doubling: after k rounds 2^k
windows are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.functions.ranking import rank_within
from starling.session import durable

MAX_ROUNDS = 64


def _successors(times: DataFrame, width: int) -> DataFrame:
    """(t, nxt) for the distinct times that have an event `width` or more later."""
    placed = times.withColumn("bucket", F.floor(F.col("t") / width))
    # Buckets of one width: the target of t lies in the bucket after t's, or further on.
    buckets = durable(
        rank_within(placed.groupBy("bucket").agg(F.min("t").alias("first")), [], ["bucket"], "r")
    )
    one = buckets.select((F.col("r") - 1).alias("r"), F.col("bucket").alias("b1"), F.col("first").alias("f1"))
    two = buckets.select((F.col("r") - 2).alias("r"), F.col("first").alias("f2"))
    around = buckets.select("r", "bucket").join(one, "r", "left").join(two, "r", "left").drop("r")
    queries = placed.select((F.col("bucket") + 1).alias("bucket"), (F.col("t") + width).alias("at"), "t")
    events = placed.select("bucket", F.col("t").alias("at"), F.lit(None).cast("bigint").alias("t"))
    # Going down in time, the smallest event so far is the first at or after the query.
    down = Window.partitionBy("bucket").orderBy(F.desc("at")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = queries.unionByName(events).withColumn(
        "same", F.min(F.when(F.col("t").isNull(), F.col("at"))).over(down)
    )
    inside = found.filter(F.col("t").isNotNull()).select("t", "same")
    joined = placed.join(inside, "t").join(around, "bucket", "left")
    adjacent = F.col("b1") == F.col("bucket") + 1
    later = F.when(adjacent, F.coalesce("same", "f2")).otherwise(F.col("f1"))
    return joined.select("t", later.alias("nxt")).filter(F.col("nxt").isNotNull())


def window_starts(times: DataFrame, seconds: int) -> DataFrame:
    """Start times (µs) of the windows over the distinct event times `t` (µs)."""
    width = seconds * 1_000_000
    distinct = durable(times.select("t").distinct())
    jump = durable(_successors(distinct, width))
    starts = durable(distinct.agg(F.min("t").alias("t")).filter(F.col("t").isNotNull()))
    for _ in range(MAX_ROUNDS):
        reached = durable(starts.join(jump, "t").select(F.col("nxt").alias("t")))
        if reached.isEmpty():
            break
        starts = starts.union(reached)
        further = jump.select(F.col("t").alias("nxt"), F.col("nxt").alias("_far"))
        jump = durable(jump.join(further, "nxt").select("t", F.col("_far").alias("nxt")))
    return starts


def assign_windows(events: DataFrame, seconds: int, time_us: str = "time_us") -> DataFrame:
    """Add window_start (µs) and batch_index (0, 1, …) to every event.

    A bucket of one window's width holds at most one start, so an event's window started in
    its own bucket or the one before: an equi-join, with exactly one match.
    """
    width = seconds * 1_000_000
    starts = window_starts(events.select(F.col(time_us).alias("t")), seconds)
    numbered = rank_within(starts, [], ["t"], "_rank").select(
        F.col("t").alias("window_start"), (F.col("_rank") - 1).alias("batch_index")
    )
    bucket = F.floor(F.col("window_start") / width)
    spread = numbered.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1)))
    placed = events.withColumn("_bucket", F.floor(F.col(time_us) / width))
    inside = (F.col(time_us) >= F.col("window_start")) & (F.col(time_us) < F.col("window_start") + width)
    return placed.join(spread, "_bucket").filter(inside).drop("_bucket")
