"""Exact ranks, running totals and order statistics that no single task computes alone.

A window over one key (or over everything) sorts that key in one task. Here the rows
are range-partitioned by (key, order), so a key holding a third of the data lies in
many partitions; each partition sums its own part and a table with one row per
(partition, key) carries the totals of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.session import durable

PART = "_part"
#: Larger limits are not pushed below the shuffle by Spark.
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def _range_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    by = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    laid = df.repartitionByRange(*by) if by else df
    # The partition number decides later offsets, so it is written down, not recomputed.
    return durable(laid.withColumn(PART, F.spark_partition_id()))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: Column,
    out: str,
) -> DataFrame:
    """Add `out`: the sum of `value` over this row and the rows of its key before it.

    `order` must end in something unique inside a key, which also lets the rows of one
    hot key spread over partitions.
    """
    parts = _range_parts(df.withColumn("_value", value), keys, order)
    columns = [c for c in parts.columns if c not in (PART, "_value")]
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    inside = (
        Window.partitionBy(PART, *keys)
        .orderBy(*by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = parts.withColumn("_local", F.sum("_value").over(inside))
    # At most one row per (partition, key): a hot key contributes one per partition.
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(PART, *keys)
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    on = F.col(f"l.{PART}") == F.col(f"o.{PART}")
    for key in keys:
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"o.{key}"))
    joined = local.alias("l").join(offsets.alias("o"), on, "inner")
    return joined.select(
        *[F.col(f"l.{c}").alias(c) for c in columns],
        (F.col("_local") + F.col("_offset")).alias(out),
    )


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str
) -> DataFrame:
    """Add `out`: 1, 2, … in `order` inside each key (over everything when no keys)."""
    if keys or not order:
        return running_total(df, keys, order, F.lit(1).cast("bigint"), out)
    # Without keys a range partition holds consecutive rows: sorted and numbered where they are, so no
    # second shuffle brings several partitions into one task.
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by)
    parts = durable(laid.withColumns({PART: F.spark_partition_id(), "_local": inside}))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(PART).agg(F.count("*").alias("_size"))
    offsets = sizes.select(PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    # One row per partition.
    joined = parts.join(F.broadcast(offsets), PART)
    return joined.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(out))


def chunk_index(
    df: DataFrame, size: int, order: Sequence[str | Column], keys: Sequence[str] = (), out: str = "chunk"
) -> DataFrame:
    """Add `out`: 0 for the first `size` rows in order, 1 for the next, …"""
    ranked = rank_within(df, keys, order, "_rank")
    return ranked.withColumn(out, F.floor((F.col("_rank") - 1) / size)).drop("_rank")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str) -> DataFrame:
    """First `n` rows of each key with their rank; `order` ends in something unique.

    Up to the session's group limit, each map task keeps only its own first `n` per key before the
    shuffle, so a hot key sends n rows per task. Beyond it Spark would sort a whole key in
    one task, so the exact distributed rank is used.
    """
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT_CONF, "1000")):
        ranked = rank_within(df, keys, order, out)
        return ranked.filter(F.col(out) <= n)
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= n)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n, cum): how many rows have each value and how many up to it."""
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )
    return running_total(counted, keys, [value], F.col("n"), "cum")


def order_statistics(
    df: DataFrame, keys: Sequence[str], value: str, positions: Mapping[str, Column]
) -> DataFrame:
    """One row per key: for each name the value at that 0-based position in sorted order.

    Positions are expressions over `n_rows`, the number of values of the key. Equal
    values are counted first, so the sort handles distinct values only.
    """
    cumulative = value_counts(df, keys, value)
    sizes = cumulative.groupBy(*keys).agg(F.sum("n").alias("n_rows"))
    on = F.lit(True)
    if keys:
        on = F.lit(True)
        for key in keys:
            on = on & F.col(f"c.{key}").eqNullSafe(F.col(f"s.{key}"))
        joined = cumulative.alias("c").join(sizes.alias("s"), on).select("c.*", "s.n_rows")
    else:
        joined = cumulative.withColumn("n_rows", sizes.scalar())
    first = F.col("cum") - F.col("n")
    picks = [
        F.max(F.when((first <= position) & (position < F.col("cum")), F.col(value))).alias(name)
        for name, position in positions.items()
    ]
    return joined.groupBy(*keys).agg(F.max("n_rows").alias("n_rows"), *picks)


def nearest_rank_position(pct: float) -> Column:
    """round-half-even(pct/100·n) − 1, kept inside the list."""
    n = F.col("n_rows")
    raw = F.bround(F.lit(pct) / 100.0 * n, 0).cast("bigint") - 1
    return F.greatest(F.lit(0).cast("bigint"), F.least(n - 1, raw))


def linear_positions(pct: float) -> tuple[Column, Column, Column]:
    """(lower position, upper position, weight of the upper one)."""
    n = F.col("n_rows")
    rank = (n - 1) * F.lit(pct / 100.0)
    lower = F.floor(rank)
    return lower, F.least(lower + 1, n - 1), rank - lower


def linear_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, pcts: Mapping[str, float]
) -> DataFrame:
    positions: dict[str, Column] = {}
    for name, pct in pcts.items():
        lower, upper, _ = linear_positions(pct)
        positions[f"_{name}_lo"] = lower
        positions[f"_{name}_hi"] = upper
    stats = order_statistics(df, keys, value, positions)
    out = []
    for name, pct in pcts.items():
        weight = linear_positions(pct)[2]
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low * (1 - weight) + high * weight).alias(name))
    return stats.select(*keys, "n_rows", *out)
