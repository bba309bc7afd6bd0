"""Request logs: rollups, cost, latency, scale and store comparisons, flush logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling import constants as C
from starling.functions.ranking import (
    linear_percentiles,
    nearest_rank_position,
    order_statistics,
)
from starling.functions.scalars import classify_key, cost_tier, safe_divide, tier_price

SECONDS_PER_DAY = 86_400
DAYS_PER_MONTH = 30


def classified(calls: DataFrame) -> DataFrame:
    return calls.withColumns(
        {
            "tier": cost_tier(F.col("service"), F.col("operation")),
            "key_class": classify_key(F.col("key")),
        }
    )


def phase_rollup(calls: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """Per phase: calls, bytes, counts by tier, cost, total time, attempts and retries.

    `attempts`: (phase, attempts). Cost is computed from the four counts, so it does not
    depend on the order rows are added in.
    """
    tiers = list(C.TIER_PRICES)
    rolled = classified(calls).groupBy("phase").agg(
        F.count("*").alias("calls"),
        F.sum("request_bytes").alias("request_bytes"),
        F.sum("response_bytes").alias("response_bytes"),
        *[F.count_if(F.col("tier") == t).alias(f"{t}_calls") for t in tiers],
        F.sum("duration_ms").alias("total_ms"),
        F.max("duration_ms").alias("max_ms"),
    )
    cost = F.lit(0.0)
    for tier, price in C.TIER_PRICES.items():
        cost = cost + F.col(f"{tier}_calls") * F.lit(price)
    rolled = rolled.withColumn("cost_usd", cost)
    if attempts is None:
        return rolled
    tried = rolled.join(attempts, "phase", "left")
    retries = F.greatest(F.lit(0).cast("bigint"), F.coalesce("attempts", F.lit(0)) - F.col("calls"))
    return tried.withColumn("retries", retries)


def key_class_rollup(calls: DataFrame) -> DataFrame:
    return classified(calls).groupBy("phase", "key_class", "operation").agg(F.count("*").alias("calls"))


def cost_by_tier(calls: DataFrame) -> DataFrame:
    counted = classified(calls).groupBy("phase", "tier").agg(F.count("*").alias("calls"))
    return counted.withColumn("cost_usd", F.col("calls") * tier_price(F.col("tier")))


def nearest_rank_percentiles(
    rows: DataFrame, keys: Sequence[str], value: str, pcts: Sequence[float]
) -> DataFrame:
    names = {f"p{int(p)}": nearest_rank_position(p) for p in pcts}
    return order_statistics(rows, keys, value, names)


def extrapolate(phases: DataFrame, ingest_phases: Sequence[str], total_rows: Column, batches: int, flush_seconds: int) -> DataFrame:
    """(horizon, rows, ingest_cost, maintenance_cost, total_cost) for run, day and 30 days."""
    seconds = batches * flush_seconds
    day = SECONDS_PER_DAY / seconds
    ingest = F.sum(F.when(F.col("phase").isin(*ingest_phases), F.col("cost_usd")).otherwise(0.0))
    summed = phases.agg(ingest.alias("ingest"), F.sum("cost_usd").alias("total")).withColumn(
        "total_rows", total_rows
    )
    rows = []
    for name, scale in (("measured", 1.0), ("day", day), ("30_days", day * DAYS_PER_MONTH)):
        rows.append(
            F.struct(
                F.lit(name).alias("horizon"),
                (F.col("total_rows") * scale).alias("projected_rows"),
                (F.col("ingest") * scale).alias("ingest_cost"),
                ((F.col("total") - F.col("ingest")) * scale).alias("maintenance_cost"),
                (F.col("total") * scale).alias("total_cost"),
            )
        )
    return summed.select(F.inline(F.array(*rows)))


def latency_stats(rows: DataFrame, keys: Sequence[str], value: str = "duration_ms") -> DataFrame:
    """Interpolated p50/p90/p99, mean, population deviation, rate and count per group."""
    pcts = linear_percentiles(rows, keys, value, {"p50": 50, "p90": 90, "p99": 99}).drop("n_rows")
    basic = rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stddev"),
        safe_divide(F.count(value).cast("double"), F.sum(value) / 1000.0).alias("qps"),
        F.count(value).alias("executions"),
    )
    return basic.join(pcts, list(keys))


def write_amplification(phases: DataFrame, base: str, other: str) -> DataFrame:
    """(metric, base_value, other_value, ratio); ratio NULL where the base is 0."""
    metrics = {"put_calls": "put_calls", "calls": "calls", "request_bytes": "request_bytes",
               "total_ms": "total_ms", "cost_usd": "cost_usd"}
    wide = phases.agg(
        *[
            F.max(F.when(F.col("phase") == phase, F.col(c))).cast("double").alias(f"{side}_{c}")
            for side, phase in (("b", base), ("o", other))
            for c in metrics
        ]
    )
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(f"b_{c}").alias("base_value"),
            F.col(f"o_{c}").alias("other_value"),
            F.try_divide(F.col(f"o_{c}"), F.nullif(F.col(f"b_{c}"), F.lit(0.0))).alias("ratio"),
        )
        for name, c in metrics.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def tier_stats(calls: DataFrame, scales: Sequence[int] = C.TIMING_SCALES) -> DataFrame:
    """Statistics over the first n calls for each n that the log reaches.

    `calls`: call_index (1-based), duration_seconds, repo_size_bytes, error, rate_limited.
    A call belongs to every scale at or above its index, so rows fan out by the number of
    scales only.
    """
    total = calls.agg(F.max("call_index")).scalar()
    reached = F.filter(
        F.array(*[F.lit(n).cast("bigint") for n in sorted(scales)]), lambda n: n >= F.col("call_index")
    )
    members = calls.filter(F.col("call_index") <= max(scales)).withColumn("scale", F.explode(reached))
    members = members.filter(F.col("scale") <= total)
    ok = F.col("error").isNull()
    basic = members.groupBy("scale").agg(
        F.count("*").alias("user_count"),
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("error_count"),
        F.count_if("rate_limited").alias("rate_limited_count"),
        F.sum("duration_seconds").alias("total_elapsed_seconds"),
        F.avg("duration_seconds").alias("mean_seconds"),
        F.min("duration_seconds").alias("min_seconds"),
        F.max("duration_seconds").alias("max_seconds"),
        F.avg(F.when(ok, F.col("repo_size_bytes"))).alias("mean_repo_size_bytes"),
    )
    n = F.col("n_rows")
    middle = order_statistics(
        members, ["scale"], "duration_seconds",
        {"_lo": F.floor((n - 1) / 2), "_hi": F.floor(n / 2), "p95_seconds": F.least(F.floor(n * 0.95), n - 1)},
    )
    picked = middle.select("scale", ((F.col("_lo") + F.col("_hi")) / 2).alias("median_seconds"), "p95_seconds")
    return basic.join(picked, "scale")


# -- stores compared ----------------------------------------------------------


def scale_degradation(results: DataFrame) -> DataFrame:
    """latency at 100 000 ids over latency at none, per backend and batch size; NULL if unknown."""
    wide = results.groupBy("backend", "batch_size").agg(
        F.max(F.when(F.col("table_size") == 0, F.col("check_ms"))).alias("empty_ms"),
        F.max(F.when(F.col("table_size") == 100_000, F.col("check_ms"))).alias("full_ms"),
    )
    ratio = F.round(F.try_divide(F.col("full_ms"), F.nullif("empty_ms", F.lit(0.0))), 3)
    return wide.withColumn("degradation", ratio)


def store_costs(sizes: DataFrame) -> DataFrame:
    """Storage and per-1000-run cost of an object store and a key-value store.

    `sizes`: table_size, batch_size, new_per_run.
    """
    gb = F.col("table_size") * C.BYTES_PER_ID / float(1024**3)
    reads = F.col("batch_size") * C.READ_UNITS_PER_ITEM * 1000 / 1_000_000 * C.READ_UNIT_PRICE_PER_MILLION
    writes = F.col("new_per_run") * C.WRITE_UNITS_PER_ITEM * 1000 / 1_000_000 * C.WRITE_UNIT_PRICE_PER_MILLION
    get, put = 1000 * C.OBJECT_GET_PRICE, 1000 * C.OBJECT_PUT_PRICE
    return sizes.select(
        "table_size", "batch_size",
        F.round(gb * C.OBJECT_GB_MONTH, 6).alias("object_storage_usd"),
        F.round(F.lit(get + put), 6).alias("object_total_usd"),
        F.round(gb * C.KEY_VALUE_GB_MONTH, 6).alias("kv_storage_usd"),
        F.round(reads, 6).alias("kv_read_usd"),
        F.round(writes, 6).alias("kv_write_usd"),
        F.round(reads + writes, 6).alias("kv_total_usd"),
    )


def backend_comparison(results: DataFrame, left: str, right: str) -> DataFrame:
    """Side by side where both backends have the (batch, table) key, with threshold reasons.

    Reasons look at `left`: its degradation for that batch size, its check time here.
    """
    check = F.max(F.when(F.col("backend") == left, F.col("check_ms")))
    other = F.max(F.when(F.col("backend") == right, F.col("check_ms")))
    pairs = results.groupBy("batch_size", "table_size").agg(check.alias("left_ms"), other.alias("right_ms"))
    both = pairs.filter(F.col("left_ms").isNotNull() & F.col("right_ms").isNotNull())
    slower = scale_degradation(results).filter(F.col("backend") == left).select("batch_size", "degradation")
    joined = both.join(slower, "batch_size", "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("degradation") > C.MAX_SCALE_DEGRADATION, F.lit("degradation>3.0")),
            F.when(F.col("left_ms") > C.MAX_CHECK_MS, F.lit("check_ms>5000")),
        )
    )
    return joined.withColumn("reasons", F.array_join(reasons, ";"))


# -- flush logs ----------------------------------------------------------------


def flush_summary(rows: DataFrame, window: str, age_seconds: Column | None = None) -> DataFrame:
    """Per flush window: rows and MB of every record type (0 when none), totals, reason.

    `rows`: window, record_type, row_size. Size wins over age as the reason.
    """
    megabyte = 1_000_000
    sums: list[Column] = []
    for t in C.RECORD_TYPES:
        mine = F.col("record_type") == t
        size = F.sum(F.when(mine, F.col("row_size")).otherwise(F.lit(0)))
        sums.append(F.count_if(mine).alias(f"{t}_rows"))
        sums.append(F.round(size / megabyte, 2).alias(f"{t}_mb"))
    total = F.sum("row_size")
    reason = F.when(total >= C.FLUSH_BYTES, "size").otherwise("age")
    return rows.groupBy(window).agg(
        *sums,
        F.count("*").alias("total_rows"),
        F.round(total / megabyte, 2).alias("total_mb"),
        reason.alias("reason"),
    )


def ingest_totals(flushes: DataFrame) -> DataFrame:
    """Rows, GB, dead letters and dropped rows per record type, and in all (type NULL)."""
    return flushes.rollup("record_type").agg(
        F.sum("n_rows").alias("n_rows"),
        (F.sum("bytes") / 1e9).alias("gb"),
        F.sum("dead_letters").alias("dead_letters"),
        F.sum("dropped").alias("dropped"),
    )


def disconnects_by_reason(lines: DataFrame, column: str = "line") -> DataFrame:
    """Disconnect lines per reason, and all of them (reason NULL)."""
    hits = lines.filter(F.col(column).contains("jetstream disconnected"))
    reason = F.nullif(F.regexp_extract(column, r"jetstream disconnected: (.*)", 1), F.lit(""))
    named = hits.withColumn("reason", F.coalesce(reason, F.lit("(none)")))
    return named.rollup("reason").agg(F.count("*").alias("disconnects"))
