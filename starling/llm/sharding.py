"""Sharding: minimax contiguous partition of atomic groups (equal texts), law `bytes`.

Groups are ordered by their first doc_id. The smallest capacity for which greedy filling needs no
more than the given shards is found by binary search over prefix sums, and the cuts are made
there. The prefix sums stay a distributed table. The driver holds a summary of it: per bin of the
prefix axis the number of group ends and the first and last of them. A greedy step is certain
where a bin settles it; bins that leave the answer open are split further, one job a round, until
the search ends. Only DataFrame functions touch rows.

Defined results: a null text has no bytes (size 8, crc of nothing) and all null texts are one
group; an empty text is another. Rows that repeat a doc_id are rows of their own. A null doc_id
sorts first. An empty table gives no rows. A group larger than the ideal shard stays whole.
Columns of the input other than doc_id and the text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import rank_within, running_total
from starling.llm.common import saved
from starling.llm.registry import query

SHARDS = 24
#: Bins of the prefix axis that the driver holds after each round.
BINS = 1 << 14


@dataclass
class PrefixSummary:
    """What the driver knows of the sorted group ends: disjoint bins with count, first and last."""

    total: int
    refine: Callable[[list[tuple[int, int]], int], list[tuple[int, int, int, int, int]]]
    starts: list[int] = field(default_factory=list)
    bins: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # start, end, n, first, last

    def load(self, ranges: list[tuple[int, int]], width: int) -> None:
        """Replace what lies in `ranges` by bins of `width`."""
        found = self.refine(ranges, width)
        gone = set(ranges)
        self.bins = sorted([b for b in self.bins if (b[0], b[1]) not in gone] + found)
        self.starts = [b[0] for b in self.bins]

    def before(self, x: int) -> tuple[int, int, tuple | None]:
        """Bounds of the last group end <= x, and the bin that leaves it open, if any."""
        if x >= self.total:
            return self.total, self.total, None
        at = bisect_right(self.starts, x) - 1
        if at < 0:
            return 0, 0, None
        start, end, n, first, last = self.bins[at]
        if last <= x:
            return last, last, None
        if first > x:
            low = self.bins[at - 1][4] if at else 0
            return low, low, None
        return first, (first if n == 2 else x), (None if n == 2 else self.bins[at])

    def chain(self, capacity: int, shards: int, hopeful: bool) -> tuple[list[int], list[tuple]]:
        """Greedy cuts by the upper (hopeful) or lower bounds, and the open bins met."""
        position, cuts, doubts = 0, [], []
        for _ in range(shards):
            low, high, doubt = self.before(position + capacity)
            position = high if hopeful else low
            cuts.append(position)
            if doubt:
                doubts.append(doubt)
        return cuts, doubts

    def smallest(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.chain(middle, shards, hopeful)[0][-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(summary: PrefixSummary, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the ends of the shards."""
    total = summary.total
    low = max(largest, -(-total // shards))
    high = low + largest
    whole = 1 << total.bit_length()
    summary.load([(0, whole)], max(1, whole // BINS))
    while True:
        certain = summary.smallest(low, high, shards, hopeful=False)
        possible = summary.smallest(low, certain, shards, hopeful=True)
        if certain == possible:
            break
        low, high = possible, certain
        # Every bin that a cut of some capacity in between can meet.
        first, last = summary.chain(possible, shards, False)[0], summary.chain(certain, shards, True)[0]
        position = [0, *last]
        open_bins = [
            b
            for b in summary.bins
            if b[2] > 2
            and any(b[0] <= position[j] + certain and b[1] > first[j] for j in range(shards))
        ]
        width = max(1, sum(b[1] - b[0] for b in open_bins) // BINS)
        smallest_open = min(b[1] - b[0] for b in open_bins)
        width = min(1 << (width - 1).bit_length(), smallest_open // 2)
        summary.load([(b[0], b[1]) for b in open_bins], max(1, width))
    greedy = summary.chain(certain, shards, hopeful=False)[0]
    # The least end of each shard from which the rest still fits, from the back.
    ends = sorted({e for b in summary.bins for e in (b[3], b[4])} | {0, total})
    needed, back = total, []
    for _ in range(shards):
        back.append(needed)
        at = bisect_right(ends, needed - certain - 1)
        needed = ends[at] if needed > certain else 0
    back.reverse()
    # Cut there, nearest below an even share of what is left, inside these bounds.
    position, cuts = 0, []
    for j in range(shards):
        even = summary.before(position + -(-(total - position) // (shards - j)))[0]
        ceiling = summary.before(position + certain)[0]
        position = min(max(even, min(back[j], greedy[j])), ceiling)
        cuts.append(position)
    return certain, cuts


def assign_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(content).cast("bigint") + 8).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(F.col(f"`{text}`").cast("binary"), 256), F.lit("null")).alias("_key"),
    )
    groups = rows.groupBy("_key").agg(
        F.min("doc_id").alias("_first"), F.sum("size").alias("_bytes")
    )
    groups = saved(
        running_total(groups, [], ["_first", "_key"], F.col("_bytes"), "_end"), "shard-groups"
    )
    spark = docs.sparkSession
    total, largest = groups.agg(F.max("_end"), F.max("_bytes")).first()

    def refine(ranges, width):
        """One job: the bins of `width` inside the given bins. Widths are powers of two."""
        found = None
        for parent in sorted({end - start for start, end in ranges}):
            known = [(start // parent,) for start, end in ranges if end - start == parent]
            inside = groups.select("_end", F.floor(F.col("_end") / F.lit(parent)).alias("_in"))
            # At most BINS rows.
            inside = inside.join(F.broadcast(spark.createDataFrame(known, "_in long")), "_in")
            found = inside if found is None else found.unionByName(inside)
        bins = found.groupBy(F.floor(F.col("_end") / F.lit(width)).alias("_bin")).agg(
            F.count_distinct("_end").alias("n"), F.min("_end").alias("a"), F.max("_end").alias("b")
        )
        return [(r["_bin"] * width, (r["_bin"] + 1) * width, r["n"], r["a"], r["b"]) for r in bins.collect()]

    cuts = minimax_cuts(PrefixSummary(total, refine), largest, shards)[1] if total else []
    # A group lies behind as many cuts as its own start has passed.
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("_end") - F.col("_bytes") >= F.lit(cut)).cast("int")
    placed = rows.join(
        groups.select("_key", F.col("_end").alias("_order"), shard.cast("int").alias("shard")), "_key"
    )
    ranked = rank_within(placed, ["shard"], ["_order", "doc_id", "_key"], "slot")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the rows of `docs` under one folder per shard."""
    placed = assign_shards(docs, shards).select("doc_id", "text_crc32", "shard").distinct()
    keyed = docs.withColumn("_crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    on = keyed["doc_id"].eqNullSafe(placed["doc_id"]) & (keyed["_crc"] == placed["text_crc32"])
    joined = keyed.join(placed, on).select(*[keyed[c] for c in docs.columns if c != "shard"], "shard")
    joined.write.partitionBy("shard").parquet(path)


@query("op8_sharding")
def op8_sharding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign_shards(docs)
