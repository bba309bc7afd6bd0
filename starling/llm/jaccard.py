"""N-gram Jaccard join in metric space.

Documents are sets of word n-grams; 1 - Jaccard is a metric. Unrelated texts all lie at distance
~1 from any pivot, so pivots are only worth having where texts are close:

1. Equal sets are one class (distance 0); only its first document goes on.
2. Anchors find pivots. The universe of n-grams is cut by hash into parts, so many that two sets
   within the threshold differ in fewer parts than either fills (each differing n-gram spoils one
   part). The projections on the parts, in an order of their own, obey the prefix principle: the
   first `differing parts + 1` anchors of two linked sets have one in common. The class of smallest
   id at an anchor is the pivot of all classes there; they are its Voronoi region. Anchors are
   compared by `starling.llm.exchange`, so a frequent one is never a hot key. Sets near a size
   border, where the number of parts doubles, are replicated over the border by the window
   that the threshold allows.
3. A region too large for a task is split again: pivots are drawn from it, every member goes to
   its nearest pivot and, by the triangle inequality, to each pivot whose distance is larger by
   at most twice the threshold distance. A region that does not fall apart (all members are near
   each other) is joined in pairs of blocks.
4. In a task the members of a region are sorted by size; only pairs whose sizes and whose distances
   to the pivot differ by no more than the threshold are counted, exactly, on integers.
   A pair that meets in several regions is counted in the first of them.

Links are counted per class, never listed: a task emits its members' counts and a star per
connected group. The stars are joined to components by `starling.llm.components`.

Defined results: a null or wordless text has an empty set, no links, and is its own component. A
text shorter than n words is one n-gram. Rows that share a doc_id are one document holding each of
its sets. A row without doc_id takes part in classes but never names one. Very long
texts are sets like others. 64-bit hashes stand for n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.keep import keep_first
from starling.functions.ranking import top_n
from starling.llm.common import discard, give_back, saved, tidy, tidy_pair, with_broadcast
from starling.llm.components import components
from starling.llm.exchange import (
    ASK,
    SLICE_ENTRIES,
    answer,
    ask_table,
    cut,
    pack,
    pack_counts,
    replies_of,
    unpack_counts,
)
from starling.llm.registry import query
from starling.llm.words import (
    LOWER,
    NOT_SPACE,
    U64,
    gram_hashes,
    hash_spans,
    lists,
    mix,
    pieces,
    run_starts,
    signed,
    spans,
)

#: Sets below this size use their n-grams as anchors, larger ones the projections on parts.
SMALL = 64
#: Members and n-grams of a region that one task joins.
REGION_MEMBERS = 2000
REGION_GRAMS = 1_000_000
PIVOTS = 16
#: Anchors of a bundle of classes, on average.
BUNDLE_ANCHORS = 500_000


class Threshold:
    """Jaccard >= num / den, and the bounds that follow from it in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        # Sets of mean part size 2 to 4 fill enough parts above 0.9, of 1 to 2 above 0.75.
        self.spread = 4 if 10 * num >= 9 * den else 2 if 4 * num >= 3 * den else 1

    def differing(self, size: np.ndarray) -> np.ndarray:
        """The most n-grams in which a set of this size and a linked one can differ."""
        other = size * self.den // self.num
        return (size + other) * (self.den - self.num) // (self.den + self.num)

    def linked(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)


def sets_of(piece, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct n-gram hashes of each text."""
    data = LOWER[piece.data]
    starts, ends, bounds = spans(piece, NOT_SPACE)
    words = hash_spans(data, starts, ends)
    counts = np.diff(bounds)
    grams = gram_hashes(words, n)
    valid = run_starts(bounds, n)[: len(grams)]
    text = np.repeat(np.arange(len(piece)), counts)[: len(grams)][valid]
    grams = grams[valid]
    for few in range(1, n):  # the whole text of fewer words is one n-gram
        short = np.flatnonzero(counts == few)
        if len(short):
            own = gram_hashes(words, few, seed=1)[bounds[short]]
            grams, text = np.concatenate([grams, own]), np.concatenate([text, short])
    if len(text) and np.any(np.diff(text) < 0):
        order = np.argsort(text, kind="stable")
        grams, text = grams[order], text[order]
    edges = np.searchsorted(text, np.arange(len(piece) + 1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.searchsorted(text[new], np.arange(len(piece) + 1))


def _anchors_of(hashes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The anchors of one sorted set."""
    size = len(hashes)
    allowed = int(threshold.differing(np.int64(size)))
    if allowed == 0:
        return np.zeros(0, U64)  # nothing but an equal set is near enough
    out = []
    if size < SMALL:
        out.append(np.sort(mix(hashes ^ U64(0x5A5A)))[: allowed + 1])
    # Its own band of sizes, and the next one if a linked set can lie there.
    band = max(size.bit_length() - 1, SMALL.bit_length() - 2)
    for level in (band, band + 1):
        if (level == band and size < SMALL) or (
            level > band and threshold.den * size < threshold.num * (1 << level)
        ):
            continue
        bits = level + 1 - (threshold.spread.bit_length() - 1)
        part = hashes >> U64(64 - bits)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        filled = np.diff(np.concatenate([first, [size]]))
        with np.errstate(over="ignore"):
            total = np.add.reduceat(mix(hashes ^ U64(0xA5A5)), first)
            keys = mix(total + part[first] * U64(0x9E3779B97F4A7C15) + U64(level))
        order = np.lexsort((keys, -filled))[: allowed + 1]
        out.append(keys[order])
    return np.concatenate(out) if out else np.zeros(0, U64)


def profiles(docs: DataFrame, n: int, threshold: Threshold) -> DataFrame:
    """(doc_id, n_shingles, sig_a, sig_b, anchors) per row; equal sets have equal signatures."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for piece in pieces(batch.column(1)):
                hashes, bounds = sets_of(piece, n)
                sizes = np.diff(bounds)
                with np.errstate(over="ignore"):
                    sums = [
                        np.concatenate([[U64(0)], np.cumsum(mix(hashes ^ U64(k)), dtype=U64)]) for k in (11, 12)
                    ]
                    sigs = [signed(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]
                anchors = [
                    _anchors_of(hashes[a:b], threshold) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                edges = np.concatenate([[0], np.cumsum([len(x) for x in anchors])])
                flat = np.concatenate([*anchors, np.zeros(0, U64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(piece.first, len(piece)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(sigs[0]),
                        pa.array(sigs[1]),
                        lists(signed(flat), edges),
                    ],
                    ["doc_id", "n_shingles", "sig_a", "sig_b", "anchors"],
                )
        give_back()

    schema = f"doc_id {kind}, n_shingles long, sig_a long, sig_b long, anchors array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(rep, grams): the set of each row as an array of hashes."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column(1)):
                hashes, bounds = sets_of(piece, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), lists(signed(hashes), bounds)],
                    ["rep", "grams"],
                )
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, f"rep {kind}, grams array<long>")


def _flat_anchors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, the rep of each) of a bundle, sorted by anchor."""
    arrays = _arrays(table.column("anchors"))
    reps = np.repeat(table.column("rep").to_numpy(), [len(a) for a in arrays])
    anchors = np.concatenate([*arrays, np.zeros(0, np.int64)]).view(U64)
    order = np.argsort(anchors)
    return anchors[order], reps[order].astype(np.int64)


def _firsts(keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _pivots(asked: list[np.ndarray], numbers: list[np.ndarray]) -> list[bytes]:
    """For each anchor asked: 0, or 1 and the smallest rep of all that have it if there are several."""
    keys = np.concatenate(asked)
    halves = [np.split(n, 2) for n in numbers]
    least = np.concatenate([h[0] for h in halves]).view(np.int64)
    many = np.concatenate([h[1] for h in halves]).astype(bool)
    order = np.argsort(keys)
    at = _firsts(keys[order])
    group = np.empty(len(keys), np.int64)
    group[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys))))
    pivot = np.minimum.reduceat(least[order], at)[group]
    shared = (np.logical_or.reduceat(many[order], at) | (np.diff(np.append(at, len(keys))) > 1))[group]
    out, edges = [], np.concatenate([[0], np.cumsum([len(k) for k in asked])])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = shared[a:b]
        out.append(pack_counts(np.concatenate([own.astype(U64), pivot[a:b][own].view(U64)])))
    return out


def pivot_regions(classes: DataFrame) -> DataFrame:
    """(pivot, rep): every class (rep, anchors) with the pivots of its shared anchors.

    Bundles of classes ask the slices of the anchor space; an anchor that a third of all classes
    share is one entry per bundle.
    """
    total = classes.agg(F.sum(F.size("anchors"))).first()[0] or 0
    bundles, slices = max(1, -(-total // BUNDLE_ANCHORS)), max(1, -(-total // SLICE_ENTRIES))
    kind = dict(classes.dtypes)["rep"]
    rows = classes.filter(F.size("anchors") > 0).select(
        F.pmod(F.xxhash64("rep"), F.lit(bundles)).cast("int").alias("bundle"), "rep", "anchors"
    )

    def ask(table: pa.Table) -> pa.Table:
        anchors, reps = _flat_anchors(table)
        at = _firsts(anchors)
        least, most = np.minimum.reduceat(reps, at), np.maximum.reduceat(reps, at)
        out = ([], [], [], [])
        keys, edges = anchors[at], cut(anchors[at], slices, 64)
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                numbers = np.concatenate([least[a:b].view(U64), (least[a:b] != most[a:b]).astype(U64)])
                for column, value in zip(
                    out, (k, table.column("bundle")[0].as_py(), pack(keys[a:b]), pack_counts(numbers)), strict=True
                ):
                    column.append(value)
        return ask_table(out)

    def place(own: pa.Table, answers: pa.Table) -> pa.Table:
        anchors, reps = _flat_anchors(own)
        at = _firsts(anchors)
        shared, pivot = np.zeros(len(at), bool), np.zeros(len(at), np.int64)
        edges = cut(anchors[at], slices, 64)
        for k, _, reply in replies_of(answers):
            numbers = unpack_counts(reply)
            size = int(edges[k + 1] - edges[k])
            mine = numbers[:size].astype(bool)
            shared[edges[k] : edges[k + 1]] = mine
            pivot[edges[k] : edges[k + 1]][mine] = numbers[size:].view(np.int64)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(anchors))))
        pairs = np.unique(np.stack([pivot[group], reps], axis=1)[shared[group]], axis=0)
        return pa.table({"pivot": pa.array(pairs[:, 0]).cast(types[kind]), "rep": pa.array(pairs[:, 1]).cast(types[kind])})

    types = {"bigint": pa.int64(), "int": pa.int32()}
    answers = answer(rows.groupBy("bundle").applyInArrow(tidy(ask), ASK), _pivots)
    return (
        rows.groupBy("bundle")
        .cogroup(answers.groupBy("bundle"))
        .applyInArrow(tidy_pair(place), f"pivot {kind}, rep {kind}")
    )


class Members:
    """Sets of one group laid flat, with small ids for their n-grams."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.edges = np.concatenate([[0], np.cumsum(self.sizes)])
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        kinds, self.ids = np.unique(flat, return_inverse=True)
        self.mark = np.zeros(len(kinds) + 1, np.int32)

    def common(self, i: int, low: int, high: int) -> np.ndarray:
        """The sizes of the intersections of set i with the sets low to high."""
        own = self.ids[self.edges[i] : self.edges[i + 1]]
        self.mark[own] = 1
        hits = self.mark[self.ids[self.edges[low] : self.edges[high]]]
        found = np.add.reduceat(hits, self.edges[low:high] - self.edges[low])
        self.mark[own] = 0
        return found


def _union(parent: np.ndarray, a: int, others: np.ndarray) -> None:
    """Join `a` and `others`; parents point to smaller places."""

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x in others:
        p, q = root(a), root(int(x))
        if p != q:
            parent[max(p, q)] = min(p, q)


def join_group(rows, threshold: Threshold):
    """Join one group: rows of (rep, grams, regions, half), the pivot's distance as a window.

    Yields (rep, links, star): the number of other classes' documents linked to it here,
    and the rep its connected group is named by. `half` is 0, or 1 and 2 where two blocks are
    joined with each other only. Copies of a class count as often as it has documents.
    """
    region, reps, sets, copies, regions, half = rows
    order = np.argsort([len(s) for s in sets], kind="stable")
    members = Members([sets[i] for i in order])
    reps, copies, half = reps[order], copies[order], half[order]
    owners: dict[tuple, int] = {}
    owner = np.array([owners.setdefault(tuple(regions[i]), len(owners)) for i in order])
    seen = sorted(owners, key=owners.get)
    sizes, n = members.sizes, len(members.sizes)
    mine: dict[tuple[int, int], bool] = {}

    def counts_here(a: int, b: int) -> bool:
        key = (min(a, b), max(a, b))
        if key not in mine:
            mine[key] = min(set(seen[a]) & set(seen[b])) == region
        return mine[key]

    # Distances to the pivot (the member of smallest id) bound all others from below.
    at = int(np.argmin(reps))
    near = members.common(at, 0, n)
    whole = sizes + sizes[at] - near
    distance = 1 - near / np.maximum(whole, 1)
    reach = (threshold.den - threshold.num) / threshold.den + 1e-9
    parent, links = np.arange(n), np.zeros(n, np.int64)
    last = np.searchsorted(sizes, sizes * threshold.den // threshold.num, side="right")
    for i in range(n):
        high = int(last[i])
        if high <= i + 1:
            continue
        window = np.abs(distance[i + 1 : high] - distance[i]) <= reach
        window &= (half[i + 1 : high] != half[i]) | (half[i] == 0)
        window &= reps[i + 1 : high] != reps[i]
        if not window.any():
            continue
        found = members.common(i, i + 1, high)
        good = window & threshold.linked(found, sizes[i], sizes[i + 1 : high])
        others = np.flatnonzero(good) + i + 1
        if not len(others):
            continue
        _union(parent, i, others)
        own = {int(o) for o in np.unique(owner[others]) if counts_here(int(owner[i]), int(o))}
        counted = others[np.isin(owner[others], list(own))] if own else others[:0]
        links[i] += copies[counted].sum()
        links[counted] += copies[i]
    for i in range(n):
        parent[i] = parent[parent[i]]
    name = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(name, parent, reps)
    return reps, links, name[parent]


def _groups(batches, columns):
    """The rows of each (region, block) of a sorted partition, across batches."""
    held, key = [], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            this = tuple(keys[a])
            if key is not None and this != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = this
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _arrays(column) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        values, edges = chunk.flatten().to_numpy(), chunk.offsets.to_numpy()
        edges = edges - edges[0]
        out += [values[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def _split(large: DataFrame, sets: DataFrame, level: int, reach: float) -> DataFrame:
    """Voronoi regions inside each large region: (region, rep, copies, weight) of the sub-regions.

    Members go in chunks; every chunk meets the region's pivots (at most PIVOTS sets).
    """
    chosen = top_n(
        large.select("region", "rep", F.xxhash64("rep", F.lit(level)).alias("_h")),
        ["region"],
        [F.col("_h"), F.col("rep")],
        PIVOTS,
        "_rank",
    )
    sizes = large.groupBy("region").agg(F.sum("weight").alias("_all"))
    chunks = F.ceil(F.col("_all") / REGION_GRAMS).cast("int")
    members = (
        large.join(sizes, "region")
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int"))
        .drop("_all")
        .join(sets, "rep")
    )
    pivots = (
        chosen.join(sizes, "region")
        .select("region", "rep", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
        .join(sets, "rep")
        .groupBy("region", "chunk", "rep")
        .agg(F.first("grams").alias("grams"))
    )
    pivots = saved(pivots, f"pivots-{level}")
    kind = dict(large.dtypes)["rep"]

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            ids = right.column("rep").to_numpy()
            both = Members(_arrays(right.column("grams")) + _arrays(left.column("grams")))
            k, n = right.num_rows, left.num_rows
            distance = np.empty((k, n))
            for p in range(k):
                near = both.common(p, k, k + n)
                distance[p] = 1 - near / np.maximum(both.sizes[k:] + both.sizes[p] - near, 1)
            pivot, member = np.nonzero(distance <= distance.min(axis=0) + 2 * reach + 1e-9)
            region = left.column("region").to_numpy()[member]
            with np.errstate(over="ignore"):
                sub = signed(mix(region.view(U64) ^ mix(ids[pivot].view(U64) + U64(level + 1))))
            out = [sub, *(left.column(c).to_numpy()[member] for c in ("rep", "copies", "weight"))]
        return pa.table(
            {c: pa.array(v, left.schema.field("rep").type if c == "rep" else pa.int64()) for c, v in zip(("region", "rep", "copies", "weight"), out, strict=True)}
        )

    return (
        members.groupBy("region", "chunk")
        .cogroup(pivots.groupBy("region", "chunk"))
        .applyInArrow(tidy_pair(assign), f"region long, rep {kind}, copies long, weight long")
        .dropDuplicates(["region", "rep"])
    )


def _measure(members: DataFrame) -> DataFrame:
    whole = members.groupBy("region").agg(F.sum("weight").alias("grams"), F.count("*").alias("members"))
    return whole.withColumn(
        "blocks",
        F.greatest(
            F.ceil(F.col("grams") / REGION_GRAMS), F.ceil(F.col("members") / REGION_MEMBERS)
        ).cast("int"),
    )


def leaf_regions(members: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """(region, rep, copies, weight, blocks): regions that fit a task, or that do not fall apart."""
    reach = (threshold.den - threshold.num) / threshold.den
    leaves, level = [], 0
    while True:
        measured = saved(
            members.join(_measure(members), "region").filter("members > 1"), f"regions-{level}"
        )
        large = measured.filter("blocks > 1")
        leaves.append(measured.filter("blocks = 1").select("region", "rep", "copies", "weight", "blocks"))
        if large.isEmpty():
            break
        parents = large.select("region").distinct().count()
        before = large.agg(F.sum("weight")).first()[0]
        split = saved(_split(large.select("region", "rep", "copies", "weight"), sets, level, reach), f"split-{level}")
        after = split.agg(F.sum("weight")).first()[0]
        largest = _measure(split).agg(F.max("grams")).first()[0]
        if after > 3 * before or largest > 0.9 * before / parents:
            # The members are too near each other to be told apart: pairs of blocks instead.
            leaves.append(large.select("region", "rep", "copies", "weight", "blocks"))
            break
        members, level = split, level + 1
    out = leaves[0]
    for leaf in leaves[1:]:
        out = out.unionByName(leaf)
    return out


def jaccard_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every row of `docs` (doc_id, text).

    Two documents link when their sets have Jaccard >= num / den. n_links counts the other
    documents linked to it, copies included.
    """
    threshold = Threshold(num, den)
    profiled = saved(profiles(docs, n, threshold), "jaccard-profiles")
    rows = saved(profiled.drop("anchors"), "jaccard-rows")
    anchored = saved(
        profiled.filter("n_shingles > 0").groupBy("n_shingles", "sig_a", "sig_b").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("anchors").alias("anchors")
        ),
        "jaccard-anchored",
    )
    classes = saved(anchored.drop("anchors"), "jaccard-classes")
    named = classes.filter("rep IS NOT NULL")
    placed = pivot_regions(anchored.filter("rep IS NOT NULL")).select(F.xxhash64("pivot").alias("region"), "rep").distinct()
    sizes = named.groupBy("rep").agg(F.max("copies").alias("copies"), F.max("n_shingles").alias("weight"))
    members = saved(placed.join(sizes, "rep"), "jaccard-members")
    discard(profiled)
    discard(anchored)
    wanted = with_broadcast(saved(members.select(F.col("rep").alias("_rep")).distinct(), "jaccard-wanted"))
    near = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_rep"), "left_semi")
    sets = saved(_sets(near, n), "jaccard-sets")
    leaves = saved(leaf_regions(members, sets, threshold), "jaccard-leaves")

    # Each member knows its regions, so that a pair is counted in one of them only.
    listed = leaves.groupBy("rep").agg(F.sort_array(F.collect_set("region")).alias("regions"))
    own = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    blocked = leaves.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    blocked = blocked.select(
        "region",
        (low.cast("long") * F.col("blocks") + high).alias("block"),
        F.when(low == high, 0).when(F.col("_own") == low, 1).otherwise(2).alias("half"),
        "rep",
        "copies",
    )
    blocked = saved(blocked.join(listed, "rep"), "jaccard-blocks")
    ready = sets.join(with_broadcast(blocked), "rep")
    tasks = max(8, int(ready.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = dict(docs.dtypes)["doc_id"]
    columns = ["region", "block", "half", "rep", "copies", "regions", "grams"]

    def join(batches):
        for key, table in _groups(batches, columns):
            reps, links, star = join_group(
                (
                    key[0],
                    table.column("rep").to_numpy(),
                    _arrays(table.column("grams")),
                    table.column("copies").to_numpy(),
                    _arrays(table.column("regions")),
                    table.column("half").to_numpy(),
                ),
                threshold,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps, table.schema.field("rep").type), pa.array(links), pa.array(star, table.schema.field("rep").type)],
                ["rep", "links", "star"],
            )
        give_back()

    joined = saved(
        ready.select(*columns)
        .repartition(tasks, "region", "block")
        .sortWithinPartitions("region", "block", "rep")
        .mapInArrow(join, f"rep {kind}, links long, star {kind}"),
        "jaccard-joined",
    )
    named_by = components(joined.filter("star < rep").select(F.col("star").alias("a"), F.col("rep").alias("b")))
    links = joined.groupBy("rep").agg(F.sum("links").alias("links"))
    facts = (
        classes.join(named_by.withColumnRenamed("node", "rep"), "rep", "left")
        .join(links, "rep", "left")
        .select(
            "n_shingles",
            "sig_a",
            "sig_b",
            F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
        )
    )
    facts = saved(facts, "jaccard-facts")
    return rows.join(facts, ["n_shingles", "sig_a", "sig_b"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_per_group(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of `docs` that name their component; of rows that repeat its doc_id, the smallest.

    Rows without a doc_id cannot be named and stay.
    """
    groups = jaccard_join(docs.select("doc_id", "text"), n, num, den)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    twice = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_twice")).count().filter("count > 1")
    twice = saved(twice.select("_twice"), "repeated-ids")
    if twice.isEmpty():
        return kept
    same = F.col("doc_id") == F.col("_twice")
    order = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    return kept.join(twice, same, "left_anti").unionByName(
        keep_first(kept.join(twice, same, "left_semi"), ["doc_id"], order)
    )


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_join(docs, n=3, num=90, den=100).select("doc_id", "n_shingles", "component_id", "n_links")
