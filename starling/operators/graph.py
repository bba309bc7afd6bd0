"""Follower search by breadth, and comment trees in display order."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import rank_within, top_n
from starling.operators.records import eligible_comment
from starling.session import durable

#: Rounds of pointer doubling: 2^64 ancestors, so only a cycle gets there.
MAX_ROUNDS = 64


def bfs_followers(
    edges: DataFrame, seed: str, target: int | None = None, max_depth: int | None = None
) -> DataFrame:
    """(did, depth, position): accounts by the level at which they are first found.

    `edges`: (account, follower, ordinal), the follower list of each account in order. The
    seed is left out, every id comes once; position counts inside a level in discovery
    order (parent's position, then place in the parent's list). A target stops the search
    once that many are found. Without one it runs until no account is new; a `max_depth` that
    is reached while accounts are still missing is an error, never a silent cut.

    Each level is one join of the frontier with the edges and one anti join with what was
    found before; levels are written to the checkpoint folder, so lineage stays one level
    deep. The driver holds counts only.
    """
    spark = edges.sparkSession
    frontier = spark.range(1).select(
        F.lit(seed).alias("did"), F.lit(0).cast("bigint").alias("depth"), F.lit(1).cast("bigint").alias("position")
    )
    visited = frontier
    missing = target
    for depth in itertools.count(1):
        parents = frontier.select(F.col("did").alias("account"), F.col("position").alias("_parent"))
        reached = edges.filter(F.coalesce("follower", F.lit("")) != "").join(parents, "account")
        first = reached.groupBy(F.col("follower").alias("did")).agg(
            F.min(F.struct("_parent", "ordinal")).alias("_order")
        )
        fresh = first.join(visited.select("did"), "did", "left_anti").select("did", "_order.*")
        if missing is not None:
            fresh = fresh.orderBy("_parent", "ordinal", "did").limit(missing)
        level = rank_within(fresh, [], ["_parent", "ordinal", "did"], "position")
        frontier = durable(level.select("did", F.lit(depth).cast("bigint").alias("depth"), "position"))
        found = frontier.count()
        if found == 0:
            break
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"accounts go on beyond depth {max_depth}")
        visited = visited.unionByName(frontier)
        if missing is not None:
            missing -= found
            if missing <= 0:
                break
    return visited.filter(F.col("depth") > 0)


def bfs_summary(found: DataFrame, target: int) -> DataFrame:
    return found.agg(
        F.count("*").alias("found"),
        F.coalesce(F.max("depth"), F.lit(0).cast("bigint")).alias("max_depth"),
        F.greatest(F.lit(target) - F.count("*"), F.lit(0).cast("bigint")).alias("shortfall"),
    )


def sortable(number: Column) -> Column:
    """Text of fixed width in the order of any bigint: hexadecimal with the sign turned."""
    turned = number.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
    return F.lpad(F.hex(turned), 16, "0")


def comment_tree(comments: DataFrame) -> DataFrame:
    """Add `path` (sorts in depth-first display order inside a submission) and `depth`.

    A path is as long as the comment is deep; `display_order` gives a number instead.

    `comments`: submission_id, comment_id, parent_id (NULL at the top), ordinal among
    siblings. Ancestor pointers double each round, so a thread of depth d takes log2(d)
    joins; rows that reached the top leave the loop.
    """
    keyed = comments.select(
        "submission_id", "comment_id",
        F.col("parent_id").alias("_up"),
        sortable(F.col("ordinal")).alias("path"),
    )
    active = durable(keyed)
    finished = active.filter(F.col("_up").isNull())
    jumps = active
    for _ in range(MAX_ROUNDS):
        pending = active.filter(F.col("_up").isNotNull())
        if pending.isEmpty():
            break
        above = jumps.select(
            "submission_id", F.col("comment_id").alias("_up"),
            F.col("_up").alias("_next"), F.col("path").alias("_prefix"),
        )
        joined = pending.join(above, ["submission_id", "_up"], "left")
        active = durable(
            joined.select(
                "submission_id", "comment_id", F.col("_next").alias("_up"),
                F.concat_ws("/", "_prefix", "path").alias("path"),
            )
        )
        done = active.filter(F.col("_up").isNull())
        jumps = finished.unionByName(active)
        finished = finished.unionByName(done)
    else:
        raise ValueError("comment parents form a cycle")
    paths = finished.select("submission_id", "comment_id", "path")
    return comments.join(paths, ["submission_id", "comment_id"]).withColumn(
        "depth", (F.size(F.split("path", "/")) - 1).cast("bigint")
    )


#: Kinds of places in the walk round a thread: a comment is entered before its replies and left after.
ENTER, LEAVE = 0, 1


def display_order(comments: DataFrame) -> DataFrame:
    """Add `position` (1, 2, … in depth-first display order inside a submission) and `depth`.

    `comments`: submission_id, comment_id (unique there), parent_id (NULL at the top), ordinal
    among siblings (equal ones by comment_id). A comment whose parent is missing stands at the top.

    The walk round all threads of a submission enters and leaves every comment once. Which place
    comes after which is one rank among siblings; the place numbers follow by list ranking: each
    round a place jumps to where its target pointed, so a chain of d places takes log2(2 d) joins.
    A row holds a few numbers and two keys, whatever its depth.
    """
    keys = ["submission_id", "comment_id"]
    there = comments.select("submission_id", F.col("comment_id").alias("parent_id"), F.lit(True).alias("_there"))
    known = comments.select(*keys, "parent_id", "ordinal").join(there, ["submission_id", "parent_id"], "left").select(
        *keys, F.when(F.col("_there"), F.col("parent_id")).alias("parent_id"), "ordinal"
    )
    placed = durable(rank_within(known, ["submission_id", "parent_id"], ["ordinal", "comment_id"], "_rank"))
    after = placed.select(
        "submission_id", F.col("parent_id").alias("_p"), (F.col("_rank") - 1).alias("_r"), F.col("comment_id").alias("_next")
    )
    same = (
        (F.col("a.submission_id") == F.col("b.submission_id"))
        & F.col("a.parent_id").eqNullSafe(F.col("b._p"))
        & (F.col("a._rank") == F.col("b._r"))
    )
    siblings = placed.alias("a").join(after.alias("b"), same, "left").select("a.*", "b._next")
    first = placed.filter(F.col("parent_id").isNotNull() & (F.col("_rank") == 1)).select(
        "submission_id", F.col("parent_id").alias("comment_id"), F.col("comment_id").alias("_child")
    )
    whole = siblings.join(first, keys, "left")
    # Entered: on to the first reply, or out again. Left: on to the next sibling, or out of the parent.
    enter = F.struct(
        F.lit(ENTER).alias("kind"),
        F.coalesce("_child", "comment_id").alias("to"),
        F.when(F.col("_child").isNull(), LEAVE).otherwise(ENTER).alias("to_kind"),
        F.lit(1).cast("bigint").alias("enters"), F.lit(1).cast("bigint").alias("level"),
    )
    leave = F.struct(
        F.lit(LEAVE).alias("kind"),
        F.coalesce("_next", "parent_id").alias("to"),
        F.when(F.col("_next").isNull(), LEAVE).otherwise(ENTER).alias("to_kind"),
        F.lit(0).cast("bigint").alias("enters"), F.lit(-1).cast("bigint").alias("level"),
    )
    # Sums from a place up to where `to` begins: how many comments are entered, how the depth changes.
    active = durable(whole.select(*keys, F.inline(F.array(enter, leave))))
    finished = active.filter(F.col("to").isNull())
    # After k rounds 2^k places are summed up; a walk that goes round in a circle never ends.
    rounds = (2 * placed.count()).bit_length() + 1
    for _ in range(rounds):
        pending = active.filter(F.col("to").isNotNull())
        if pending.isEmpty():
            break
        further = finished.unionByName(pending).select(
            "submission_id", F.col("comment_id").alias("to"), F.col("kind").alias("to_kind"),
            F.col("to").alias("_to"), F.col("to_kind").alias("_kind"),
            F.col("enters").alias("_enters"), F.col("level").alias("_level"),
        )
        active = durable(
            pending.join(further, ["submission_id", "to", "to_kind"]).select(
                *keys, "kind", F.col("_to").alias("to"), F.col("_kind").alias("to_kind"),
                (F.col("enters") + F.col("_enters")).alias("enters"), (F.col("level") + F.col("_level")).alias("level"),
            )
        )
        finished = finished.unionByName(active.filter(F.col("to").isNull()))
    else:
        raise ValueError("comment parents form a cycle")
    entered = finished.filter(F.col("kind") == ENTER)
    sizes = entered.groupBy("submission_id").agg(F.count("*").alias("_n"))
    # What is still to come counts from the end of the submission's walk.
    numbered = entered.join(sizes, "submission_id").select(
        *keys, (F.col("_n") - F.col("enters") + 1).alias("position"), (-F.col("level")).alias("depth")
    )
    return comments.join(numbered, keys)


def comment_rank(comments: DataFrame, min_length: int, max_comments: int | None) -> DataFrame:
    """Eligible comments in display order, ranked per submission among themselves."""
    tree = display_order(comments)
    eligible = tree.filter(
        eligible_comment(F.col("body"), F.col("stickied"), F.col("distinguished"), min_length)
    )
    if max_comments is None:
        return rank_within(eligible, ["submission_id"], ["position"], "comment_rank")
    return top_n(eligible, ["submission_id"], [F.col("position")], max_comments, "comment_rank")
