"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.ranking import top_n
from starling.session import shared_dir
from starling.sources.tables import remove_path

#: The white space between words (space and the six ASCII controls from tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows up to which a small side is sent to every executor (some MB); counted before each use.
BROADCAST_ROWS = 200_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the folder that all executors share and go on from the written table.

    A lost executor then costs no more than the tasks it ran, and a step that must agree with an
    earlier one reads the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/starling-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the table behind `df`, made by `saved`, once nothing reads it any more."""
    files = df.inputFiles()
    if files:
        remove_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def with_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows; counted, not guessed.

    Beyond that the join is left to Spark's shuffle, which gives the same rows.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: str | Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; sizes partitions, bundles and sketches."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("bigint"))).first()[0]
    return int(total or 0)


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`df` with `columns` added; a column of the same name in `df` is replaced."""
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in columns],
        *[column.alias(name) for name, column in columns.items()],
    )


def shifted(array: str | Column, by: int) -> Column:
    """The array without its first `by` elements."""
    array = F.col(array) if isinstance(array, str) else array
    return F.slice(array, F.lit(by + 1), F.greatest(F.size(array) - by, F.lit(0)))


def head(array: str | Column, drop: int) -> Column:
    """The array without its last `drop` elements."""
    array = F.col(array) if isinstance(array, str) else array
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - drop, F.lit(0)))


def names(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def smallest_hashes(ids: DataFrame, group: str, rows: Column, most: int) -> DataFrame:
    """(doc_id, group, _rank): of each group the rows of smallest id hash, at most `rows` (<= `most`).

    A share of the hash range that holds about twice the rows wanted is cut out first, so that
    a large group does not go through one task. With few rows it is the whole range.
    """
    hashed = ids.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    sizes = hashed.groupBy(group).agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), (2.0 * rows + 100.0) / F.col("_n"))
    near = hashed.join(with_broadcast(sizes), group).filter(F.col("_h") <= share * float(1 << 40))
    ranked = top_n(near.drop("_n"), [group], [F.col("_h"), F.col("doc_id")], most, "_rank")
    return ranked.filter(F.col("_rank") <= rows).drop("_h")


def give_back() -> None:
    """Memory that this process has freed goes back to the system; an idle Python worker keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def tidy(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`run` for groups, giving back what a group has freed before the next one comes."""

    def one(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return one


def tidy_pair(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """As `tidy`, for pairs of groups."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out

    return both
