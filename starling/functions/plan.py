"""Helpers that shape the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: Mapping[str, Column], keep: list[str]) -> DataFrame:
    """`keep` and `columns`, each computed once per row.

    The optimizer copies an aliased expression into every filter and projection above it,
    which multiplies a parser's cost by the number of its uses. Emitting the values from a
    generator puts them in a row of their own; what stands above reads columns.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select(*keep, F.inline(F.array(F.struct(*fields))))


#: Tasks that share a hot key in a salted join, and the rows that make a key hot.
SALTS = 32
HOT = 5_000


def salted_semi_join(
    rows: DataFrame, keys: DataFrame, key: str, by: Sequence[str], salts: int = SALTS, hot: int = HOT
) -> DataFrame:
    """Rows whose `key` is in `keys`; rows of a hot key are dealt over `salts` tasks by a hash of `by`.

    `rows` are read twice, so a table is best. Only keys with over `hot` rows, of which there are few,
    are repeated among `keys`. Both sides are shuffled: the planner takes the size of `keys` from their
    compressed files and would pass them all through the driver. Whatever groups by `key` above needs
    an exchange of its own, before which Spark adds up by task.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot)
    heavy = F.broadcast(counted.select(key, F.lit(salts).cast("bigint").alias("_salts")))
    share = F.coalesce(F.col("_salts"), F.lit(1).cast("bigint"))
    dealt = rows.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), share))
    numbers = F.sequence(F.lit(0).cast("bigint"), share - 1)
    repeated = keys.select(key).distinct().join(heavy, key, "left").select(key, F.explode(numbers).alias("_salt"))
    return dealt.join(repeated.hint("merge"), [key, "_salt"], "left_semi").select(*rows.columns)
