"""Reads of collection runs: stage folders with one run_dir partition per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.sources.tables import path_exists


def load_stage(
    spark: SparkSession, root: str, schema: str, fmt: str = "parquet", blanks_as_null: bool = False
) -> DataFrame:
    """All runs under root/run_dir=…, with `run_dir`; no runs is an error.

    CSV keeps empty strings as '' unless `blanks_as_null`.
    """
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no runs under {root}")
    typed = f"{schema}, run_dir string"
    if fmt == "parquet":
        return spark.read.schema(typed).parquet(root)
    reader = spark.read.schema(typed).option("header", True).option("multiLine", True).option("escape", '"')
    if blanks_as_null:
        return reader.csv(root)
    strings = reader.option("nullValue", "\u0000").option("emptyValue", "").csv(root)
    return strings


def latest_run(df: DataFrame) -> DataFrame:
    """Rows of the newest run; run names sort as time does."""
    newest = df.agg(F.max("run_dir")).scalar()
    return df.filter(F.col("run_dir") == newest)


def read_ids(spark: SparkSession, pattern: str) -> DataFrame:
    """Headerless one-column id files of a glob."""
    return spark.read.text(pattern).toDF("uri").filter(F.col("uri") != "")
