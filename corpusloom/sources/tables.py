"""Named datasets, row slices and inline prompt lists."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.positions import key_cut

PROMPT_SCHEMA = T.StructType(
    [T.StructField("prompt_id", T.LongType(), False), T.StructField("prompt", T.StringType(), False)]
)


def load_table(
    spark: SparkSession,
    root: str,
    name: str,
    columns: list[str] | None = None,
    split: str | None = None,
    split_column: str = "split",
) -> DataFrame:
    """Read dataset ``name`` below ``root``, all splits or one.

    The scan keeps the layout of the files; ``spark.sql.files.maxPartitionBytes``
    sets how finely they are read.
    """
    df = spark.read.parquet(os.path.join(root, f"{name}.parquet"))
    if split is not None:
        df = df.where(F.col(split_column) == split)
    if columns is not None:
        df = df.select(*columns)
    return df


def head_slice(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order."""
    return row_slice(df, order_by, 0, n)


def row_slice(df: DataFrame, order_by: list[str], start: int, count: int = 1) -> DataFrame:
    """Rows ``start`` to ``start + count - 1`` in key order; ``order_by`` identifies a row.

    Two cuts are found from the keys alone; only the rows of the slice are sorted.
    """
    if start < 0 or count < 0:
        raise ValueError("start and count must not be negative")
    rows = df.where(key_cut(df, order_by, start + count).before())
    if start:
        rows = rows.where(~key_cut(df, order_by, start).before())
    return rows.orderBy(*order_by)


def prompts_from_list(spark: SparkSession, prompts: list[str]) -> DataFrame:
    """An inline list of prompts as a table with the schema of a prompt source."""
    return spark.createDataFrame(list(enumerate(prompts)), PROMPT_SCHEMA)


def prompts_from_table(df: DataFrame, prompt_id: Column | str, prompt: Column | str) -> DataFrame:
    """A prompt table from any two columns."""
    prompt_id = F.col(prompt_id) if isinstance(prompt_id, str) else prompt_id
    prompt = F.col(prompt) if isinstance(prompt, str) else prompt
    return df.select(prompt_id.cast("long").alias("prompt_id"), prompt.alias("prompt"))
