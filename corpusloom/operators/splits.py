"""Splits, batches and samples that do not depend on the partitioning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.chat import render
from corpusloom.operators.positions import (
    Cut,
    before_hash_cut,
    hash_cut,
    key_cut,
    repeatable_hash,
    running_total,
    whole_div,
)


def ordered_cut(df: DataFrame, order_by: list[str], fraction: float = 0.9) -> Cut:
    """The key at position floor(fraction * n): rows before it are the first part."""
    return key_cut(df, order_by, math.floor(fraction * df.count()))


def ordered_split(df: DataFrame, order_by: list[str], fraction: float = 0.9) -> DataFrame:
    """Add ``split``: the first floor(fraction * n) rows are "train", the rest "test".

    The key at the cut is found from counts; the rows get a row-local comparison
    with it.
    """
    cut = ordered_cut(df, order_by, fraction)
    return df.withColumn("split", F.when(cut.before(), "train").otherwise("test"))


def check_fraction(fraction: float) -> None:
    if not 0.0 < fraction < 1.0:
        raise ValueError("the test fraction must lie between 0 and 1, both excluded")


def random_split(
    df: DataFrame, key: list[str], test_fraction: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add ``split``: exactly ceil(test_fraction * n) rows, by hash of the key, are "test"."""
    check_fraction(test_fraction)
    n = df.count()
    cut = hash_cut(df, key, seed, math.ceil(test_fraction * n))
    return df.withColumn(
        "split", F.when(before_hash_cut(cut, key, seed), "test").otherwise("train")
    )


def train_eval(
    df: DataFrame, key: list[str], need_eval: bool = True, test_fraction: float = 0.1, seed: int = 42
) -> tuple[DataFrame, DataFrame | None]:
    """The two parts of a random split; everything and None if evaluation is off."""
    if not need_eval:
        return df, None
    marked = random_split(df, key, test_fraction, seed)
    train, test = (marked.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    return train, test


def seq_batches(keys: DataFrame, order_by: list[str], batch_size: int) -> DataFrame:
    """Add ``row_index``, ``batch_id`` and ``row_in_batch`` in key order."""
    numbered = running_total(keys, order_by)
    return numbered.withColumns(
        {
            "batch_id": whole_div(F.col("row_index"), batch_size),
            "row_in_batch": F.pmod("row_index", F.lit(batch_size)).cast("int"),
        }
    )


def shuffled_batches(
    keys: DataFrame, key: list[str], batch_size: int, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """Batches over a new random order in each epoch, the same for the same seed."""
    hashed = keys.withColumn("_hash", repeatable_hash(f"{seed}:{epoch}", *key))
    return seq_batches(hashed, ["_hash", *key], batch_size).drop("_hash")


def sample_k(df: DataFrame, key: list[str], k: int, seed: int = 42) -> DataFrame:
    """``k`` random rows without replacement, all rows if there are fewer, none if k <= 0.

    The cut is found from the keys; the rows are filtered where they are.
    """
    cut = hash_cut(df, key, seed, max(k, 0))
    return df.where(before_hash_cut(cut, key, seed))


def sample_preview(df: DataFrame, key: list[str], k: int, seed: int = 42) -> DataFrame:
    """(keys, preview): at most ``k`` random rows as text.

    Shows the rendered messages, else the text, else all columns by name.
    """
    if "messages" in df.columns:
        shown = render(F.col("messages"))
    elif "text" in df.columns:
        shown = F.col("text")
    else:
        shown = F.to_json(F.struct(*sorted(df.columns)))
    return sample_k(df, key, k, seed).select(*key, shown.alias("preview"))
