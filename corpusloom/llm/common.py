"""Shared helpers: reading tables, packing rows, Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import collect_bounded

#: Rows that one step inside a task holds as Python objects.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _th, _text): id, hash of the text and the text, null texts as empty.

    (_id, _th) finds a row again in a later scan: rows that share it are equal
    in id and text. No other column is read.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    return df.select(quoted(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``keyed`` with the whole row in the struct ``_row``, so that no name can clash."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    return df.select(
        F.struct(*[quoted(c).alias(c) for c in df.columns]).alias("_row"),
        quoted(id_col).cast("long").alias("_id"),
        F.xxhash64(text).alias("_th"),
    )


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def keep_rows(df: DataFrame, id_col: str, text_col: str, keys: DataFrame) -> DataFrame:
    """One row of ``df`` for each (_id, _th) of ``keys``, whose rows are distinct.

    Repeated rows of ``df`` (same id and text) are told apart by nothing but
    their other columns; the one with the smallest hash of the row stays, so reruns
    keep the same row.
    """
    k = keys.select(F.col("_id").alias("_kid"), F.col("_th").alias("_kth"))
    found = packed(df, id_col, text_col).join(k, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")))
    # A hash of the whole row orders repeated rows: dropDuplicates would keep any of them.
    least = found.groupBy("_kid", "_kth").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return unpacked(least, df.columns)


FILTER_BITS = 1 << 26


def _places(column: str) -> list[Column]:
    """The bits of a key in the filter."""
    return [F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(FILTER_BITS)) for seed in range(4)]


def possible(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose hash ``column`` may be in the one column of ``keys``; none of these is lost.

    A Bloom filter of fixed size (8 MB at most), made from the keys and looked up in the
    scan, so that rows without a partner are not shuffled by the join that
    follows. With more keys than it has room for it lets more rows pass.
    """
    name = keys.columns[0]
    places = keys.select(F.explode(F.array(*_places(name))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    table = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    rows = collect_bounded(words, FILTER_BITS >> 6, "words of the filter")
    table[[r["w"] for r in rows]] = [r["bits"] for r in rows]
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def held(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        bits, all_set = shared.value, True
        for places in (a, b, c, d):
            p = places.to_numpy()
            all_set &= (bits[p >> 6] >> (p & 63)) & 1 == 1
        return pa.array(all_set)

    return df.where(held(*_places(column)))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of a few rows, so that a task holds few texts as objects.

    The process outlives the task and Arrow keeps the freed memory of its batches; at
    the end it is given back, as the stages that follow may need it in the JVM.
    """
    batch = None
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    del batch
    pa.default_memory_pool().release_unused()
