"""Keywords of a document by term weight."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import words
from corpusloom.session import materialize

TERMS = "array<struct<word: string, tf: bigint>>"
# The most frequent words, whose weights every task knows: bounds what is sent, not the result.
COMMON_WORDS = 50_000


def _sizes(rows: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(row: np.ndarray, rows: int, word: pa.Array, tf: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([word, pa.array(tf, pa.int64())], ["word", "tf"]))


def count_terms(rows: pa.Array) -> pa.Array:
    """(word, tf) of each array of words, empty for null."""
    found = rows.flatten().dictionary_encode()
    kinds = max(1, len(found.dictionary))
    row = np.repeat(np.arange(len(rows)), _sizes(rows))
    cells, tf = np.unique(row * kinds + found.indices.to_numpy().astype(np.int64), return_counts=True)
    return _lists(cells // kinds, len(rows), found.dictionary.take(pa.array(cells % kinds)), tf)


def likely_terms(rows: pa.Array, common: pa.Array, weights: np.ndarray, least: float, most: float, k: int) -> pa.Array:
    """The terms of each row that can be among its ``k`` best.

    Weights of common words are known, those of others lie between ``least`` and
    ``most``. A term is left out if ``k`` others are better whatever the weights.
    """
    terms = rows.flatten()
    word, tf = terms.field("word"), terms.field("tf").to_numpy()
    place = pc.fill_null(pc.index_in(word, value_set=common), -1).to_numpy()
    known = np.append(weights, 0.0)[place]
    low, high = (tf * np.where(place >= 0, known, bound) for bound in (least, most))
    sizes = _sizes(rows)
    row, starts = np.repeat(np.arange(len(rows)), sizes), np.cumsum(sizes) - sizes
    bar = np.full(len(rows), -np.inf)
    enough = np.flatnonzero(sizes >= k)
    bar[enough] = low[np.lexsort((-low, row))][starts[enough] + k - 1]
    # Scores are rounded to six digits, so nearly equal ones may tie.
    keep = high >= (bar - 1e-5 - 1e-9 * np.abs(bar))[row]
    return _lists(row[keep], len(rows), word.filter(pa.array(keep)), tf[keep])


def _counted(text: Column) -> Column:
    @F.arrow_udf(TERMS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield count_terms(rows)

    return run(words(text))


def _likely(terms: Column, frequency: DataFrame, n_docs: int, k: int) -> Column:
    top = frequency.orderBy(F.desc("df")).limit(COMMON_WORDS).collect()
    names, counts = [r["word"] for r in top], np.array([r["df"] for r in top], dtype=np.float64)
    weights, most = np.log(n_docs / counts), float(np.log(max(1, n_docs)))
    least = float(weights[-1]) if len(weights) else 0.0

    @F.arrow_udf(TERMS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common = pa.array(names, pa.string())
        for rows in batches:
            yield likely_terms(rows, common, weights, least, most, k)

    return run(terms)


def top_keywords(df: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """(key, rank, word, score): the ``k`` words with the largest tf * ln(N / df).

    Terms are counted inside their row and written, one row per text; only rows that
    share a key are brought together. Document frequencies are aggregated from that
    table and written too. They are joined back to the terms that can be among the
    best: with the weights of the most frequent words at hand, and bounds for the
    others, most terms of a text are ruled out where they are.
    """
    # Written once: three reads follow, and splitting texts is the costly part.
    rows = df.select(key, _counted(F.col(text)).alias("terms")).where(F.size("terms") > 0)
    rows = materialize(rows, "term-counts")
    listed = lambda part: part.select(key, F.inline("terms"))
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("_again"))
    repeated = materialize(repeated, "repeated-keys")
    merged = None
    if not repeated.isEmpty():
        same = F.col(key).eqNullSafe(F.col("_again"))
        merged = listed(rows.join(repeated, same, "left_semi")).groupBy(key, "word").agg(F.sum("tf").alias("tf"))
        merged = materialize(merged, "merged-terms")
        rows = rows.join(repeated, same, "left_anti")
    counted = listed(rows) if merged is None else listed(rows).unionByName(merged)
    n_docs = df.count()
    frequency = materialize(counted.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "document-frequency")
    likely = listed(rows.select(key, _likely(F.col("terms"), frequency, n_docs, k).alias("terms")))
    weighed = (likely if merged is None else likely.unionByName(merged)).join(frequency, "word")
    # Rounded before ranking so that equal scores tie in every engine.
    score = F.round(F.col("tf") * F.ln(F.lit(n_docs) / F.col("df")), 6)
    best = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("word"))
    return (
        weighed.withColumn("score", score)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(key, "rank", "word", "score")
    )
