"""Operators over sequences of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import dot, softmax
from corpusloom.operators.positions import whole_div


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Stretches of equal keys of sorted rows; the flag says whether one goes on from the last batch."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for name in keys:
            column = batch.column(name)
            change |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)))
        borders = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        first = tuple(batch.column(name)[0].as_py() for name in keys)
        for i, (low, high) in enumerate(zip(borders, borders[1:])):
            yield i == 0 and first == last, batch.slice(low, high - low)
        last = tuple(batch.column(name)[batch.num_rows - 1].as_py() for name in keys)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().cast("float64").to_numpy().reshape(len(column), -1)


def _vectors(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_seq, _block, _n, _v): number and sum of the vectors of each stretch of a block."""
    for _, part in _segments(batches, ["_seq", "_block"]):
        total = _matrix(part.column("_v")).sum(axis=0)[None, :]
        columns = [part.column("_seq").slice(0, 1), part.column("_block").slice(0, 1), pa.array([part.num_rows], pa.int64()), _vectors(total)]
        yield pa.RecordBatch.from_arrays(columns, ["_seq", "_block", "_n", "_v"])


def _running_means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means of the rows so far; the first row of a block may hold what came before it."""
    number, total = 0, None
    for goes_on, part in _segments(batches, ["_seq", "_block"]):
        n = np.cumsum(part.column("_n").to_numpy())
        sums = np.cumsum(_matrix(part.column("_v")), axis=0)
        if goes_on:
            n, sums = n + number, sums + total
        number, total = n[-1], sums[-1]
        rows = ~np.asarray(part.column("_carried"))
        if rows.any():
            mask = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("_seq").filter(mask), part.column("_pos").filter(mask), _vectors(sums[rows] / n[rows, None])], ["_seq", "_pos", "mean"]
            )


def causal_mean(
    df: DataFrame, seq: str, pos: str, vector: str, dim: int | None = None, block: int = 4096
) -> DataFrame:
    """(seq, pos, mean): at each position the mean of all vectors of the sequence so far.

    A scan over blocks of ``block`` positions: sums of whole blocks first, their
    running totals, then running sums inside each block that begin with what came
    before it. One long sequence is spread over many tasks, rows are shuffled
    once, and the plan does not depend on the dimension (``dim`` is not needed).
    """
    kind, at = df.schema[seq].dataType.simpleString(), df.schema[pos].dataType.simpleString()
    rows = df.select(
        F.col(seq).alias("_seq"), whole_div(F.col(pos), block).alias("_block"), F.col(pos).alias("_pos"),
        F.col(vector).cast("array<double>").alias("_v"),
    )
    sums = rows.select("_seq", "_block", "_v").mapInArrow(_block_sums, f"_seq {kind}, _block long, _n long, _v array<double>")
    cells = sums.select("_seq", "_block", "_n", F.posexplode("_v").alias("_i", "_x"))
    cells = cells.groupBy("_seq", "_block", "_i").agg(F.sum("_n").alias("_n"), F.sum("_x").alias("_x"))
    before = Window.partitionBy("_seq", "_i").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_seq", "_block", "_i", F.sum("_n").over(before).alias("_n"), F.sum("_x").over(before).alias("_x")).where("_n is not null")
    carried = cells.groupBy("_seq", "_block").agg(F.max("_n").alias("_n"), F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_v"))
    carried = carried.select("_seq", "_block", F.lit(None).cast(at).alias("_pos"), F.col("_v._x").alias("_v"), "_n", F.lit(True).alias("_carried"))
    tiles = rows.withColumns({"_n": F.lit(1).cast("long"), "_carried": F.lit(False)}).unionByName(carried)
    ordered = tiles.repartition("_seq", "_block").sortWithinPartitions("_seq", "_block", F.desc("_carried"), "_pos")
    found = ordered.mapInArrow(_running_means, f"_seq {kind}, _pos {at}, mean array<double>")
    return found.select(F.col("_seq").alias(seq), F.col("_pos").alias(pos), "mean")


def _banded(part: pa.Table, block: int, factor: float) -> pa.RecordBatch:
    """Weighted means of the rows of one tile; rows of the halo are only looked at."""
    pos = part.column("_pos").combine_chunks().to_numpy()
    q, k, v = (_matrix(part.column(c).combine_chunks()) for c in ("_q", "_k", "_v"))
    own = ~np.asarray(part.column("_halo").combine_chunks())
    scores = (q[own] @ k.T) * factor
    outside = (pos[None, :] > pos[own][:, None]) | (pos[None, :] <= pos[own][:, None] - block)
    scores[outside] = -np.inf
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    output = (weights / weights.sum(axis=1, keepdims=True)) @ v
    mask = pa.array(own)
    return pa.RecordBatch.from_arrays(
        [part.column("_seq").combine_chunks().filter(mask), pa.array(pos[own]), _vectors(output)], ["_seq", "_pos", "output"]
    )


def _sliding(block: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for goes_on, part in _segments(batches, ["_seq", "_tile"]):
            if held and not goes_on:
                yield _banded(pa.Table.from_batches(held), block, factor)
                held = []
            held.append(part)
        if held:
            yield _banded(pa.Table.from_batches(held), block, factor)

    return run


def sliding_history(
    df: DataFrame, seq: str, pos: str, query: str, key: str, value: str, dim: int, block: int, scaled: bool = True, tile: int = 256
) -> DataFrame:
    """(seq, pos, output): as ``similar_history``, but each position sees the last ``block`` positions.

    Sequences are cut into tiles; each tile also gets the last ``block - 1``
    positions before it, so a row moves at most twice and a task holds one tile.
    Positions are whole numbers; gaps shorten the history.
    """
    size = max(tile, block)
    kind = df.schema[seq].dataType.simpleString()
    at = F.col(pos).cast("long")
    rows = df.select(
        F.col(seq).alias("_seq"), at.alias("_pos"), whole_div(at, size).alias("_tile"),
        *[F.col(c).cast("array<double>").alias(name) for c, name in ((query, "_q"), (key, "_k"), (value, "_v"))],
    )
    own = F.struct(F.col("_tile").alias("tile"), F.lit(False).alias("halo"))
    after = F.when((F.col("_tile") + 1) * size - F.col("_pos") < block, F.struct((F.col("_tile") + 1).alias("tile"), F.lit(True).alias("halo")))
    dealt = rows.withColumn("_to", F.explode(F.array_compact(F.array(own, after))))
    dealt = dealt.select("_seq", F.col("_to.tile").alias("_tile"), "_pos", "_q", "_k", "_v", F.col("_to.halo").alias("_halo"))
    ordered = dealt.repartition("_seq", "_tile").sortWithinPartitions("_seq", "_tile", "_pos")
    # A tile may hold nothing but its halo.
    found = ordered.mapInArrow(_sliding(block, dim**-0.5 if scaled else 1.0), f"_seq {kind}, _pos long, output array<double>")
    return found.select(F.col("_seq").alias(seq), F.col("_pos").cast(df.schema[pos].dataType).alias(pos), "output")


def similar_history(
    df: DataFrame,
    seq: str,
    pos: str,
    query: str,
    key: str,
    value: str,
    dim: int,
    block: int,
    scaled: bool = True,
) -> DataFrame:
    """(seq, pos, output): mean of the earlier and current value vectors, weighted by
    the softmax of the (scaled) dot product of the current query with their keys.

    ``block`` is the context length: positions see the rows of their own block
    only. History is a window frame of at most ``block`` rows, kept in the row
    it belongs to, so no pairs of rows are produced.
    """
    frame = (
        Window.partitionBy(seq, whole_div(F.col(pos), block))
        .orderBy(pos)
        .rowsBetween(-(block - 1), Window.currentRow)
    )
    history = F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))).over(frame)
    factor = dim**-0.5 if scaled else 1.0

    def score(h: Column) -> Column:
        return dot(F.col(query), h["k"]) * F.lit(factor)

    weighed = (
        df.select(seq, pos, query, history.alias("_history"))
        .withColumn("_scores", F.transform("_history", score))
        .withColumn("_weights", softmax(F.col("_scores")))
    )
    zeros = F.array_repeat(F.lit(0.0), dim)
    output = F.aggregate(
        F.zip_with("_weights", "_history", lambda w, h: F.struct(w.alias("w"), h["v"].alias("v"))),
        zeros,
        lambda total, x: F.zip_with(total, x["v"], lambda a, b: a + x["w"] * b.cast("double")),
    )
    return weighed.select(seq, pos, output.alias("output"))


def last_vector(df: DataFrame, seq: str, pos: str, vector: str) -> DataFrame:
    """(seq, last): the vector at the last position of each sequence."""
    return df.groupBy(seq).agg(F.max_by(vector, pos).alias("last"))
