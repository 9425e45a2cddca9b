"""The corpus as one token stream, blocks of it, and padded batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import IGNORED, context_targets, pad_right
from corpusloom.operators.positions import Cut, hash_integer, repeatable_hash, running_total, whole_div
from corpusloom.session import collect_bounded

#: Rows that may be sent to every task.
BROADCAST_ROWS = 1_000_000


def stream_offsets(
    df: DataFrame, order_by: list[str], length: Column, extra: dict[str, Column] | None = None
) -> DataFrame:
    """(keys, length, offset): where each row's tokens start in the whole stream.

    Works on lengths only; texts and tokens are neither shuffled nor written.
    """
    slim = df.select(
        *order_by, length.cast("long").alias("length"), *[c.alias(n) for n, c in (extra or {}).items()]
    )
    return running_total(slim, order_by, "length", "offset")


def stream_length(offsets: DataFrame) -> int:
    row = offsets.agg(F.max(F.col("offset") + F.col("length")).alias("n")).first()
    return row["n"] or 0


@dataclass(frozen=True)
class StreamCut:
    """A stream position, held as the row it falls into and the index within it."""

    cut: Cut
    position: int
    local: int

    def tokens_before(self, length: Column) -> Column:
        """How many of a row's tokens come before the cut; row-local."""
        if self.cut.values is None:
            return length
        here = F.lit(True)
        for name, value in zip(self.cut.order, self.cut.values):
            here = here & (F.col(name) == F.lit(value))
        return F.when(self.cut.before(), length).when(here, F.lit(self.local)).otherwise(F.lit(0))


def stream_cut(offsets: DataFrame, order_by: list[str], position: int) -> StreamCut:
    """Find the row that holds stream position ``position``."""
    row = offsets.where(
        (F.col("offset") <= position) & (F.col("offset") + F.col("length") > position)
    ).first()
    if row is None:
        return StreamCut(Cut(tuple(order_by), None), position, 0)
    values = tuple(row[name] for name in order_by)
    return StreamCut(Cut(tuple(order_by), values), position, position - row["offset"])


def stream_split(
    df: DataFrame, ids: Column, cut: StreamCut, keep: list[str] | None = None
) -> DataFrame:
    """(keys, split, tokens): each row's tokens before the cut as "train", the rest as "test".

    The row that holds the cut gives two rows. No shuffle.
    """
    keys = keep or list(cut.cut.order)
    tokened = df.select(*keys, ids.alias("_ids"))
    n_train = cut.tokens_before(F.size("_ids")).cast("int")
    parts = F.array(
        F.struct(F.lit("train").alias("split"), F.slice("_ids", F.lit(1), n_train).alias("tokens")),
        F.struct(
            F.lit("test").alias("split"), F.slice("_ids", n_train + 1, F.size("_ids")).alias("tokens")
        ),
    )
    return (
        tokened.select(*keys, F.explode(parts).alias("_part"))
        .select(*keys, "_part.split", "_part.tokens")
        .where(F.size("tokens") > 0)
    )


def token_stream(
    df: DataFrame, ids: Column, offsets: DataFrame, order_by: list[str], chunk: int = 1024
) -> DataFrame:
    """(chunk_id, start_pos, tokens): the stream in pieces of ``chunk`` tokens.

    Rows are cut into pieces before the shuffle, so what moves is arrays and not
    single tokens, and no group holds more than ``chunk`` of them.
    """
    # Joined before encoding: texts are shorter than their ids.
    starts = offsets.where(F.col("length") > 0).select(*order_by, F.col("offset").alias("_offset"), F.col("length").alias("_length"))
    located = df.join(starts, order_by).select(
        *order_by, ids.alias("_ids"), F.col("_offset").alias("offset"), F.col("_length").alias("length")
    )
    end = F.col("offset") + F.col("length")
    first, last = whole_div(F.col("offset"), chunk), whole_div(end - 1, chunk)

    def piece(c: Column) -> Column:
        low = F.greatest(c * chunk, F.col("offset"))
        high = F.least((c + 1) * chunk, end)
        return F.struct(
            c.alias("chunk_id"),
            low.alias("low"),
            F.slice("_ids", (low - F.col("offset") + 1).cast("int"), (high - low).cast("int")).alias("ids"),
        )

    pieces = located.select(F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    ordered = F.array_sort(F.collect_list(F.struct("p.low", "p.ids")))
    return (
        pieces.groupBy(F.col("p.chunk_id").alias("chunk_id"))
        .agg(ordered.alias("_pieces"))
        .select(
            "chunk_id",
            (F.col("chunk_id") * chunk).alias("start_pos"),
            F.flatten(F.col("_pieces.ids")).alias("tokens"),
        )
    )


def stream_rows(stream: DataFrame) -> DataFrame:
    """(pos, token): the stream with one row per token."""
    return stream.select("start_pos", F.posexplode("tokens").alias("_i", "token")).select(
        (F.col("start_pos") + F.col("_i")).alias("pos"), "token"
    )


def random_blocks(
    spark: SparkSession,
    df: DataFrame,
    ids: Column,
    offsets: DataFrame,
    order_by: list[str],
    count: int,
    block: int,
    seed: int = 42,
    low: int = 0,
    high: int | None = None,
    grid: int = 65_536,
) -> DataFrame:
    """(sample_id, start, x, y): ``count`` blocks of the stream, drawn with replacement.

    Starts are uniform over [low, high - block). Documents are found by an equi
    join of grid cells that touches keys only; the texts are then read once,
    where they are, and only those that were hit are encoded. With more than
    ``BROADCAST_ROWS`` tokens to draw the hits are joined by a shuffle instead.
    A block may span several documents.
    """
    if high is None:
        high = stream_length(offsets)
    span = high - low - block
    if span <= 0:
        raise ValueError("the stream is not longer than one block")
    start = F.lit(low) + F.pmod(hash_integer(repeatable_hash(seed, "sample_id")), F.lit(span))
    starts = spark.range(count).withColumnRenamed("id", "sample_id").withColumn("start", start)
    end = F.col("start") + block + 1  # one token more than x, for y
    cell = lambda column: whole_div(column, grid)
    starts = starts.select(
        "sample_id", "start", F.explode(F.sequence(cell(F.col("start")), cell(end - 1))).alias("cell")
    )
    stop = F.col("offset") + F.col("length")
    cells = offsets.where(F.col("length") > 0).select(
        *order_by,
        "offset",
        "length",
        F.explode(F.sequence(cell(F.col("offset")), cell(stop - 1))).alias("cell"),
    )
    first_shared = F.greatest(cell(F.col("start")), cell(F.col("offset")))
    hits = (
        starts.join(cells, "cell")
        .where((F.col("offset") < end) & (stop > F.col("start")) & (F.col("cell") == first_shared))
        .select(
            *order_by,
            F.col("sample_id").alias("_sample"),
            F.col("start").alias("_start"),
            F.col("offset").alias("_offset"),
            F.greatest("start", "offset").alias("_low"),
            F.least(end, stop).alias("_high"),
        )
    )
    # A block meets at most one row with tokens per token, so the hits are few for any
    # corpus, and they go to the rows: the corpus is read where it is.
    if count * (block + 1) <= BROADCAST_ROWS:
        rows = collect_bounded(hits, count * (block + 1), "rows that blocks meet")
        hits = F.broadcast(spark.createDataFrame(rows, hits.schema))
    # Joined before encoding: only rows that were hit are encoded.
    parts = df.join(hits, order_by).select(
        F.col("_sample").alias("sample_id"),
        F.col("_start").alias("start"),
        F.col("_low").alias("low"),
        F.slice(
            ids, (F.col("_low") - F.col("_offset") + 1).cast("int"), (F.col("_high") - F.col("_low")).cast("int")
        ).alias("ids"),
    )
    joined = parts.groupBy("sample_id", "start").agg(
        F.array_sort(F.collect_list(F.struct("low", "ids"))).alias("_parts")
    )
    whole = F.flatten(F.col("_parts.ids"))
    return joined.select(
        "sample_id", "start", F.slice(whole, 1, block).alias("x"), F.slice(whole, 2, block).alias("y")
    )


def context_rows(df: DataFrame, key: list[str], ids: str, block: int) -> DataFrame:
    """(keys, t, context, target): every prefix of the first block with the token after it."""
    return df.select(*key, F.posexplode(context_targets(F.col(ids), block)).alias("t", "_p")).select(
        *key, "t", "_p.context", "_p.target"
    )


def pad_batches(
    df: DataFrame,
    batch: str = "batch_id",
    ids: str = "input_ids",
    pad_id: int = 0,
    fills: dict[str, int] | None = None,
    longest: str | None = None,
) -> DataFrame:
    """Pad all token arrays to the longest row of their batch, on the right.

    With the length of the longest row in the column ``longest`` no array is
    shuffled; without it a window over the batch finds it, which is bounded by
    the batch size.
    """
    fills = {ids: pad_id, "attention_mask": 0, "labels": IGNORED, "token_type_ids": 0, **(fills or {})}
    most = F.max(F.size(ids)).over(Window.partitionBy(batch)) if longest is None else F.col(longest).cast("int")
    present = {name: fill for name, fill in fills.items() if name in df.columns}
    return (
        df.withColumn("_longest", most)
        .withColumns({n: pad_right(F.col(n), F.col("_longest"), fill) for n, fill in present.items()})
        .drop("_longest")
    )
