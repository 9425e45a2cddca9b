"""Next-token table of the stream and its loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import all_inputs, all_targets
from corpusloom.operators.sequences import StreamCut, stream_split


def boundary_tokens(tokens: Column) -> dict[str, Column]:
    """Columns that ``stream_offsets`` must carry for ``pair_counts``."""
    return {"first_token": F.get(tokens, F.lit(0)), "last_token": F.try_element_at(tokens, F.lit(-1))}


def pair_counts(df: DataFrame, tokens: Column, offsets: DataFrame, cut: StreamCut) -> DataFrame:
    """(split, prev, next, n): neighbours in the stream, on each side of the cut.

    Pairs inside a row are counted where the row is; the shuffle carries at most
    one row per pair and task. Pairs across two rows come from the offsets
    table alone. The pair across the cut belongs to neither side.
    """
    split = stream_split(df, tokens, cut)
    inner = (
        split.select(
            "split", F.explode(F.arrays_zip(all_inputs(F.col("tokens")).alias("a"), all_targets(F.col("tokens")).alias("b"))).alias("p")
        )
        .select("split", F.col("p.a").alias("prev"), F.col("p.b").alias("next"))
        .groupBy("split", "prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    filled = offsets.where(F.col("length") > 0)
    ends = filled.select(
        (F.col("offset") + F.col("length")).alias("_at"), F.col("last_token").alias("prev")
    )
    starts = filled.select(F.col("offset").alias("_at"), F.col("first_token").alias("next"))
    across = (
        ends.join(starts, "_at")
        .where(F.col("_at") != cut.position)
        .select(F.when(F.col("_at") < cut.position, "train").otherwise("test").alias("split"), "prev", "next")
        .groupBy("split", "prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return inner.unionByName(across).groupBy("split", "prev", "next").agg(F.sum("n").alias("n"))


def bigram_model(counts: DataFrame, alpha: float = 0.0, vocab_size: int = 0) -> DataFrame:
    """(prev, next, n, p): P(next given prev) from the train pairs.

    With ``alpha`` every one of ``vocab_size`` successors counts ``alpha`` more;
    ``unseen_p`` is then the probability of a successor not in the table.
    """
    train = counts.where(F.col("split") == "train").select("prev", "next", "n")
    total = F.sum("n").over(Window.partitionBy("prev")) + F.lit(alpha * vocab_size)
    model = train.withColumn("p", (F.col("n") + F.lit(alpha)) / total)
    return model.withColumn("unseen_p", F.lit(alpha) / total) if alpha > 0 else model


def bigram_loss(counts: DataFrame, model: DataFrame) -> DataFrame:
    """(split, n_pairs, n_uncovered, loss): mean of -ln p over the pairs the model covers.

    Joins pair counts, not pairs: both sides have at most one row per pair type.
    """
    joined = counts.join(model.select("prev", "next", "p"), ["prev", "next"], "left")
    covered = F.sum(F.when(F.col("p").isNotNull(), F.col("n")).otherwise(0))
    return joined.groupBy("split").agg(
        F.sum("n").alias("n_pairs"),
        F.sum(F.when(F.col("p").isNull(), F.col("n")).otherwise(0)).alias("n_uncovered"),
        F.when(covered > 0, F.sum(-F.col("n") * F.ln("p")) / covered).alias("loss"),
    )
