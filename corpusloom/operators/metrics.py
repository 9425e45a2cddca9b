"""Evaluation of predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import IGNORED, aligned_hits, all_inputs, all_targets

MAX_ORDER = 4

# The metric's public default tokenization ("13a"), as
# (pattern, replacement) in the order in which they apply.
BLEU_LITERALS = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
BLEU_PATTERNS = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
    (r"([^0-9])([\.,])", r"\1 \2 "),
    (r"([\.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
)


def bleu_normal_form(texts: pa.Array) -> pa.Array:
    """Texts whose white-space separated parts are the metric's default tokens."""
    for old, new in BLEU_LITERALS:
        texts = pc.replace_substring(texts, old, new)
    texts = pc.binary_join_element_wise("", texts, "", " ")
    for pattern, replacement in BLEU_PATTERNS:
        texts = pc.replace_substring_regex(texts, pattern, replacement)
    return texts


SLICE_ROWS = 512
STATE = [f"{letter}{n}" for letter in "mt" for n in range(1, MAX_ORDER + 1)] + ["reference_length"]


def clipped_counts(predictions: list[list[str]], references: list[list[str]]) -> list[int]:
    """The sums of ``STATE`` over rows of tokens: for each n-gram order those of the
    predictions that the reference of the row has as often, and all of them.

    The code of an n-gram is made from that of its first n - 1 tokens and the last
    token; that of the first token holds the row. One sort per order, no loops.
    """
    rows = len(predictions)
    sizes = np.array([len(t) for t in chain(predictions, references)], dtype=np.int64)
    tokens = pa.array(list(chain(chain.from_iterable(predictions), chain.from_iterable(references))), pa.string())
    found = tokens.dictionary_encode()
    codes, kinds = found.indices.to_numpy().astype(np.int64), max(1, len(found.dictionary))
    text = np.repeat(np.arange(2 * rows), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # tokens from here to the end
    at, gram = np.arange(len(codes)), text % max(1, rows)
    matched, total = [], []
    for n in range(1, MAX_ORDER + 1):
        keep = left[at] >= n
        at, gram = at[keep], gram[keep]
        _, gram = np.unique(gram * kinds + codes[at + n - 1], return_inverse=True)
        predicted = text[at] < rows
        kinds_now = int(gram.max()) + 1 if len(gram) else 0
        have, want = np.bincount(gram[predicted], minlength=kinds_now), np.bincount(gram[~predicted], minlength=kinds_now)
        matched.append(int(np.minimum(have, want).sum()))
        total.append(int(predicted.sum()))
    return [*matched, *total, int(sizes[rows:].sum())]


def _states(extra: int):
    """One row of sums for every few hundred rows of (prediction, reference, extra numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                sides = [[(t or "").split() for t in bleu_normal_form(part.column(i)).to_pylist()] for i in (0, 1)]
                sums = [sum(filter(None, part.column(2 + i).to_pylist())) for i in range(extra)]
                names = [*STATE, *part.schema.names[2:]]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in [*clipped_counts(*sides), *sums]], names)

    return run


def metric_states(df: DataFrame, prediction: Column, reference: Column, **numbers: Column) -> DataFrame:
    """One row with the sums that the metrics are made of; sums of parts add up.

    N-grams match within a row only, so rows are reduced where they are, and
    only a few sums per task are shuffled. Grouping by (row, n-gram) would
    turn every text into eight times as many shuffled rows as it has words.
    The patterns of the metric run on the Arrow batches too: as chained
    expressions of Spark they took most of the time.
    """
    rows = df.select(
        prediction.alias("_p"), reference.alias("_r"),
        *[c.cast("long").alias(name) for name, c in numbers.items()],
    )
    names = [*STATE, *numbers]
    partial = rows.mapInArrow(_states(len(numbers)), ", ".join(f"{name} long" for name in names))
    return partial.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])


def corpus_bleu(df: DataFrame, prediction: str, reference: str) -> DataFrame:
    """One row: BLEU of the corpus and its parts. One reference per row, no smoothing."""
    return bleu_record(metric_states(df, F.col(prediction), F.col(reference)))


def bleu_record(totals: DataFrame, *more: Column) -> DataFrame:
    """BLEU and its parts from the sums of ``metric_states``, with further columns."""
    precisions = {
        f"precision_{n}": F.when(F.col(f"t{n}") > 0, F.col(f"m{n}") / F.col(f"t{n}")).otherwise(0.0)
        for n in range(1, MAX_ORDER + 1)
    }
    ratio = F.when(F.col("reference_length") > 0, F.col("t1") / F.col("reference_length"))
    penalty = F.when(F.col("ratio") > 1, 1.0).when(
        F.col("ratio") > 0, F.exp(1 - 1 / F.col("ratio"))
    ).otherwise(0.0)
    log_mean = sum((F.ln(F.col(name)) for name in precisions), F.lit(0.0)) / MAX_ORDER
    least = F.least(*[F.col(name) for name in precisions])
    return (
        totals.withColumns({**precisions, "ratio": ratio})
        .withColumn("brevity_penalty", penalty)
        .select(
            F.when(least > 0, F.exp(log_mean) * F.col("brevity_penalty")).otherwise(0.0).alias("bleu"),
            *precisions,
            "brevity_penalty",
            F.col("ratio").alias("length_ratio"),
            F.col("t1").alias("translation_length"),
            "reference_length",
            *more,
        )
    )


def evaluate(df: DataFrame, predictions: str, labels: str, decode: Callable[[Column], Column]) -> DataFrame:
    """One record of one prediction column: BLEU of the decoded ids and token accuracy.

    Label t+1 is compared with prediction t, positions whose label is ignored are
    left out of both metrics. One pass over the rows.
    """
    shifted = F.zip_with(
        all_inputs(F.col(predictions)), all_targets(F.col(labels)), lambda p, l: F.struct(p.alias("p"), l.alias("l"))
    )
    rows = df.select(
        aligned_hits(F.col(predictions), F.col(labels)).alias("h"),
        F.filter(shifted, lambda x: x["l"] != IGNORED).alias("pairs"),
    )
    sums = metric_states(
        rows, decode(F.col("pairs.p")), decode(F.col("pairs.l")), n_right=F.col("h.right"), n_counted=F.col("h.counted")
    )
    accuracy = F.when(F.col("n_counted") > 0, F.col("n_right") / F.col("n_counted")).alias("accuracy")
    return bleu_record(sums, accuracy, F.col("n_right"), F.col("n_counted"))


def token_accuracy(df: DataFrame, predictions: str, labels: str) -> DataFrame:
    """One row: share of right predictions over the counted positions, null if there is none."""
    hits = df.select(aligned_hits(F.col(predictions), F.col(labels)).alias("h"))
    return hits.agg(F.sum("h.right").alias("n_right"), F.sum("h.counted").alias("n_counted")).select(
        F.when(F.col("n_counted") > 0, F.col("n_right") / F.col("n_counted")).alias("accuracy"),
        "n_right",
        "n_counted",
    )


def loss_by_split(df: DataFrame, split: str, batch: str, loss: str) -> DataFrame:
    """(split, n_batches, loss): mean of the batch means, each batch with the same weight."""
    per_batch = df.groupBy(split, batch).agg(F.avg(loss).alias("_mean"))
    return per_batch.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_batches"), F.avg("_mean").alias("loss")
    )


def loss_history(df: DataFrame, step: str, every: int) -> DataFrame:
    """The steps at which losses are reported."""
    return df.where(F.pmod(F.col(step), F.lit(every)) == 0)


def metrics_report(*parts: DataFrame) -> DataFrame:
    """One record with the columns of all one-row metric frames."""
    first, rest = parts[0], parts[1:]
    # One scalar subquery per part, as a struct, so each part is computed once.
    names = [f"_part{i}" for i in range(len(rest))]
    whole = first.select(
        "*", *[part.select(F.struct("*")).scalar().alias(name) for part, name in zip(rest, names)]
    )
    return whole.select(*first.columns, *[f"{name}.*" for name in names])
