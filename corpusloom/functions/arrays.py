"""Token arrays, labels, and score vectors inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label that losses and metrics leave out.
IGNORED = -100


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def find_pattern(ids: Column, pattern: list[int]) -> Column:
    """First index at which ``pattern`` starts in ``ids``, else -1."""
    m = len(pattern)
    if m == 0:
        return F.when(ids.isNotNull(), 0)
    wanted = F.array(*[F.lit(p) for p in pattern])
    last = F.size(ids) - m
    hits = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        # The first item decides cheaply before a slice is built.
        lambda i: (F.get(ids, i) == pattern[0]) & (F.slice(ids, i + 1, m) == wanted),
    )
    return F.when(last < 0, -1).otherwise(F.coalesce(F.get(hits, F.lit(0)), F.lit(-1)))


def response_labels(ids: Column, pattern: list[int], strict: bool = True) -> Column:
    """Ids with everything up to the end of the first response marker ignored.

    Without the marker: an error, or null if not ``strict``.
    """
    missing = F.raise_error(F.lit("response marker not found in token ids")).cast("array<int>")

    def masked(start: Column) -> Column:
        n = start + len(pattern)
        labels = F.concat(F.array_repeat(F.lit(IGNORED), n), F.slice(ids, n + 1, F.size(ids)))
        return F.when(start >= 0, labels).otherwise(missing if strict else F.lit(None))

    return bind(find_pattern(ids, pattern), masked)


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def token_types(ids: Column) -> Column:
    return F.array_repeat(F.lit(0), F.size(ids))


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def last_tokens(ids: Column, block: int) -> Column:
    """The last ``block`` items, all of them if there are fewer."""
    return F.slice(ids, F.greatest(F.size(ids) - block + 1, F.lit(1)), block)


def strip_prompt(output: Column, prompt_length: Column) -> Column:
    """What was generated after the prompt."""
    return F.slice(output, prompt_length + 1, F.greatest(F.size(output) - prompt_length, F.lit(0)))


def block_input(ids: Column, block: int, start: int = 0) -> Column:
    return F.slice(ids, start + 1, block)


def block_target(ids: Column, block: int, start: int = 0) -> Column:
    """The block one item further on: item t is what follows input item t."""
    return F.slice(ids, start + 2, block)


def all_inputs(ids: Column) -> Column:
    return F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))


def all_targets(ids: Column) -> Column:
    return F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))


def context_targets(ids: Column, block: int) -> Column:
    """Array of (context, target) for every prefix of the first block."""
    y = block_target(ids, block)
    return F.transform(
        y, lambda target, t: F.struct(F.slice(ids, 1, t + 1).alias("context"), target.alias("target"))
    )


def pad_right(values: Column, length: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), length - F.size(values)))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(left: Column, right: Column) -> Column:
    return array_sum(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")))


def _shifted_exp(scores: Column, body) -> Column:
    """``body(top, exps)`` with the maximum score and exp(score - maximum)."""
    return bind(
        F.array_max(scores).cast("double"),
        lambda top: bind(
            F.transform(scores, lambda x: F.exp(x.cast("double") - top)), lambda exps: body(top, exps)
        ),
    )


def softmax(scores: Column) -> Column:
    """Softmax of one score vector, shifted by its maximum so it cannot overflow."""
    return _shifted_exp(
        scores, lambda top, exps: bind(array_sum(exps), lambda total: F.transform(exps, lambda e: e / total))
    )


def log_sum_exp(scores: Column) -> Column:
    return _shifted_exp(scores, lambda top, exps: top + F.ln(array_sum(exps)))


def argmax(scores: Column) -> Column:
    """Index of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(scores: Column, target: Column) -> Column:
    """Loss of one row; null where the target is ignored."""
    return F.when(
        target != IGNORED, log_sum_exp(scores) - F.element_at(scores, target.cast("int") + 1).cast("double")
    )


def aligned_hits(predictions: Column, labels: Column) -> Column:
    """(right, counted) of one row: label t+1 against prediction t, ignored labels left out."""
    pairs = F.zip_with(
        all_inputs(predictions),
        all_targets(labels),
        lambda p, l: F.struct(
            (l != IGNORED).cast("long").alias("counted"),
            ((l != IGNORED) & (p == l)).cast("long").alias("right"),
        ),
    )
    zero = F.struct(F.lit(0).cast("long").alias("right"), F.lit(0).cast("long").alias("counted"))
    return F.aggregate(
        pairs,
        zero,
        lambda s, x: F.struct(
            (s["right"] + x["right"]).alias("right"), (s["counted"] + x["counted"]).alias("counted")
        ),
    )
