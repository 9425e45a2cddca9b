"""Truncated sampling, batch generation, batch scoring and adapter routing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import bind
from corpusloom.operators.positions import repeatable_hash, unit_number
from corpusloom.session import collect_bounded, materialize

MAX_ADAPTERS = 10_000


def top_p_filter(
    model: DataFrame,
    group: list[str],
    token: str = "next",
    probability: str = "p",
    temperature: Column | float = 1.0,
    top_p: Column | float = 1.0,
) -> DataFrame:
    """(group, token, rank, p, cum): the smallest set of top tokens whose total reaches ``top_p``.

    Probabilities are first raised to 1/temperature. A group is one row of the
    next-token table, so it holds at most one row per vocabulary entry.
    """
    temperature = F.lit(temperature) if not isinstance(temperature, Column) else temperature
    top_p = F.lit(top_p) if not isinstance(top_p, Column) else top_p
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy(F.col("_q").desc(), F.col(token))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    kept = (
        model.withColumns({"_w": F.pow(F.col(probability), 1 / temperature), "_top_p": top_p})
        .withColumn("_q", F.col("_w") / F.sum("_w").over(whole))
        .withColumns(
            {"_before": F.coalesce(F.sum("_q").over(before), F.lit(0.0)), "rank": F.row_number().over(ordered)}
        )
        .where((F.col("_before") < F.col("_top_p")) | (F.col("rank") == 1))
    )
    return (
        kept.withColumn(probability, F.col("_q") / F.sum("_q").over(whole))
        .withColumn("cum", F.sum(probability).over(running))
        .select(*group, token, "rank", probability, "cum")
    )


def pack_model(filtered: DataFrame, group: list[str], token: str = "next") -> DataFrame:
    """One row per group: successor tokens and their running totals, best first."""
    items = F.array_sort(F.collect_list(F.struct("rank", F.col(token).alias("token"), "cum")))
    return filtered.groupBy(*group).agg(items.alias("_items")).select(
        *group, F.col("_items.token").alias("_tokens"), F.col("_items.cum").alias("_cums")
    )


def generate(
    prompts: DataFrame,
    packed: DataFrame,
    max_tokens: Column | int,
    steps: int,
    seed: int = 42,
    prompt_id: str = "prompt_id",
    current: str = "current",
    group: tuple[str, ...] = (),
    durable_every: int = 20,
) -> DataFrame:
    """Add ``generated``: up to ``max_tokens`` tokens drawn one after the other.

    All prompts advance together, one join with the next-token table per step.
    The table has one row per current token, so a join never multiplies rows;
    it is written once, so whether it is broadcast follows from its real size,
    and a hot token in a shuffled join is split by adaptive execution. Draws
    depend on (seed, prompt, step) only. A token without successor ends the text.
    """
    model = materialize(packed, "next-token").withColumnsRenamed({g: f"_{g}" for g in ("prev", *group)})
    limit = F.lit(max_tokens) if not isinstance(max_tokens, Column) else max_tokens
    state = prompts.withColumns(
        {"_current": F.col(current), "_limit": limit, "generated": F.array().cast("array<string>")}
    )
    carried = state.columns
    matches = [F.col("_current") == F.col("_prev"), *[F.col(g) == F.col(f"_{g}") for g in group]]
    for step in range(steps):
        draw = unit_number(repeatable_hash(seed, prompt_id, F.lit(step)))
        below = bind(draw, lambda u: F.size(F.filter("_cums", lambda c: c <= u)))
        token = F.get("_tokens", F.least(below, F.size("_cums") - 1))
        drawn = state.join(model, matches, "left").select(
            *[c for c in carried if c != "_current"],
            F.when(F.lit(step) < F.col("_limit"), token).alias("_current"),
        )
        added = F.concat("generated", F.array_compact(F.array("_current")))
        state = drawn.select(*[added.alias(c) if c == "generated" else c for c in carried])
        if (step + 1) % durable_every == 0 and step + 1 < steps:
            state = materialize(state, "generated")
    return state.drop("_current", "_limit")


def successors(model: DataFrame, token: str = "next", probability: str = "p") -> DataFrame:
    """(prev, _tokens, _ps): one row per current token with its successors, most likely first."""
    items = F.array_sort(F.collect_list(F.struct((-F.col(probability)).alias("minus"), F.col(token).alias("token"))))
    packed = model.groupBy("prev").agg(items.alias("_items"))
    return packed.select("prev", F.col("_items.token").alias("_tokens"), F.transform("_items", lambda x: -x["minus"]).alias("_ps"))


#: Cells of the padded table that rows are drawn in at a time.
DRAW_CELLS = 1 << 17


def drawn_places(ps: np.ndarray, sizes: np.ndarray, u: np.ndarray, temperature: np.ndarray, top_p: np.ndarray) -> np.ndarray:
    """The place that each row draws, from its probabilities in falling order; rows are not empty.

    The distribution of ``top_p_filter``, made for these rows only: probabilities
    to the power 1/temperature, the top ones up to ``top_p``, and the first whose
    running share passes ``u``. Sums run over one row, so equal rows draw alike.
    """
    longest = int(sizes.max())
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(len(sizes), dtype=np.int64)
    step = max(1, DRAW_CELLS // longest)
    for first in range(0, len(sizes), step):
        part = slice(first, first + step)
        place = np.arange(longest)[None, :]
        held = place < sizes[part, None]
        p = np.where(held, ps[np.minimum(starts[part, None] + place, len(ps) - 1)], 0.0)
        weights = np.where(held, p ** (1 / temperature[part, None]), 0.0)
        shares = weights / np.cumsum(weights, axis=1)[:, -1:]
        before = np.cumsum(shares, axis=1)
        before = np.hstack([np.zeros((len(before), 1)), before[:, :-1]])
        inside = held & ((before < top_p[part, None]) | (place == 0))
        kept = np.where(inside, shares, 0.0)
        running = np.cumsum(kept / np.cumsum(kept, axis=1)[:, -1:], axis=1)
        passed = (inside & (running <= u[part, None])).sum(axis=1)
        out[part] = np.minimum(passed, inside.sum(axis=1) - 1)
    return out


def draw_token(tokens: pa.Array, ps: pa.Array, u: pa.Array, temperature: pa.Array, top_p: pa.Array) -> pa.Array:
    """One token drawn for each row, null without successors."""
    sizes = pc.fill_null(pc.list_value_length(ps), 0).to_numpy().astype(np.int64)
    some = np.flatnonzero(sizes > 0)
    out = np.full(len(sizes), -1, dtype=np.int64)
    if len(some):
        pick = [a.to_numpy(zero_copy_only=False)[some] for a in (u, temperature, top_p)]
        places = drawn_places(ps.flatten().to_numpy(zero_copy_only=False), sizes[some], *pick)
        out[some] = np.cumsum(sizes)[some] - sizes[some] + places
    return tokens.flatten().take(pa.array(out, mask=out < 0))


def generate_from(
    prompts: DataFrame,
    model: DataFrame,
    temperature: Column | float,
    top_p: Column | float,
    max_tokens: Column | int,
    steps: int,
    seed: int = 42,
    prompt_id: str = "prompt_id",
    current: str = "current",
    durable_every: int = 3,
) -> DataFrame:
    """Add ``generated``, as ``generate`` does, with sampling parameters of each prompt.

    The next-token table stays as it is, one row per current token: the truncated
    distribution is derived for the tokens that prompts reach, not for each
    combination of table row and parameters. Every step in a stage has a Python
    worker of its own beside each task, so few steps share one.
    """
    table = materialize(successors(model), "successors").withColumnRenamed("prev", "_prev")
    column = lambda value: value if isinstance(value, Column) else F.lit(value)
    state = prompts.withColumns(
        {
            "_current": F.col(current), "_limit": column(max_tokens), "_temperature": column(temperature),
            "_top_p": column(top_p), "generated": F.array().cast("array<string>"),
        }
    )
    carried = state.columns
    draw = F.arrow_udf(draw_token, "string")
    for step in range(steps):
        u = unit_number(repeatable_hash(seed, prompt_id, F.lit(step)))
        met = state.join(table, F.col("_current") == F.col("_prev"), "left")
        token = draw(F.col("_tokens"), F.col("_ps"), u, F.col("_temperature"), F.col("_top_p"))
        drawn = met.select(*[c for c in carried if c != "_current"], F.when(F.lit(step) < F.col("_limit"), token).alias("_current"))
        added = F.concat("generated", F.array_compact(F.array("_current")))
        state = drawn.select(*[added.alias(c) if c == "generated" else c for c in carried])
        if (step + 1) % durable_every == 0 and step + 1 < steps:
            state = materialize(state, "generated")
    return state.drop("_current", "_limit", "_temperature", "_top_p")


Scorer = Callable[[pd.Series], "pd.Series | list"]


def score_prompts(
    prompts: DataFrame,
    make_scorer: Callable[[], Scorer],
    prompt: str = "prompt",
    output: str = "generated",
    output_type: str = "string",
) -> DataFrame:
    """Add an output column with any Python function over batches of prompts.

    ``make_scorer`` runs once per task (load a model there); the function it
    returns gets one Arrow batch at a time.
    """
    schema = T.StructType([*prompts.schema.fields]).add(output, output_type)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            yield batch.assign(**{output: list(scorer(batch[prompt]))})

    return prompts.mapInPandas(run, schema)


def adapter_models(model: DataFrame, adapters: DataFrame, adapter: str = "adapter") -> DataFrame:
    """The next-token table once per adapter, with the adapter's sampling parameters."""
    rows = collect_bounded(adapters, MAX_ADAPTERS, "adapter table")
    names = adapters.columns
    entries = F.array(*[F.struct(*[F.lit(row[n]).alias(n) for n in names]) for row in rows])
    return model.select("*", F.inline(entries))


def route_to_adapters(prompts: DataFrame, adapters: DataFrame, adapter: str = "adapter") -> DataFrame:
    """Give each prompt the sampling parameters of its adapter; an unknown adapter is an error."""
    known = {row[adapter] for row in collect_bounded(adapters, MAX_ADAPTERS, "adapter table")}
    checked = F.when(F.col(adapter).isin(*known), F.col(adapter)).otherwise(
        F.raise_error(F.concat(F.lit("unknown adapter: "), F.col(adapter))).cast("string")
    )
    return prompts.withColumn(adapter, checked).join(F.broadcast(adapters), adapter)
