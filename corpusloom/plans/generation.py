"""Queries on the next-token table, generation, scoring and routing."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from corpusloom.functions.text import chars, keep_known_chars
from corpusloom.operators.generation import generate, generate_from, pack_model, route_to_adapters, score_prompts, top_p_filter
from corpusloom.operators.ngram import bigram_loss, bigram_model, pair_counts
from corpusloom.operators.sequences import stream_cut, stream_length, stream_offsets
from corpusloom.plans.common import (
    SQL_CUT,
    SQL_STREAM,
    document_codes,
    documents,
    sql_digest,
    sql_unit,
    user_prompts,
)
from corpusloom.plans.registry import query
from corpusloom.session import materialize, spread

SEED = 42
STEPS = 20

# Sampling parameters of the batch and of the two adapters.
TEMPERATURE, TOP_P = 0.9, 0.95
ADAPTERS = (("lora1", 0.7, 0.9, 50), ("lora2", 0.1, 1.0, 50))
ADAPTER_SCHEMA = "adapter string, temperature double, top_p double, max_tokens int"
MAX_STEPS = max(row[3] for row in ADAPTERS)


def stream_pairs(spark, root):
    docs = documents(spark, root)
    tokens = chars(F.col("text"))
    ends = {
        "first_token": F.substring("text", 1, 1),
        "last_token": F.expr("right(text, 1)"),
    }
    offsets = stream_offsets(docs, ["doc_id"], F.char_length("text"), ends)
    cut = stream_cut(offsets, ["doc_id"], math.floor(0.9 * stream_length(offsets)))
    return pair_counts(spread(docs, "doc_id"), tokens, offsets, cut)


def next_tokens(spark, root):
    return bigram_model(stream_pairs(spark, root))


SQL_BIGRAMS = f"""{SQL_STREAM},
sides AS (SELECT pos, c, CASE WHEN pos < {SQL_CUT} THEN 'train' ELSE 'test' END AS split FROM stream),
neighbours AS (SELECT split, c AS prev, lead(c) OVER (PARTITION BY split ORDER BY pos) AS next FROM sides),
counts AS (SELECT split, prev, next, count(*) AS n FROM neighbours WHERE next IS NOT NULL GROUP BY ALL),
model AS (SELECT prev, next, n, n / sum(n) OVER (PARTITION BY prev)::DOUBLE AS p FROM counts WHERE split = 'train')"""


@query("bigram_model", f"WITH {SQL_BIGRAMS} SELECT prev, next, n, round(p, 8) AS p FROM model")
def model(spark, root):
    return next_tokens(spark, root).withColumn("p", F.round("p", 8))


@query(
    "bigram_loss",
    f"""WITH {SQL_BIGRAMS}
SELECT c.split, sum(c.n)::BIGINT AS n_pairs, (coalesce(sum(c.n) FILTER (p IS NULL), 0))::BIGINT AS n_uncovered,
  round(sum(-c.n * ln(p)) / sum(c.n) FILTER (p IS NOT NULL), 6) AS loss
FROM counts c LEFT JOIN model m ON m.prev = c.prev AND m.next = c.next GROUP BY c.split""",
)
def loss(spark, root):
    # Read by the model and by its loss.
    counts = materialize(stream_pairs(spark, root), "pair-counts")
    return bigram_loss(counts, bigram_model(counts)).withColumn("loss", F.round("loss", 6))


def _sql_kept(source: str, keys: str, temperature: str, top_p: str) -> str:
    """CTEs ending in ``kept``: the truncated distributions with running totals."""
    return f"""powered AS (SELECT *, pow(p, 1 / ({temperature})::DOUBLE) AS w FROM {source}),
normed AS (SELECT *, w / sum(w) OVER (PARTITION BY {keys}) AS q FROM powered),
placed AS (SELECT *, row_number() OVER o AS rank,
    coalesce(sum(q) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before
  FROM normed WINDOW o AS (PARTITION BY {keys} ORDER BY q DESC, next)),
cut AS (SELECT * FROM placed WHERE before < {top_p} OR rank = 1),
shared AS (SELECT *, q / sum(q) OVER (PARTITION BY {keys}) AS share FROM cut),
kept AS (SELECT *, sum(share) OVER (PARTITION BY {keys} ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM shared)"""


@query(
    "top_p_filter",
    f"""WITH {SQL_BIGRAMS}, {_sql_kept('model', 'prev', str(TEMPERATURE), str(TOP_P))}
SELECT prev, next, rank, round(share, 8) AS p, round(cum, 8) AS cum FROM kept""",
)
def truncated(spark, root):
    kept = top_p_filter(next_tokens(spark, root), ["prev"], temperature=TEMPERATURE, top_p=TOP_P)
    return kept.withColumns({"p": F.round("p", 8), "cum": F.round("cum", 8), "rank": F.col("rank").cast("long")})


SQL_PROMPTS = """prompts AS (SELECT conv_id || ':' || turn AS prompt_id, conv_id, text AS prompt
  FROM conversations WHERE role = 'user')"""
# The last character of a prompt that the vocabulary has.
SQL_KNOWN = "known AS MATERIALIZED (SELECT list(c) AS cs FROM vocab)"
SQL_LAST = "list_filter(string_split(prompt, ''), lambda z: list_contains(cs, z))[-1]"


def started(spark, root):
    """Prompts without characters that the vocabulary lacks, and the character to go on from."""
    prompts = user_prompts(spark, root)
    known = keep_known_chars(F.col("prompt"), document_codes(documents(spark, root)))
    return prompts.withColumn("current", F.substring(known, -1, 1))


def _sql_generated(extra: str, on: str, limit: str, keys: str = "") -> str:
    """CTEs ending in ``drawn (prompt_id, generated)`` from ``started`` and ``kept``."""
    digest = sql_digest(f"'{SEED}'", "g.prompt_id", "g.step")
    return f"""packed AS MATERIALIZED (SELECT {keys}prev, list(next ORDER BY rank) AS toks, list(cum ORDER BY rank) AS cums
  FROM kept GROUP BY {keys}prev),
g AS (SELECT prompt_id, {extra}current, 0 AS step, '' AS generated FROM started
  UNION ALL
  SELECT prompt_id, {extra}token, step + 1, generated || token FROM (
    SELECT g.prompt_id, {extra.replace('adapter', 'g.adapter').replace('max_tokens', 'g.max_tokens')}g.step, g.generated,
      toks[least(len(list_filter(cums, lambda c: c <= {sql_unit(digest)})), len(cums) - 1) + 1] AS token
    FROM g JOIN packed ON packed.prev = g.current{on} WHERE g.step < {limit})),
drawn AS (SELECT prompt_id, arg_max(generated, step) AS generated FROM g GROUP BY prompt_id)"""


@query(
    "generate_prompts",
    f"""WITH RECURSIVE {SQL_BIGRAMS}, {_sql_kept('model', 'prev', str(TEMPERATURE), str(TOP_P))}, {SQL_PROMPTS},
{SQL_KNOWN}, started AS (SELECT prompt_id, {SQL_LAST} AS current FROM prompts, known),
{_sql_generated('', '', str(STEPS))}
SELECT prompt_id, generated FROM drawn""",
)
def generated(spark, root):
    kept = top_p_filter(next_tokens(spark, root), ["prev"], temperature=TEMPERATURE, top_p=TOP_P)
    drawn = generate(started(spark, root), pack_model(kept, ["prev"]), STEPS, STEPS, SEED)
    return drawn.select("prompt_id", F.array_join("generated", "").alias("generated"))


@query(
    "adapter_routing",
    f"""WITH RECURSIVE {SQL_BIGRAMS}, {SQL_PROMPTS},
adapters AS (SELECT * FROM (VALUES {', '.join(str(row) for row in ADAPTERS)}) t(adapter, temperature, top_p, max_tokens)),
routed AS (SELECT prompt_id, prompt, adapter, temperature, top_p, max_tokens FROM prompts
  JOIN adapters ON adapter = CASE WHEN conv_id % 2 = 0 THEN 'lora1' ELSE 'lora2' END),
models AS (SELECT m.*, adapter, temperature, top_p FROM model m, adapters),
{_sql_kept('models', 'adapter, prev', 'temperature', 'top_p')},
{SQL_KNOWN}, started AS (SELECT prompt_id, adapter, max_tokens, {SQL_LAST} AS current FROM routed, known),
{_sql_generated('adapter, max_tokens, ', ' AND packed.adapter = g.adapter', 'g.max_tokens', 'adapter, ')}
SELECT prompt_id, adapter, temperature::DOUBLE AS temperature, top_p::DOUBLE AS top_p, max_tokens, generated
FROM routed JOIN drawn USING (prompt_id)""",
)
def routed(spark, root):
    adapters = spark.createDataFrame(list(ADAPTERS), ADAPTER_SCHEMA)
    name = F.when(F.pmod("conv_id", F.lit(2)) == 0, ADAPTERS[0][0]).otherwise(ADAPTERS[1][0])
    # The text is not needed any more, and prompts are written several times.
    prompts = route_to_adapters(started(spark, root).withColumn("adapter", name), adapters).drop("prompt")
    drawn = generate_from(
        prompts, next_tokens(spark, root), F.col("temperature"), F.col("top_p"), F.col("max_tokens"), MAX_STEPS, SEED
    )
    return drawn.select(
        "prompt_id",
        "adapter",
        "temperature",
        "top_p",
        "max_tokens",
        F.array_join("generated", "").alias("generated"),
    )


def frequent_words():
    """Example of a pluggable function: the five most frequent words of each prompt."""

    def score(prompts):
        results = []
        for prompt in prompts:
            ranked = sorted(Counter(prompt.split()).items(), key=lambda item: (-item[1], item[0]))
            results.append(", ".join(word for word, _ in ranked[:5]))
        return results

    return score


@query(
    "score_prompts",
    f"""WITH {SQL_PROMPTS},
w AS (SELECT prompt_id, unnest(regexp_split_to_array(prompt, '\\s+')) AS word FROM prompts),
c AS (SELECT prompt_id, word, count(*) AS n FROM w WHERE word <> '' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY n DESC, word) AS rank FROM c)
SELECT prompt_id, prompt, (SELECT string_agg(word, ', ' ORDER BY rank) FROM r WHERE rank <= 5 AND r.prompt_id = p.prompt_id) AS generated
FROM prompts p""",
)
def scored(spark, root):
    return score_prompts(user_prompts(spark, root).select("prompt_id", "prompt"), frequent_words)


