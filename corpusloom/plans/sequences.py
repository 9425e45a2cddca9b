"""Queries on token sequences, labels, blocks and padding."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from corpusloom.functions.arrays import (
    all_inputs,
    all_targets,
    attention_mask,
    block_input,
    block_target,
    find_pattern,
    last_tokens,
    response_labels,
    strip_prompt,
    token_types,
    truncate,
)
from corpusloom.functions.chat import TURNS
from corpusloom.functions.text import encode_chars
from corpusloom.operators.sequences import (
    context_rows,
    pad_batches,
    random_blocks,
    stream_cut,
    stream_length,
    stream_offsets,
    stream_split,
    token_stream,
)
from corpusloom.operators.splits import seq_batches
from corpusloom.plans.common import (
    BLOCK,
    SQL_CHAT_IDS,
    SQL_CUT,
    SQL_DOC_IDS,
    SQL_STREAM,
    chat_codes,
    document_codes,
    document_ids,
    documents,
    joined,
    rendered_pairs,
    sql_digest,
    sql_hash_integer,
)
from corpusloom.plans.registry import query
from corpusloom.session import spread

MAX_LENGTH = 512
CHUNK = 1024
SAMPLES = 32
BATCH = 8
MARKER = TURNS.reply_opening


def chat_ids(spark, root):
    """(conv_id, turn, ids) of the rendered pairs, and the ids of the response marker."""
    texts = rendered_pairs(spark, root)
    codes = chat_codes(texts)
    return texts.select("conv_id", "turn", encode_chars(F.col("text"), codes).alias("ids")), [
        codes[c] for c in MARKER
    ]


# Everything up to the end of the first marker, by text position.
SQL_MARKER = f"'{TURNS.start}model' || chr(10)"
SQL_START = f"(instr(r.text, {SQL_MARKER}) - 1)"
SQL_MASKED = f"({SQL_START} + length({SQL_MARKER}))"
SQL_LABELS = f"list_transform(e.ids, lambda x, i: CASE WHEN i <= {SQL_MASKED} THEN -100 ELSE x END)"
SQL_CHAT_JOIN = "enc e JOIN rendered r USING (conv_id, turn)"


@query(
    "find_pattern",
    f"WITH {SQL_CHAT_IDS} SELECT conv_id, turn, {SQL_START}::BIGINT AS first_start, -1 AS absent, 0 AS at_start "
    f"FROM {SQL_CHAT_JOIN}",
)
def pattern(spark, root):
    rows, marker = chat_ids(spark, root)
    ids = F.col("ids")
    return rows.select(
        "conv_id",
        "turn",
        find_pattern(ids, marker).cast("long").alias("first_start"),
        find_pattern(ids, [-1, *marker]).alias("absent"),
        find_pattern(ids, marker[:1]).alias("at_start"),
    )


@query(
    "response_labels",
    f"WITH {SQL_CHAT_IDS} SELECT conv_id, turn, array_to_string({SQL_LABELS}, ' ') AS labels FROM {SQL_CHAT_JOIN}",
)
def labels(spark, root):
    rows, marker = chat_ids(spark, root)
    return rows.select("conv_id", "turn", joined(response_labels(F.col("ids"), marker)).alias("labels"))


@query(
    "full_labels",
    f"WITH {SQL_DOC_IDS} SELECT doc_id, array_to_string(ids, ' ') AS input_ids, array_to_string(ids, ' ') AS labels FROM enc",
)
def full_labels(spark, root):
    rows = document_ids(spark, root).withColumn("labels", F.col("ids"))
    return rows.select("doc_id", joined(F.col("ids")).alias("input_ids"), joined(F.col("labels")).alias("labels"))


@query(
    "aux_arrays",
    """SELECT doc_id, trim(repeat('1 ', length(text))) AS attention_mask,
  trim(repeat('0 ', length(text))) AS token_type_ids FROM documents""",
)
def aux_arrays(spark, root):
    ids = F.col("ids")
    return document_ids(spark, root).select(
        "doc_id",
        joined(attention_mask(ids)).alias("attention_mask"),
        joined(token_types(ids)).alias("token_type_ids"),
    )


@query(
    "truncate",
    f"WITH {SQL_DOC_IDS} SELECT doc_id, array_to_string(ids[1:{MAX_LENGTH}], ' ') AS input_ids, "
    f"least(len(ids), {MAX_LENGTH})::BIGINT AS n FROM enc",
)
def truncated(spark, root):
    rows = document_ids(spark, root, first=MAX_LENGTH).select("doc_id", truncate(F.col("ids"), MAX_LENGTH).alias("ids"))
    return rows.select("doc_id", joined(F.col("ids")).alias("input_ids"), F.size("ids").cast("long").alias("n"))


@query(
    "shift_pairs",
    f"""WITH {SQL_DOC_IDS} SELECT doc_id, array_to_string(ids[1:len(ids) - 1], ' ') AS x,
  array_to_string(ids[2:], ' ') AS y FROM enc WHERE len(ids) > 1""",
)
def shift_pairs(spark, root):
    ids = F.col("ids")
    rows = document_ids(spark, root, block=1)
    return rows.select("doc_id", joined(all_inputs(ids)).alias("x"), joined(all_targets(ids)).alias("y"))


@query(
    "context_targets",
    f"""WITH {SQL_DOC_IDS}, t AS (SELECT unnest(range(0, {BLOCK})) AS t)
SELECT doc_id, t, array_to_string(ids[1:t + 1], ' ') AS context, ids[t + 2] AS target
FROM enc, t WHERE t + 2 <= len(ids)""",
)
def contexts(spark, root):
    rows = context_rows(document_ids(spark, root, first=BLOCK + 1), ["doc_id"], "ids", BLOCK)
    return rows.select(
        "doc_id",
        F.col("t").cast("long").alias("t"),
        joined(F.col("context")).alias("context"),
        F.col("target").cast("long").alias("target"),
    )


def document_offsets(docs):
    return stream_offsets(docs, ["doc_id"], F.char_length("text"))


@query(
    "token_stream",
    f"""WITH {SQL_STREAM} SELECT pos // {CHUNK} AS chunk_id, min(pos) AS start_pos, count(*) AS n_tokens,
  string_agg(id::VARCHAR, ' ' ORDER BY pos) AS tokens FROM stream GROUP BY 1""",
)
def stream(spark, root):
    docs = documents(spark, root)
    ids = encode_chars(F.col("text"), document_codes(docs))
    chunks = token_stream(docs, ids, document_offsets(docs), ["doc_id"], CHUNK)
    return chunks.select(
        "chunk_id", "start_pos", F.size("tokens").cast("long").alias("n_tokens"), joined(F.col("tokens")).alias("tokens")
    )


@query(
    "stream_split",
    f"""WITH {SQL_STREAM}, parts AS (SELECT doc_id, id, pos,
    CASE WHEN pos < {SQL_CUT} THEN 'train' ELSE 'test' END AS split FROM stream)
SELECT doc_id, split, count(*) AS n_tokens, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS tokens
FROM parts GROUP BY doc_id, split""",
)
def split_stream(spark, root):
    docs = documents(spark, root)
    offsets = document_offsets(docs)
    cut = stream_cut(offsets, ["doc_id"], math.floor(0.9 * stream_length(offsets)))
    rows = stream_split(spread(docs, "doc_id"), encode_chars(F.col("text"), document_codes(docs)), cut)
    return rows.select(
        "doc_id", "split", F.size("tokens").cast("long").alias("n_tokens"), joined(F.col("tokens")).alias("tokens")
    )


@query(
    "first_blocks",
    f"""WITH {SQL_DOC_IDS} SELECT doc_id, array_to_string(ids[1:{BLOCK}], ' ') AS x,
  array_to_string(ids[2:{BLOCK + 1}], ' ') AS y FROM enc WHERE len(ids) >= {BLOCK + 1}""",
)
def first_blocks(spark, root):
    ids = F.col("ids")
    rows = document_ids(spark, root, block=BLOCK, first=BLOCK + 1)
    return rows.select(
        "doc_id", joined(block_input(ids, BLOCK)).alias("x"), joined(block_target(ids, BLOCK)).alias("y")
    )


@query(
    "random_blocks",
    f"""WITH {SQL_STREAM}, starts AS (SELECT sample_id,
  {sql_hash_integer(sql_digest("'42'", "sample_id"))} % ({SQL_CUT} - {BLOCK}) AS start
  FROM (SELECT unnest(range(0, {SAMPLES})) AS sample_id))
SELECT sample_id, start,
  string_agg(id::VARCHAR, ' ' ORDER BY pos) FILTER (pos < start + {BLOCK}) AS x,
  string_agg(id::VARCHAR, ' ' ORDER BY pos) FILTER (pos > start) AS y
FROM starts JOIN stream ON pos >= start AND pos <= start + {BLOCK} GROUP BY sample_id, start""",
)
def blocks(spark, root):
    docs = documents(spark, root)
    offsets = document_offsets(docs)
    n_train = math.floor(0.9 * stream_length(offsets))
    ids = encode_chars(F.col("text"), document_codes(docs))
    drawn = random_blocks(spark, docs, ids, offsets, ["doc_id"], SAMPLES, BLOCK, high=n_train)
    return drawn.select("sample_id", "start", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


@query(
    "strip_prompt",
    f"""WITH {SQL_CHAT_IDS} SELECT conv_id, turn, array_to_string(e.ids[{SQL_MASKED} + 1:], ' ') AS reply,
  array_to_string(e.ids[greatest(len(e.ids) - {BLOCK} + 1, 1):], ' ') AS last_block FROM {SQL_CHAT_JOIN}""",
)
def prompt_stripped(spark, root):
    rows, marker = chat_ids(spark, root)
    ids = F.col("ids")
    prompt_length = find_pattern(ids, marker) + len(marker)
    return rows.select(
        "conv_id",
        "turn",
        joined(strip_prompt(ids, prompt_length)).alias("reply"),
        joined(last_tokens(ids, BLOCK)).alias("last_block"),
    )


def _sql_padded(values: str, fill: int) -> str:
    return (
        f"array_to_string(list_concat({values}, list_transform(range(0, longest - len(ids)), lambda i: {fill})), ' ')"
    )


@query(
    "pad_batches",
    f"""WITH {SQL_CHAT_IDS}, numbered AS (
  SELECT conv_id, turn, e.ids, {SQL_LABELS} AS labels,
    (row_number() OVER (ORDER BY conv_id, turn) - 1) // {BATCH} AS batch_id FROM {SQL_CHAT_JOIN}),
sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM numbered)
SELECT conv_id, turn, batch_id, {_sql_padded('ids', 0)} AS input_ids, {_sql_padded('labels', -100)} AS labels,
  {_sql_padded('list_transform(ids, lambda i: 1)', 0)} AS attention_mask,
  {_sql_padded('list_transform(ids, lambda i: 0)', 0)} AS token_type_ids FROM sized""",
)
def padded(spark, root):
    """Batch numbers come from keys, the longest row from lengths; ids are cut and padded where they are."""
    rows, marker = chat_ids(spark, root)
    keys = ["conv_id", "turn"]
    texts = rendered_pairs(spark, root)
    batches = seq_batches(texts.select(*keys, F.char_length("text").alias("length")), keys, BATCH)
    longest = batches.groupBy("batch_id").agg(F.max("length").alias("longest"))
    sized = batches.select(*keys, "batch_id").join(longest, "batch_id")
    ids = F.col("ids")
    prepared = rows.join(sized, keys).select(
        *keys,
        "batch_id",
        "longest",
        ids.alias("input_ids"),
        response_labels(ids, marker).alias("labels"),
        attention_mask(ids).alias("attention_mask"),
        token_types(ids).alias("token_type_ids"),
    )
    done = pad_batches(prepared, longest="longest")
    arrays = ("input_ids", "labels", "attention_mask", "token_type_ids")
    return done.select("conv_id", "turn", "batch_id", *[joined(F.col(a)).alias(a) for a in arrays])
