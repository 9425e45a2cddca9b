"""Queries on sources, projections, filters and validation."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text, keep_known_chars, naive_strip
from corpusloom.operators.rows import map_rows, reject_reason, to_training_form
from corpusloom.operators.vocabulary import char_codes, char_vocab
from corpusloom.plans.common import (

    SQL_DOC_IDS,
    SQL_PAIRS,
    conversations,
    document_ids,
    documents,
    pairs,
    sql_clean,
    sql_strip,
)
from corpusloom.plans.registry import query
from corpusloom.session import shared_folder
from corpusloom.sources.json_splits import read_json, write_json
from corpusloom.sources.tables import head_slice, load_table, row_slice


@query("load_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def load_documents(spark, root):
    return load_table(spark, root, "documents")


@query("load_split", "SELECT doc_id, text FROM (SELECT *, lang AS split FROM documents) WHERE split = 'en'")
def load_split(spark, root):
    # The language column plays the part of the split name.
    return load_table(spark, root, "documents", ["doc_id", "text"], split="en", split_column="lang")


@query("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(spark, root):
    turns = conversations(spark, root)
    path = os.path.join(shared_folder(spark), f"json-{uuid.uuid4().hex}")
    write_json(turns, path)
    return read_json(spark, path, turns.schema)


@query(
    "head_slice",
    "SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn LIMIT 10000",
)
def head(spark, root):
    return head_slice(conversations(spark, root), ["conv_id", "turn"], 10_000)


@query("row_slice", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 2 OFFSET 1")
def rows_by_position(spark, root):
    return row_slice(load_table(spark, root, "documents", ["doc_id", "text"]), ["doc_id"], 1, 2)


@query("project_text", "SELECT text FROM documents")
def project_text(spark, root):
    return load_table(spark, root, "documents", ["text"])


@query("drop_columns", "SELECT doc_id, text, lang FROM documents")
def drop_columns(spark, root):
    return map_rows(load_table(spark, root, "documents"), None, ["source", "n_chars"])


@query(
    "map_add_columns",
    "SELECT doc_id, lang, source, n_chars, text, length(text) AS text_chars, "
    "lang || ':' || source AS origin FROM documents",
)
def map_add_columns(spark, root):
    return map_rows(
        load_table(spark, root, "documents"),
        {
            "text_chars": F.char_length("text").cast("long"),
            "origin": F.concat_ws(":", "lang", "source"),
        },
    )


def _turn_list(messages):
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")


@query(
    "schema_dispatch",
    f"""WITH {SQL_PAIRS}
SELECT 'converted' AS form, 'user=' || ({sql_clean("instruction")}) || '|assistant=' || ({sql_clean("output")}) AS content
FROM pairs
UNION ALL SELECT 'passed' AS form, text AS content FROM conversations""",
)
def schema_dispatch(spark, root):
    converted = to_training_form(pairs(spark, root).drop("conv_id", "turn"))
    passed = to_training_form(conversations(spark, root))
    return converted.select(F.lit("converted").alias("form"), _turn_list(F.col("messages")).alias("content")).unionByName(
        passed.select(F.lit("passed").alias("form"), F.col("text").alias("content"))
    )


# Dirty values that the tables lack are derived from every turn.
DIRTY_FORMS = {
    "padded": lambda t: F.concat(F.lit(" \u00a0\t"), t, F.lit("\u3000\n ")),
    "missing": lambda t: F.lit(None).cast("string"),
    "nan": lambda t: F.lit(" nan "),
    "none": lambda t: F.lit("NONE"),
    "blank": lambda t: F.lit("\u00a0\u3000"),
    "inner": lambda t: F.concat(t, F.lit(" none")),
}
SQL_DIRTY = """dirty AS (
  SELECT conv_id, turn, 'padded' AS form, ' ' || chr(160) || chr(9) || text || chr(12288) || chr(10) || ' ' AS value FROM conversations
  UNION ALL SELECT conv_id, turn, 'missing', NULL FROM conversations
  UNION ALL SELECT conv_id, turn, 'nan', ' nan ' FROM conversations
  UNION ALL SELECT conv_id, turn, 'none', 'NONE' FROM conversations
  UNION ALL SELECT conv_id, turn, 'blank', chr(160) || chr(12288) FROM conversations
  UNION ALL SELECT conv_id, turn, 'inner', text || ' none' FROM conversations)"""


def dirty_turns(spark, root):
    forms = [F.struct(F.lit(n).alias("form"), f(F.col("text")).alias("value")) for n, f in DIRTY_FORMS.items()]
    return (
        conversations(spark, root)
        .select("conv_id", "turn", F.explode(F.array(*forms)).alias("d"))
        .select("conv_id", "turn", "d.form", "d.value")
    )


@query(
    "clean_text",
    f"WITH {SQL_DIRTY} SELECT conv_id, turn, form, {sql_clean('value')} AS cleaned FROM dirty",
)
def clean(spark, root):
    return dirty_turns(spark, root).select("conv_id", "turn", "form", clean_text(F.col("value")).alias("cleaned"))


@query(
    "naive_strip",
    f"WITH {SQL_DIRTY} SELECT conv_id, turn, form, coalesce({sql_strip('value')}, 'None') AS stripped FROM dirty",
)
def naive(spark, root):
    return dirty_turns(spark, root).select("conv_id", "turn", "form", naive_strip(F.col("value")).alias("stripped"))


@query(
    "reject_reasons",
    f"""WITH {SQL_DIRTY}, fields AS (
  SELECT d.conv_id, d.turn, d.form, d.value AS instruction, c.text AS output
  FROM dirty d JOIN conversations c ON c.conv_id = d.conv_id AND c.turn = d.turn
  UNION ALL
  SELECT d.conv_id, d.turn, d.form || '_answer', c.text, d.value
  FROM dirty d JOIN conversations c ON c.conv_id = d.conv_id AND c.turn = d.turn)
SELECT conv_id, turn, form,
  CASE WHEN ({sql_clean('instruction')}) = '' THEN 'empty instruction'
       WHEN ({sql_clean('output')}) = '' THEN 'empty output' ELSE 'good' END AS reason
FROM fields""",
)
def reject_reasons(spark, root):
    forms = []
    for name, dirty in DIRTY_FORMS.items():
        text, value = F.col("text"), dirty(F.col("text"))
        for form, question, answer in ((name, value, text), (f"{name}_answer", text, value)):
            forms.append(
                F.struct(F.lit(form).alias("form"), question.alias("instruction"), answer.alias("output"))
            )
    fields = conversations(spark, root).select("conv_id", "turn", F.inline(F.array(*forms)))
    return fields.select(
        "conv_id",
        "turn",
        "form",
        F.coalesce(reject_reason("instruction", "output"), F.lit("good")).alias("reason"),
    )


@query(
    "min_len_filter",
    f"WITH {SQL_DOC_IDS} SELECT doc_id, len(ids)::BIGINT AS n_tokens FROM enc WHERE len(ids) >= 1025",
)
def min_len_filter(spark, root):
    kept = document_ids(spark, root, block=1024)
    return kept.select("doc_id", F.size("ids").cast("long").alias("n_tokens"))


@query(
    "oov_filter",
    """WITH known AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM conversations),
ch AS (SELECT doc_id, unnest(string_split(text, '')) AS c,
              generate_subscripts(string_split(text, ''), 1) AS i FROM documents)
SELECT d.doc_id, coalesce(k.text, '') AS text FROM documents d LEFT JOIN
  (SELECT doc_id, string_agg(c, '' ORDER BY i) AS text FROM ch SEMI JOIN known USING (c) GROUP BY doc_id) k USING (doc_id)""",
)
def oov_filter(spark, root):
    known = char_codes(char_vocab(conversations(spark, root), "text"))
    return documents(spark, root).select("doc_id", keep_known_chars(F.col("text"), known).alias("text"))


