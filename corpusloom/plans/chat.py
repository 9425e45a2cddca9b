"""Queries on chat messages and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.chat import (
    ASSISTANT_SYSTEM,
    KEYWORD_QUESTION,
    SUMMARY_FIVE_INSTRUCTION,
    SUMMARY_INSTRUCTION,
    SUMMARY_KEYWORD_INSTRUCTION,
    SUMMARY_PAIR_INSTRUCTION,
    instruction_messages,
    prompt_forms,
    raw_instruction_messages,
    render,
    summary_pair,
    text2sql_prompt,
    text2sql_text,
)
from corpusloom.functions.text import clean_text
from corpusloom.operators.keywords import top_keywords
from corpusloom.operators.rows import split_rejects
from corpusloom.operators.splits import sample_preview
from corpusloom.plans.common import (
    SQL_PAIRS,
    SQL_RENDERED,
    SYSTEM_TEXT,
    documents,
    pairs,
    sql_clean,
    sql_digest,
    sql_strip,
    sql_words,
)
from corpusloom.plans.registry import query

EOS = "</s>"
NL = "chr(10)"


def _inline_turns(df, messages, *keys):
    return df.select(*keys, F.posexplode(messages).alias("pos", "m")).select(
        *keys, "pos", "m.role", "m.content"
    )


def _sql_literal(text: str) -> str:
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


@query(
    "chat_training_text",
    f"""WITH {SQL_RENDERED} SELECT r.conv_id, r.turn, r.text, length(r.text) AS n_chars
FROM rendered r JOIN pairs p USING (conv_id, turn)
WHERE ({sql_clean("p.instruction")}) <> '' AND ({sql_clean("p.output")}) <> ''""",
)
def chat_training_text(spark, root):
    good, _ = split_rejects(pairs(spark, root), "instruction", "output")
    built = instruction_messages(F.col("instruction"), F.col("output"), system=SYSTEM_TEXT)
    return good.select("conv_id", "turn", render(built).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


# Some rows carry an extra input: their own question in brackets, or blanks.
def extra_input():
    bracketed = F.concat(F.lit(" ["), F.col("instruction"), F.lit("] "))
    return F.when(F.pmod("turn", F.lit(4)) == 0, bracketed).otherwise(" ")


@query(
    "sft_messages",
    f"""WITH {SQL_PAIRS}, cleaned AS (
  SELECT conv_id, turn, ({sql_clean("instruction")}) AS q, ({sql_clean("output")}) AS a,
    CASE WHEN turn % 4 = 0 THEN '[' || instruction || ']' ELSE '' END AS e FROM pairs)
SELECT conv_id, turn, 0 AS pos, 'system' AS role, '{SYSTEM_TEXT}' AS content FROM cleaned
UNION ALL SELECT conv_id, turn, 1, 'user', CASE WHEN e <> '' THEN q || {NL} || {NL} || '입력:' || {NL} || e ELSE q END FROM cleaned
UNION ALL SELECT conv_id, turn, 2, 'assistant', a FROM cleaned""",
)
def sft_messages(spark, root):
    built = instruction_messages(F.col("instruction"), F.col("output"), extra_input(), f"  {SYSTEM_TEXT} ")
    return _inline_turns(pairs(spark, root), built, "conv_id", "turn")


@query(
    "sft_messages_raw",
    f"""WITH {SQL_PAIRS}
SELECT conv_id, turn, 0 AS pos, 'system' AS role, {_sql_literal(ASSISTANT_SYSTEM)} AS content FROM pairs
UNION ALL SELECT conv_id, turn, 1, 'user', instruction FROM pairs
UNION ALL SELECT conv_id, turn, 2, 'assistant', output FROM pairs""",
)
def sft_messages_raw(spark, root):
    built = raw_instruction_messages(F.col("instruction"), F.col("output"))
    return _inline_turns(pairs(spark, root), built, "conv_id", "turn")


SQL_KEYWORDS = f"""tf AS (SELECT doc_id, word, count(*) AS tf
  FROM (SELECT doc_id, unnest({sql_words('text')}) AS word FROM documents) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
scored AS (SELECT doc_id, word, round(tf * ln((SELECT count(*) FROM documents)::DOUBLE / df), 6) AS score
  FROM tf JOIN df USING (word)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS rank FROM scored),
keywords AS (SELECT doc_id, rank, word, score FROM ranked WHERE rank <= 5)"""


@query("top_keywords", f"WITH {SQL_KEYWORDS} SELECT doc_id, rank::INTEGER AS rank, word, score FROM keywords")
def keywords(spark, root):
    return top_keywords(documents(spark, root), "doc_id", "text")


@query(
    "summary_pairs",
    f"""WITH {SQL_KEYWORDS},
listed AS (SELECT doc_id, string_agg(word, ', ' ORDER BY rank) AS kw FROM keywords GROUP BY doc_id)
SELECT doc_id, {_sql_literal(SUMMARY_PAIR_INSTRUCTION)} || text AS user_content,
  '한국어 요약:' || split_part(text, '.', 1) || {NL} || '키워드:' || coalesce(kw, '') AS assistant_content
FROM documents LEFT JOIN listed USING (doc_id)""",
)
def summary_pairs(spark, root):
    docs = documents(spark, root)
    listed = (
        top_keywords(docs, "doc_id", "text")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("k"))
        .select("doc_id", F.array_join(F.col("k.word"), ", ").alias("kw"))
    )
    summary = F.substring_index("text", ".", 1)
    built = summary_pair(F.col("text"), summary, F.coalesce("kw", F.lit("")))
    return docs.join(listed, "doc_id", "left").select(
        "doc_id", built[0]["content"].alias("user_content"), built[1]["content"].alias("assistant_content")
    )


def _sql_turns(*turns: tuple[str, str]) -> str:
    return " || ".join(
        f"'<start_of_turn>{role}' || {NL} || {content} || '<end_of_turn>' || {NL}" for role, content in turns
    )


_SQL_FORMS = {
    "plain": (("user", "instruction"),),
    "with_instruction": (("user", f"{_sql_literal(SUMMARY_FIVE_INSTRUCTION)} || instruction"),),
    "follow_up": (
        ("user", f"{_sql_literal(SUMMARY_INSTRUCTION)} || instruction"),
        ("model", "output"),
        ("user", f"'{KEYWORD_QUESTION}'"),
    ),
    "empty_reply": (
        ("user", "instruction"),
        ("model", "output"),
        ("user", f"'{KEYWORD_QUESTION}'"),
        ("model", "''"),
    ),
    "short_prefill": (("user", "instruction"), ("model", f"'한국어 요약:' || {NL}")),
    "prefilled": (
        ("user", f"{_sql_literal(SUMMARY_KEYWORD_INSTRUCTION)} || instruction"),
        ("model", f"'한국어 요약:' || {NL} || '키워드:'"),
    ),
}


@query(
    "prompt_variants",
    f"WITH {SQL_PAIRS} "
    + " UNION ALL ".join(
        f"SELECT conv_id, turn, '{name}' AS form, {_sql_turns(*turns)} AS prompt FROM pairs"
        for name, turns in _SQL_FORMS.items()
    ),
)
def prompt_variants(spark, root):
    forms = [
        F.struct(F.lit(name).alias("form"), render(built).alias("prompt"))
        for name, built in prompt_forms(F.col("instruction"), F.col("output")).items()
    ]
    return pairs(spark, root).select("conv_id", "turn", F.inline(F.array(*forms)))


# A schema text for every second user turn, none or a null for the others.
def schema_text():
    return F.when(F.pmod("turn", F.lit(4)) == 0, F.lit(" CREATE TABLE t (a int) ")).when(
        F.pmod("conv_id", F.lit(2)) == 0, F.lit("")
    )


@query(
    "text2sql_text",
    f"""WITH {SQL_PAIRS}, shaped AS (
  SELECT *, CASE WHEN turn % 4 = 0 THEN 'CREATE TABLE t (a int)' WHEN conv_id % 2 = 0 THEN '' END AS s FROM pairs),
tidy AS (SELECT conv_id, turn, s, instruction, ({sql_clean("instruction")}) AS q, ({sql_clean("output")}) AS a,
  {sql_strip("instruction")} AS nq, {sql_strip("output")} AS na FROM shaped)
SELECT conv_id, turn,
  '<start_of_turn>user' || {NL} || q || CASE WHEN coalesce(s, '') <> '' THEN {NL} || {NL} || '[SCHEMA]' || {NL} || s ELSE '' END
    || '<end_of_turn>' || {NL} || '<start_of_turn>model' || {NL} || a || '<end_of_turn>' AS text,
  '<start_of_turn>user' || {NL} || nq || CASE WHEN coalesce(s, 'None') <> '' THEN {NL} || {NL} || '[SCHEMA]' || {NL} || coalesce(s, 'None') ELSE '' END
    || '<end_of_turn>' || {NL} || '<start_of_turn>model' || {NL} || na || '<end_of_turn>' AS compat_text,
  'Task:' || instruction || {NL} || 'SQL table: ' || coalesce(s, '') || {NL} || 'SQL query:' AS prompt
FROM tidy""",
)
def text2sql(spark, root):
    question, sql, schema = F.col("instruction"), F.col("output"), schema_text()
    return pairs(spark, root).select(
        "conv_id",
        "turn",
        text2sql_text(question, schema, sql).alias("text"),
        text2sql_text(question, schema, sql, compat=True).alias("compat_text"),
        text2sql_prompt(question, clean_text(schema)).alias("prompt"),
    )


@query(
    "render_chat",
    f"WITH {SQL_RENDERED} SELECT conv_id, turn, text || '{EOS}' AS text FROM rendered",
)
def render_chat(spark, root):
    built = instruction_messages(F.col("instruction"), F.col("output"), system=SYSTEM_TEXT)
    return pairs(spark, root).select("conv_id", "turn", render(built, eos=EOS).alias("text"))


@query(
    "render_modes",
    f"""WITH {SQL_RENDERED}
SELECT conv_id, turn, 'none' AS ending, text FROM rendered
UNION ALL SELECT conv_id, turn, 'generation', text || '<start_of_turn>model' || {NL} FROM rendered
UNION ALL SELECT conv_id, turn, 'continue', substr(text, 1, length(text) - length('<end_of_turn>') - 1) FROM rendered""",
)
def render_modes(spark, root):
    built = instruction_messages(F.col("instruction"), F.col("output"), system=SYSTEM_TEXT)
    modes = [
        F.struct(F.lit(m).alias("ending"), render(built, ending=m).alias("text"))
        for m in ("none", "generation", "continue")
    ]
    return pairs(spark, root).select("conv_id", "turn", F.inline(F.array(*modes)))


@query(
    "sample_preview",
    f"""WITH {SQL_RENDERED} SELECT conv_id, turn, text AS preview FROM rendered
ORDER BY {sql_digest("'42'", "conv_id", "turn")}, conv_id, turn LIMIT 2""",
)
def preview(spark, root):
    built = instruction_messages(F.col("instruction"), F.col("output"), system=SYSTEM_TEXT)
    rows = pairs(spark, root).select("conv_id", "turn", built.alias("messages"))
    return sample_preview(rows, ["conv_id", "turn"], 2)
