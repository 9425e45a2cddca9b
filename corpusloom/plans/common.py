"""Inputs shared by the queries, and the same inputs as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.chat import instruction_messages, render
from corpusloom.functions.text import encode_chars
from corpusloom.operators.positions import whole_div
from corpusloom.operators.rows import min_length, reply_pairs
from corpusloom.operators.vocabulary import char_codes, char_vocab
from corpusloom.session import spread
from corpusloom.sources.tables import load_table

SYSTEM_TEXT = "You are a helpful assistant."
BLOCK = 8
VECTOR_DIM = 64


def documents(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    return load_table(spark, root, "documents", list(columns or ("doc_id", "text")))


def document_codes(docs: DataFrame) -> dict[str, int]:
    return char_codes(char_vocab(docs, "text"))


def document_ids(spark: SparkSession, root: str, block: int | None = None, first: int | None = None) -> DataFrame:
    """(doc_id, ids): every document as character ids, or those with room for one block.

    A text has as many ids as characters, so short ones go before encoding, and
    where only the ``first`` ids are used the text is cut before encoding.
    """
    docs = documents(spark, root)
    kept = docs if block is None else min_length(docs, F.char_length("text"), block)
    text = F.col("text") if first is None else F.substring("text", 1, first)
    return spread(kept.select("doc_id", text.alias("text")), "doc_id").select(
        "doc_id", encode_chars(F.col("text"), document_codes(docs)).alias("ids")
    )


def conversations(spark: SparkSession, root: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    return load_table(spark, root, "conversations", columns)


def pairs(spark: SparkSession, root: str) -> DataFrame:
    return reply_pairs(conversations(spark, root))


def rendered_pairs(spark: SparkSession, root: str) -> DataFrame:
    """(conv_id, turn, text): each answered question as chat training text."""
    built = instruction_messages(F.col("instruction"), F.col("output"), system=SYSTEM_TEXT)
    return pairs(spark, root).select("conv_id", "turn", render(built).alias("text"))


def chat_codes(texts: DataFrame) -> dict[str, int]:
    return char_codes(char_vocab(texts, "text"))


def user_prompts(spark: SparkSession, root: str) -> DataFrame:
    """(prompt_id, conv_id, prompt): every user turn; the id is "conversation:turn"."""
    users = conversations(spark, root).where(F.col("role") == "user")
    return users.select(F.concat_ws(":", "conv_id", "turn").alias("prompt_id"), "conv_id", F.col("text").alias("prompt"))


def vectors(spark: SparkSession, root: str) -> DataFrame:
    """(seq, pos, embedding, label): vectors in sequences of one block each."""
    return load_table(spark, root, "embeddings", ["vec_id", "embedding", "label"]).select(
        "vec_id",
        whole_div(F.col("vec_id"), BLOCK).alias("seq"),
        F.pmod("vec_id", F.lit(BLOCK)).alias("pos"),
        "embedding",
        "label",
    )


def joined(values: Column, separator: str = " ") -> Column:
    """An array as text, so results compare as plain values."""
    return F.array_join(values.cast("array<string>"), separator)


def joined_doubles(values: Column, digits: int = 5) -> Column:
    # Scaled to integers: engines print doubles differently.
    return joined(F.transform(values, lambda v: F.round(v * 10**digits).cast("long")))


# ---- the same inputs for the SQL side -------------------------------------

SQL_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
SQL_WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}]+|[^\p{L}\p{M}\p{Nd}\p{Pc}\s\x{1c}-\x{1f}\x{85}\p{Z}]+"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_clean(column: str) -> str:
    s = sql_strip(column)
    return f"CASE WHEN {column} IS NULL OR lower({s}) IN ('', 'none', 'nan') THEN '' ELSE {s} END"


def sql_words(column: str) -> str:
    return f"regexp_extract_all({column}, '{SQL_WORD}')"


SQL_PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS instruction, next_text AS output
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

SQL_RENDERED = f"""{SQL_PAIRS},
rendered AS (
  SELECT conv_id, turn,
         '<start_of_turn>system' || chr(10) || '{SYSTEM_TEXT}' || '<end_of_turn>' || chr(10)
      || '<start_of_turn>user' || chr(10) || ({sql_clean("instruction")}) || '<end_of_turn>' || chr(10)
      || '<start_of_turn>model' || chr(10) || ({sql_clean("output")}) || '<end_of_turn>' || chr(10) AS text
  FROM pairs)"""


def sql_char_ids(table: str, keys: str) -> str:
    """CTEs ch (keys, i, c), vocab (c, id) and enc (keys, ids) over ``table.text``."""
    return f"""ch AS (SELECT {keys}, unnest(string_split(text, '')) AS c,
                     generate_subscripts(string_split(text, ''), 1) AS i FROM {table}),
vocab AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS id FROM (SELECT DISTINCT c FROM ch)),
enc AS (SELECT {keys}, list(id ORDER BY i) AS ids FROM ch JOIN vocab USING (c) GROUP BY {keys})"""


SQL_DOC_IDS = sql_char_ids("documents", "doc_id")
SQL_CHAT_IDS = f"{SQL_RENDERED}, {sql_char_ids('rendered', 'conv_id, turn')}"

# The character stream: every token with its position over all documents.
SQL_STREAM = f"""{SQL_DOC_IDS},
lens AS (SELECT doc_id, len(ids) AS n FROM enc),
offs AS (SELECT doc_id, n, sum(n) OVER (ORDER BY doc_id) - n AS off FROM lens),
stream AS (SELECT doc_id, (off + i - 1)::BIGINT AS pos, c, id FROM ch JOIN vocab USING (c) JOIN offs USING (doc_id))"""
SQL_CUT = "(SELECT floor(0.9 * count(*))::BIGINT FROM stream)"


def sql_digest(*parts: str) -> str:
    return "md5(" + " || ':' || ".join(parts) + ")"


def sql_unit(digest: str) -> str:
    return f"(('0x' || substr({digest}, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def sql_hash_integer(digest: str) -> str:
    return f"('0x' || substr({digest}, 1, 15))::BIGINT"
