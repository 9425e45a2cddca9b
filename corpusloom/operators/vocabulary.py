"""Character vocabularies and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import chars, decode_chars, encode_chars, words
from corpusloom.session import collect_bounded

# Fixed value: number of code points Unicode can ever assign.
UNICODE_POINTS = 1_114_112


def char_vocab(df: DataFrame, text: str) -> DataFrame:
    """(token, id): all characters of the corpus in code point order, ids from 0.

    Duplicates are dropped before the shuffle, so each task sends at most one
    row per character, and the numbering window sees only the distinct ones.
    """
    distinct = df.select(F.explode(chars(F.col(text))).alias("token")).distinct()
    position = F.row_number().over(Window.orderBy("token")) - 1
    return distinct.select("token", position.cast("int").alias("id"))


def char_codes(vocab: DataFrame) -> dict[str, int]:
    """A character vocabulary as a map; Unicode bounds its size."""
    return {r["token"]: r["id"] for r in collect_bounded(vocab, UNICODE_POINTS, "character vocabulary")}


def code_tokens(codes: dict[str, int]) -> list[str]:
    """The inverse of a dense token-to-id map."""
    return [token for token, _ in sorted(codes.items(), key=lambda item: item[1])]


def word_freq(df: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each pre-token occurs in the corpus."""
    return df.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


def roundtrip_mismatch(df: DataFrame, text: str, codes: dict[str, int]) -> DataFrame:
    """One row: texts in total, and texts that encoding and decoding does not give back."""
    again = decode_chars(encode_chars(F.col(text), codes), code_tokens(codes))
    return df.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.coalesce(F.sum((again != F.col(text)).cast("long")), F.lit(0)).alias("n_mismatch"),
    )
