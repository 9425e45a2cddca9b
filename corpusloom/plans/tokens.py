"""Queries on vocabularies and tokenization."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from corpusloom.functions.text import charset, decode_chars, encode_chars, words
from corpusloom.operators import bpe
from corpusloom.operators.bpe import BpeTokenizer
from corpusloom.operators.bpe_training import train_bpe
from corpusloom.operators.vocabulary import (
    char_vocab,
    code_tokens,
    roundtrip_mismatch,
    vocab_size,
    word_freq,
)
from corpusloom.plans.common import SQL_DOC_IDS, document_codes, document_ids, documents, joined, sql_words
from corpusloom.plans.registry import query
from corpusloom.session import shared_folder, spread
from corpusloom.sources.tokenizer_store import load_tokenizer, read_tables, save_tokenizer, stored_tokenizer



def trained_tokenizer(spark, root) -> BpeTokenizer:
    """The tokenizer of this table with its full vocabulary; trained once for the same rows."""
    folder = f"{shared_folder(spark)}/tokenizers"
    return stored_tokenizer(spark, folder, documents(spark, root, "text"), lambda docs: train_bpe(word_freq(docs, "text")), f"bpe-{bpe.VOCAB_SIZE}")


def encoded_documents(spark, root, tokenizer):
    """(doc_id, text, ids) of all documents."""
    return spread(documents(spark, root), "doc_id").select("doc_id", "text", bpe.encode(F.col("text"), tokenizer).alias("ids"))


@query(
    "doc_charset",
    """SELECT doc_id, (SELECT string_agg(c, '' ORDER BY c) FROM
  (SELECT DISTINCT unnest(string_split(text, '')) AS c)) AS chars FROM documents""",
)
def doc_charset(spark, root):
    return documents(spark, root).select("doc_id", F.array_join(charset(F.col("text")), "").alias("chars"))


@query(
    "char_vocab",
    """SELECT c AS token, (row_number() OVER (ORDER BY c) - 1)::INTEGER AS id
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents)""",
)
def vocabulary(spark, root):
    return char_vocab(documents(spark, root), "text")


@query(
    "char_encode",
    f"WITH {SQL_DOC_IDS} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM enc",
)
def char_encode(spark, root):
    return document_ids(spark, root).select("doc_id", joined(F.col("ids")).alias("ids"))


@query(
    "char_decode",
    f"""WITH {SQL_DOC_IDS} SELECT doc_id, string_agg(v.c, '' ORDER BY x.i) AS text
FROM (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM enc) x JOIN vocab v USING (id)
GROUP BY doc_id""",
)
def char_decode(spark, root):
    docs = documents(spark, root)
    codes = document_codes(docs)
    ids = encode_chars(F.col("text"), codes)
    return spread(docs, "doc_id").select("doc_id", decode_chars(ids, code_tokens(codes)).alias("text"))


@query(
    "pretokenize",
    f"""SELECT doc_id, len({sql_words('text')})::BIGINT AS n_words,
  array_to_string({sql_words('text')}, ' ') AS words FROM documents""",
)
def pretokenize(spark, root):
    split = documents(spark, root).select("doc_id", words(F.col("text")).alias("w"))
    return split.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("words")
    )


@query(
    "word_freq",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({sql_words('text')}) AS word FROM documents)
GROUP BY word""",
)
def word_counts(spark, root):
    return word_freq(documents(spark, root), "text")


@query(
    "vocab_size",
    "SELECT count(DISTINCT c) AS vocab_size FROM (SELECT unnest(string_split(text, '')) AS c FROM documents)",
)
def char_vocab_size(spark, root):
    return vocab_size(char_vocab(documents(spark, root), "text"))


@query(
    "roundtrip_mismatch",
    f"""WITH {SQL_DOC_IDS},
dec AS (SELECT doc_id, string_agg(v.c, '' ORDER BY x.i) AS again
        FROM (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM enc) x JOIN vocab v USING (id)
        GROUP BY doc_id)
SELECT count(*) AS n_texts, count(*) FILTER (again <> text) AS n_mismatch
FROM documents JOIN dec USING (doc_id)""",
)
def roundtrip(spark, root):
    docs = documents(spark, root)
    return roundtrip_mismatch(docs, "text", document_codes(docs))


# A full vocabulary takes thousands of dependent merges, which SQL would do one by
# one over all words; the queries below are compared with a plain trainer and with
# the public library instead, and with SQL for a small vocabulary.


@query("bpe_merges")
def bpe_merges(spark, root):
    return trained_tokenizer(spark, root).merge_table(spark)


@query("bpe_encode")
def bpe_encode(spark, root):
    rows = encoded_documents(spark, root, trained_tokenizer(spark, root))
    return rows.select("doc_id", joined(F.col("ids")).alias("ids"))


@query("bpe_decode")
def bpe_decode(spark, root):
    return decoded_documents(spark, root, trained_tokenizer(spark, root))


def decoded_documents(spark, root, tokenizer):
    closed = F.concat("ids", F.array(F.lit(tokenizer.id_of(bpe.END))))
    return encoded_documents(spark, root, tokenizer).select(
        "doc_id",
        bpe.decode(closed, tokenizer).alias("text"),
        bpe.decode(closed, tokenizer, skip_specials=False).alias("text_with_specials"),
    )


@query("ids_to_tokens")
def id_tokens(spark, root):
    return token_counts(spark, root, trained_tokenizer(spark, root))


def token_counts(spark, root, tokenizer):
    """(token, n, n_docs): ids are counted first, so only distinct ids become strings.

    A plain explode lets the planner put a filter on the size of ``ids`` below it, which
    encodes every text a second time.
    """
    rows = encoded_documents(spark, root, tokenizer).select("doc_id", F.explode_outer("ids").alias("id")).where("id IS NOT NULL")
    counts = rows.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("n")).groupBy("id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"))
    return counts.select(bpe.ids_to_tokens(F.array("id"), tokenizer)[0].alias("token"), "n", "n_docs")


@query("vocab_roundtrip")
def vocab_roundtrip(spark, root):
    folder = os.path.join(shared_folder(spark), f"tokenizer-{uuid.uuid4().hex}")
    save_tokenizer(spark, trained_tokenizer(spark, root), folder)
    again = load_tokenizer(spark, folder)
    vocab, _ = read_tables(spark, folder)
    return vocab.withColumn("pad_id", F.lit(again.pad_id))


@query("bpe_roundtrip")
def bpe_roundtrip(spark, root):
    """One row: texts, texts that decoding does not give back, and texts that lose a character.

    Decoded tokens are joined by spaces, so most texts come back with other
    spaces; the last figure compares without them.
    """
    tokenizer = trained_tokenizer(spark, root)
    rows = encoded_documents(spark, root, tokenizer).select("text", bpe.decode(F.col("ids"), tokenizer, skip_specials=False).alias("again"))
    plain = lambda column: F.array_join(words(F.col(column)), "")
    return rows.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.coalesce(F.sum((F.col("again") != F.col("text")).cast("long")), F.lit(0)).alias("n_mismatch"),
        F.coalesce(F.sum((plain("again") != plain("text")).cast("long")), F.lit(0)).alias("n_lost"),
    )
