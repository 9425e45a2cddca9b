"""Queries on token accuracy, BLEU and the combined record."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.arrays import response_labels
from corpusloom.functions.text import decode_chars, words
from corpusloom.operators import bpe
from corpusloom.operators.metrics import corpus_bleu, evaluate, token_accuracy
from corpusloom.operators.vocabulary import code_tokens
from corpusloom.plans.common import SQL_CHAT_IDS, chat_codes, documents, joined, rendered_pairs, sql_words
from corpusloom.plans.registry import query
from corpusloom.plans.sequences import MARKER, SQL_CHAT_JOIN, SQL_MASKED, chat_ids
from corpusloom.plans.tokens import trained_tokenizer
from corpusloom.session import spread


def spoiled_text(text):
    """A prediction made from a reference: every seventh word is left out."""
    kept = F.filter(words(text), lambda w, i: F.pmod(i, F.lit(7)) != 6)
    return F.array_join(kept, " ")


def sql_spoiled(column: str) -> str:
    return f"array_to_string(list_filter({sql_words(column)}, lambda w, i: (i - 1) % 7 <> 6), ' ')"


def _sql_tokens(column: str) -> str:
    text = column
    for old, new in (
        ("'<skipped>'", "''"),
        ("'-' || chr(10)", "''"),
        ("chr(10)", "' '"),
        ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"),
        ("'&lt;'", "'<'"),
        ("'&gt;'", "'>'"),
    ):
        text = f"replace({text}, {old}, {new})"
    text = f"' ' || {text} || ' '"
    for pattern, new in (
        (r"([\{-~\[-\x60 -&\(-\+:-@/])", r" \1 "),
        (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return f"list_filter(regexp_split_to_array({text}, '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+'), lambda t: t <> '')"


def sql_bleu(source: str, key: str) -> str:
    """CTEs ending in ``bleu`` over ``source (key, prediction, reference)``."""
    return f"""sides AS (SELECT {key}, 1 AS is_p, {_sql_tokens('prediction')} AS t FROM {source}
  UNION ALL SELECT {key}, 0, {_sql_tokens('reference')} FROM {source}),
grams AS (SELECT {key}, is_p, n, array_to_string(t[i:i + n - 1], ' ') AS gram
  FROM (SELECT {key}, is_p, t, n, unnest(range(1, len(t) - n + 2)) AS i
        FROM sides, (SELECT unnest([1, 2, 3, 4]) AS n))),
counted AS (SELECT {key}, n, gram, sum(is_p) AS p, sum(1 - is_p) AS r FROM grams GROUP BY {key}, n, gram),
orders AS (SELECT n, sum(least(p, r))::DOUBLE AS m, sum(p)::DOUBLE AS t, sum(r)::DOUBLE AS r FROM counted GROUP BY n),
flat AS (SELECT max(m / t) FILTER (n = 1) AS p1, max(m / t) FILTER (n = 2) AS p2, max(m / t) FILTER (n = 3) AS p3,
  max(m / t) FILTER (n = 4) AS p4, max(t) FILTER (n = 1) AS tl, max(r) FILTER (n = 1) AS rl FROM orders),
bleu AS (SELECT round(exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4)
    * CASE WHEN tl > rl THEN 1.0 ELSE exp(1 - rl / tl) END, 6) AS bleu,
  round(p1, 6) AS precision_1, round(p2, 6) AS precision_2, round(p3, 6) AS precision_3, round(p4, 6) AS precision_4,
  round(CASE WHEN tl > rl THEN 1.0 ELSE exp(1 - rl / tl) END, 6) AS brevity_penalty,
  round(tl / rl, 6) AS length_ratio, tl::BIGINT AS translation_length, rl::BIGINT AS reference_length FROM flat)"""


ROUNDED = (
    "bleu", "precision_1", "precision_2", "precision_3", "precision_4", "brevity_penalty", "length_ratio",
)


def rounded(df, names):
    return df.withColumns({name: F.round(name, 6) for name in names})


SQL_ACCURACY = f"""hits AS (SELECT len(e.ids) - {SQL_MASKED} AS counted,
    len(list_filter(range({SQL_MASKED} + 1, len(e.ids) + 1), lambda i: (i - 2) % 7 <> 0)) AS good FROM {SQL_CHAT_JOIN}),
accuracy AS (SELECT round(sum(good)::DOUBLE / sum(counted), 6) AS accuracy, sum(good)::BIGINT AS n_right,
  sum(counted)::BIGINT AS n_counted FROM hits)"""


def next_guess(ids):
    """The next token as prediction, but wrong at every seventh position."""
    return F.transform(
        ids, lambda _, i: F.when(F.pmod(i, F.lit(7)) != 0, F.coalesce(F.get(ids, i + 1), F.lit(-1))).otherwise(-1)
    )


def scored(rows, marker):
    return rows.select(next_guess(F.col("ids")).alias("predictions"), response_labels(F.col("ids"), marker).alias("labels"))


def accuracy(spark, root):
    return rounded(token_accuracy(scored(*chat_ids(spark, root)), "predictions", "labels"), ["accuracy"])


@query("token_accuracy", f"WITH {SQL_CHAT_IDS}, {SQL_ACCURACY} SELECT accuracy, n_right, n_counted FROM accuracy")
def token_accuracy_query(spark, root):
    return accuracy(spark, root)


@query(
    "corpus_bleu",
    f"""WITH src AS (SELECT doc_id, {sql_spoiled('text')} AS prediction, text AS reference FROM documents),
{sql_bleu('src', 'doc_id')} SELECT * FROM bleu""",
)
def document_bleu(spark, root):
    rows = spread(documents(spark, root), "doc_id").select(
        "doc_id", spoiled_text(F.col("text")).alias("prediction"), F.col("text").alias("reference")
    )
    return rounded(corpus_bleu(rows, "prediction", "reference"), ROUNDED)


@query(
    "metrics_report",
    f"""WITH {SQL_CHAT_IDS}, {SQL_ACCURACY},
src AS (SELECT conv_id, turn, substr(r.text, {SQL_MASKED} + 1) AS reference,
  array_to_string(list_transform(list_filter(range({SQL_MASKED} + 1, len(e.ids) + 1), lambda i: (i - 2) % 7 <> 0),
    lambda i: substr(r.text, i, 1)), '') AS prediction FROM {SQL_CHAT_JOIN}),
{sql_bleu('src', 'conv_id, turn')} SELECT * FROM bleu, accuracy""",
)
def report(spark, root):
    """All metrics of one prediction column of character ids."""
    rows, marker = chat_ids(spark, root)
    tokens = code_tokens(chat_codes(rendered_pairs(spark, root)))
    record = evaluate(scored(rows, marker), "predictions", "labels", lambda ids: decode_chars(ids, tokens, unknown="drop"))
    return rounded(record, [*ROUNDED, "accuracy"])


def chat_bpe_ids(spark, root):
    """(conv_id, turn, ids) of the rendered pairs, the marker's ids, and the tokenizer."""
    tokenizer = trained_tokenizer(spark, root)
    texts = spread(rendered_pairs(spark, root), "conv_id", "turn")
    rows = texts.select("conv_id", "turn", bpe.encode(F.col("text"), tokenizer).alias("ids"))
    return rows, bpe.encode_text(MARKER, tokenizer), tokenizer


@query("response_labels_bpe")
def labels_bpe(spark, root):
    """Response-only labels on byte-pair ids."""
    rows, marker, _ = chat_bpe_ids(spark, root)
    return rows.select("conv_id", "turn", joined(response_labels(F.col("ids"), marker)).alias("labels"))


@query("metrics_report_bpe")
def report_bpe(spark, root):
    """All metrics of one prediction column of byte-pair ids; special tokens are not decoded."""
    rows, marker, tokenizer = chat_bpe_ids(spark, root)
    # The guess at a wrong position is the padding token.
    guessed = scored(rows, marker).withColumn(
        "predictions", F.transform("predictions", lambda p: F.when(p < 0, F.lit(tokenizer.pad_id)).otherwise(p))
    )
    return rounded(evaluate(guessed, "predictions", "labels", lambda ids: bpe.decode(ids, tokenizer)), [*ROUNDED, "accuracy"])
