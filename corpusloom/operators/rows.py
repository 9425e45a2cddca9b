"""Row maps, schema dispatch and required-field checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.chat import instruction_messages
from corpusloom.functions.text import clean_text
from corpusloom.operators.positions import with_next

# Fixed value: columns that mark a table as ready for training.
TRAINING_COLUMNS = ("messages", "text", "input_ids")


def map_rows(
    df: DataFrame,
    new_columns: Callable[[DataFrame], dict[str, Column]] | dict[str, Column] | None = None,
    remove_columns: list[str] | None = None,
) -> DataFrame:
    """Add or replace columns by expressions, then drop the named ones.

    A new column that has the name of a removed one stays.
    """
    added = new_columns(df) if callable(new_columns) else (new_columns or {})
    result = df.withColumns(added) if added else df
    return result.drop(*[c for c in (remove_columns or []) if c not in added])


def reject_reason(question: str, answer: str) -> Column:
    """Name of the first required column that is empty after cleaning, else null."""
    return F.when(clean_text(F.col(question)) == "", F.lit(f"empty {question}")).when(
        clean_text(F.col(answer)) == "", F.lit(f"empty {answer}")
    )


def split_rejects(df: DataFrame, question: str, answer: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their ``reason``; both are narrow filters."""
    reason = reject_reason(question, answer)
    return df.where(reason.isNull()), df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def checked_messages(
    df: DataFrame, question: str, answer: str, extra: str | None = None, system: str = ""
) -> Column:
    """Messages of an instruction row; an empty required field fails the job."""
    optional = F.col(extra) if extra is not None and extra in df.columns else None
    built = instruction_messages(F.col(question), F.col(answer), optional, system)
    reason = reject_reason(question, answer)
    failed = F.raise_error(F.concat(F.lit("required field: "), reason)).cast(
        "array<struct<role:string,content:string>>"
    )
    return F.when(reason.isNotNull(), failed).otherwise(built)


def to_training_form(
    df: DataFrame,
    question: str = "instruction",
    answer: str = "output",
    extra: str | None = "input",
    system: str = "",
    strict: bool = True,
) -> DataFrame:
    """Pass a ready table through; turn an instruction table into one of ``messages``.

    Looks at the schema only, so no row is read to decide. Without ``strict``,
    rows with an empty required field are left out (see ``split_rejects``).
    """
    if any(name in df.columns for name in TRAINING_COLUMNS):
        return df
    missing = [name for name in (question, answer) if name not in df.columns]
    if missing:
        raise ValueError(
            f"table format is not supported; missing columns: {missing}; "
            f"available columns: {sorted(df.columns)}"
        )
    if not strict:
        df, _ = split_rejects(df, question, answer)
    return df.select(checked_messages(df, question, answer, extra, system).alias("messages"))


def min_length(df: DataFrame, length: Column, block: int) -> DataFrame:
    """Rows long enough for one block and its shifted target.

    ``length`` is the number of tokens. Where it is known without encoding (the
    length of a text in characters), pass that and filter first: a filter on the
    size of an encoded array would encode once to filter and once to keep.
    """
    return df.where(length >= block + 1)


def reply_pairs(turns: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(key, turn, instruction, output) of each user turn answered by the next turn.

    The next turn is the next number that exists, so gaps lose no pair; it comes
    from the keys alone, in ranges of (key, turn), so a long conversation is split.
    Each role is read with its own filter and joined on the keys. Rows that share
    a number are all answered by every assistant row of the next number.
    """
    keys = turns.select(key, turn).where(F.col(key).isNotNull() & F.col(turn).isNotNull()).distinct()
    follows = with_next(keys, [key, turn]).where(F.col(f"_next_{key}") == F.col(key)).select(key, turn, F.col(f"_next_{turn}").alias("_next"))
    asked = turns.where(F.col("role") == "user").select(key, turn, F.col("text").alias("instruction"))
    answers = turns.where(F.col("role") == "assistant").select(key, F.col(turn).alias("_next"), F.col("text").alias("output"))
    return asked.join(follows, [key, turn]).join(answers, [key, "_next"]).select(key, turn, "instruction", "output")
