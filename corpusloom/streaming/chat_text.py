"""Chat training text from a stream of instruction rows.

Cleaning, checking, message building and rendering are row-local, so the same
expressions run on a stream: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from corpusloom.functions.chat import instruction_messages, render
from corpusloom.operators.rows import split_rejects


def chat_text(
    rows: DataFrame, question: str = "instruction", answer: str = "output", system: str = "", eos: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``text``, rejected rows with ``reason``); batch or streaming."""
    good, rejected = split_rejects(rows, question, answer)
    built = instruction_messages(F.col(question), F.col(answer), system=system)
    return good.withColumn("text", render(built, eos=eos)), rejected


def write_new_rows(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last run as JSON lines, each row exactly once."""
    return (
        rows.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
