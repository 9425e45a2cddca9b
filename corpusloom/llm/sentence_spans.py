"""Repeated passages: every run of several consecutive sentences, joined globally.

A sentence ends at ``.``, ``!``, ``?`` or a line break, and inside long sentences
at words that a hash picks, so that a passage without punctuation is cut at the
same words wherever it stands. Of all places of a repeated run the first, in the
order of id and position, stays; sentences covered by any other place go.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, slices
from corpusloom.session import materialize

_TOKEN = re.compile(r"\w+|[.!?\n]+")


@dataclass(frozen=True)
class Runs:
    sentences: int = 3
    #: Runs with fewer words are too common to count as passages.
    least_words: int = 10
    #: A sentence of so many words may end at a word whose hash is 0 modulo ``cut``.
    long_words: int = 8
    cut: int = 4


def sentences_of(text: str, runs: Runs) -> list[tuple[str, int, int, int]]:
    """(lower-cased words, start, end, number of words) of each sentence with words."""
    out = []
    words: list[str] = []
    start = end = 0

    def close(stop: int) -> None:
        if words:
            out.append((" ".join(words).lower(), start, stop, len(words)))
            words.clear()

    for m in _TOKEN.finditer(text):
        token = m.group()
        if token[0] in ".!?\n":
            close(m.end())
            continue
        if not words:
            start = m.start()
        words.append(token)
        end = m.end()
        if len(words) >= runs.long_words and zlib.crc32(token.lower().encode()) % runs.cut == 0:
            close(end)
    close(end)
    return out


def _runs(runs: Runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches):
            counts, sizes, found = [], [], []
            for text in part.column(2).to_pylist():
                s = sentences_of(text, runs)
                hashes = [hashlib.blake2b(x[0].encode(), digest_size=16).digest() for x in s]
                rows = []
                for i in range(len(s) - runs.sentences + 1):
                    last = i + runs.sentences
                    if sum(x[3] for x in s[i:last]) >= runs.least_words:
                        d = hashlib.blake2b(b"".join(hashes[i:last]), digest_size=12).digest()
                        rows.append({"h1": int.from_bytes(d[:8], "little", signed=True), "h2": int.from_bytes(d[8:], "little", signed=True), "start": s[i][1], "end": s[last - 1][2]})
                counts.append(len(s))
                sizes.append(len(text))
                found.append(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, kind)],
                ["_id", "_th", "n_sentences", "n_chars", "runs"],
            )

    return run


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: Runs = Runs()) -> DataFrame:
    """(_id, _th, n_sentences, n_chars, spans, removed_chars), one row per row of ``df``.

    spans: merged (start, end) in code points, end exclusive, of the sentences
    to remove, in order. Null ids come first in the order of places; rows that
    repeat an id are told apart by their row number. A text with fewer than
    ``runs.sentences`` sentences, null and empty included, has no run and stays. An
    empty table gives an empty one; other columns are not read. A very long text
    is cut and hashed whole, inside one task.
    """
    docs = keyed(df, id_col, text_col).mapInArrow(
        _runs(runs),
        "_id long, _th long, n_sentences long, n_chars long, runs array<struct<h1: long, h2: int, start: int, end: int>>",
    )
    docs = materialize(docs.withColumn("rid", F.monotonically_increasing_id()), "sentence-runs")
    places = docs.select("rid", F.explode("runs").alias("r")).select("r.h1", "r.h2", "rid", "r.start", "r.end")
    several = places.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    places = places.join(several, ["h1", "h2"]).join(docs.select("rid", "_id"), "rid")
    places = materialize(places, "repeated-runs")
    place = "struct(_id is not null as has, coalesce(_id, 0L) as id, rid, start)"
    first = places.groupBy("h1", "h2").agg(F.min(F.expr(place)).alias("first"))
    later = places.join(first, ["h1", "h2"]).where("not (rid = first.rid and start = first.start)")
    covered = later.select("rid", "start", "end").distinct().groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    # Runs overlap: join those that touch. One document's own runs, no more.
    merged = F.aggregate(
        "s",
        F.lit(None).cast("array<struct<start: int, end: int>>"),
        lambda acc, x: F.when(acc.isNull(), F.array(x))
        .when(
            F.element_at(acc, -1)["end"] >= x["start"],
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        )
        .otherwise(F.concat(acc, F.array(x))),
    )
    spans = covered.select("rid", merged.alias("spans"))
    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    return (
        docs.select("rid", "_id", "_th", "n_sentences", "n_chars")
        .join(spans, "rid", "left")
        .withColumn("spans", F.coalesce("spans", none))
        .withColumn("removed_chars", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]))
        .drop("rid")
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return "".join([*out, text[at:]])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: Runs = Runs()) -> DataFrame:
    """``df`` with repeated passages cut out of the text; rows and other columns stay."""
    spans = repeated_spans(df, id_col, text_col, runs).where("removed_chars > 0")
    # Rows that repeat an id and a text differ only in which of them is first.
    spans = spans.groupBy(F.col("_id").alias("_kid"), F.col("_th").alias("_kth")).agg(F.max_by("spans", "removed_chars").alias("_spans"))
    # Columns travel under plain names, so that theirs may hold any character.
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index(text_col)
    plain, key = df.toDF(*names), F.col(names[df.columns.index(id_col)]).cast("long")
    text = F.coalesce(F.col(names[at]), F.lit(""))
    joined = plain.join(spans, key.eqNullSafe(F.col("_kid")) & (F.xxhash64(text) == F.col("_kth")), "left").select(*names, "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            pairs = zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist())
            texts = [without_spans(t, [(s["start"], s["end"]) for s in x]) if x else t for t, x in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns[:-1])], names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    return joined.mapInArrow(cut, schema).toDF(*df.columns)
