"""Nulls, empty and very long texts, repeated rows, clashing names, empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import merge_automaton, minhash_join, sentence_spans, toxic_crf
from corpusloom.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 7919}." if i % 9 == 0 else f"word{i % 7919}" for i in range(60_000))
ROWS = [
    (1, "the same text of a few words.", "en", "a", 1), (1, "the same text of a few words.", "en", "a", 1), (2, "The same text of a few words.", None, None, None),
    (None, None, None, None, None), (None, "the same text of a few words.", "en", "b", 2), (3, "", "en", "b", 0), (4, LONG, "fr", "a", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    names = ["_id", "_th", "_row", "_text", "score", "kept", "copies", "ids", "spans", "a.b"]
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)]).repartition(3)


def test_spans_of_edge_rows(docs):
    got = sentence_spans.repeated_spans(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r["spans"] == [] for r in got if r["n_sentences"] < sentence_spans.Runs().sentences)
    assert sentence_spans.repeated_spans(docs.limit(0)).count() == 0
    cut = sentence_spans.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)


def test_scores_of_edge_rows(spark, docs):
    marks = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxic_crf.train(docs, marks)
    got = toxic_crf.score(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["_id"] == 1}) == 1
    assert toxic_crf.score(docs.limit(0), model).count() == 0


def test_encoding_edge_rows(spark, docs):
    tokenizer = merge_automaton.ByteTokenizer(spark, vocabulary_path())
    got = tokenizer.decode(tokenizer.encode(docs, out="tokens"), "tokens").collect()
    assert len(got) == len(ROWS) and all(r["decoded"] == (r["text"] or "") for r in got)
    assert all(r["tokens"] == [] for r in got if not r["text"])
    assert tokenizer.encode(docs.limit(0), out="tokens").count() == 0
    with pytest.raises(ValueError, match="already has a column ids"):
        tokenizer.encode(docs)


def test_groups_of_edge_rows(docs):
    got = minhash_join.near_duplicates(docs).collect()
    assert len(got) == len(ROWS) and sum(r["kept"] for r in got) == 4


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_edge_rows(spark, tmp_path, docs, name, stage):
    spark.createDataFrame([(3, 0), (9, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        found = stage(spark, table.drop("ids"), str(tmp_path))
        rows = found.collect()
        if name != "BPE encoding":
            assert found.columns == table.drop("ids").columns
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in table.collect()}
        if name == "exact dedup" and rows:
            assert sorted((r["text"] or "")[:8].lower() for r in rows) == ["", "the same", "word0. w"]
