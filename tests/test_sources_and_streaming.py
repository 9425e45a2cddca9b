from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.chat import messages
from corpusloom.operators.bpe import BpeTokenizer
from corpusloom.operators.bpe_training import train_bpe
from corpusloom.operators.vocabulary import word_freq
from corpusloom.session import collect_bounded
from corpusloom.sources.json_splits import CHAT_SCHEMA, load_splits, read_json, write_json
from corpusloom.sources.tables import (
    head_slice,
    load_table,
    prompts_from_list,
    prompts_from_table,
    row_slice,
)
from corpusloom.sources.tokenizer_store import load_tokenizer, read_manifest, save_tokenizer, stored_tokenizer, table_digest
from corpusloom.streaming.chat_text import chat_text, write_new_rows


def test_json_splits(spark, tmp_path):
    folder = str(tmp_path / "data")
    with pytest.raises(FileNotFoundError, match="does not exist"):
        load_splits(spark, folder)
    rows = spark.range(3).select(messages(("user", "안녕"), ("assistant", "네")).alias("messages"))
    (tmp_path / "data").mkdir()
    with pytest.raises(FileNotFoundError, match="training split"):
        load_splits(spark, folder)
    write_json(rows, f"{folder}/train_dataset.json")
    with pytest.raises(FileNotFoundError, match="evaluation split"):
        load_splits(spark, folder)
    train, evaluation = load_splits(spark, folder, need_eval=False, schema=CHAT_SCHEMA)
    assert evaluation is None and train.schema == CHAT_SCHEMA
    assert train.collect() == rows.collect()
    raw = spark.read.text(f"{folder}/train_dataset.json").first()["value"]
    assert raw == '{"messages":[{"role":"user","content":"안녕"},{"role":"assistant","content":"네"}]}'


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[{"a": 1},\n {"a": 2}]', encoding="utf-8")
    assert sorted(r["a"] for r in read_json(spark, str(path), multi_line=True).collect()) == [1, 2]


def test_tables(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("k"), F.when(F.col("id") < 7, "train").otherwise("test").alias("split"))
    df.write.parquet(str(tmp_path / "t.parquet"))
    assert load_table(spark, str(tmp_path), "t", ["k"]).columns == ["k"]
    assert load_table(spark, str(tmp_path), "t", split="test").count() == 3
    loaded = load_table(spark, str(tmp_path), "t").repartition(4)
    assert [r["k"] for r in head_slice(loaded, ["k"], 3).collect()] == [0, 1, 2]
    assert [r["k"] for r in row_slice(loaded, ["k"], 8, 5).collect()] == [8, 9]
    with pytest.raises(ValueError):
        row_slice(loaded, ["k"], -1)


def test_prompt_sources_share_a_schema(spark):
    listed = prompts_from_list(spark, ["a", "b"])
    table = prompts_from_table(spark.createDataFrame([(5, "x")], "k int, t string"), "k", "t")
    assert [f.name for f in listed.schema] == [f.name for f in table.schema]
    assert listed.unionByName(table).count() == 3


def test_bound_is_checked(spark):
    assert len(collect_bounded(spark.range(3), 3, "rows")) == 3
    with pytest.raises(ValueError, match="more than 2"):
        collect_bounded(spark.range(3), 2, "rows")


def test_tokenizer_store(spark, tmp_path):
    docs = spark.createDataFrame([("ababab abc",)], "text string")
    tokenizer = train_bpe(word_freq(docs, "text"), max_merges=3)
    save_tokenizer(spark, tokenizer, str(tmp_path / "tok"))
    assert load_tokenizer(spark, str(tmp_path / "tok")) == tokenizer


def test_roles_survive_the_store(spark, tmp_path):
    specials = ("[PAD]", "[UNK]", "[EOS]")
    tokenizer = BpeTokenizer((*specials, "a", "b", "ab"), ((3, 4, 5),), unknown="[UNK]", pad="[PAD]", end="[EOS]", specials=specials)
    save_tokenizer(spark, tokenizer, str(tmp_path / "tok"))
    again = load_tokenizer(spark, str(tmp_path / "tok"))
    assert again == tokenizer and again.pad_id == 0
    without = BpeTokenizer((*specials, "a"), (), unknown=None, pad=None, end="[EOS]", specials=specials)
    save_tokenizer(spark, without, str(tmp_path / "tok"))
    assert load_tokenizer(spark, str(tmp_path / "tok")) == without and without.pad_id == 2
    with pytest.raises(ValueError, match="no complete tokenizer"):
        load_tokenizer(spark, str(tmp_path / "none"))
    assert read_manifest(spark, str(tmp_path / "none")) is None


def test_a_changed_table_trains_again(spark, tmp_path):
    trained = []

    def train(df):
        trained.append(df.count())
        return train_bpe(word_freq(df, "text"), max_merges=1)

    docs = spark.createDataFrame([("abab",), ("cdcdcd",), ("abab",)], "text string")
    folder = str(tmp_path / "store")
    first = stored_tokenizer(spark, folder, docs, train)
    assert stored_tokenizer(spark, folder, docs.repartition(3), train) == first and trained == [3]
    assert stored_tokenizer(spark, folder, docs.distinct(), train) != first or len(trained) == 2
    stored_tokenizer(spark, folder, docs, train, "other")
    assert trained == [3, 2, 3]
    assert table_digest(docs) != table_digest(docs.limit(2)) and table_digest(docs.limit(0)) == table_digest(docs.limit(0))


def test_padding_falls_back_to_end():
    assert BpeTokenizer(("a", "</s>"), (), pad=None).pad_id == 1
    assert BpeTokenizer(("a", "</s>", "<pad>"), ()).pad_id == 2
    with pytest.raises(ValueError, match="padding token or an end token"):
        BpeTokenizer(("a",), (), pad=None, end=None).pad_id


def test_stream_of_instruction_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "instruction string, output string"
    rows = spark.createDataFrame([("q", "a"), (" ", "b")], schema)
    rows.write.json(source)
    stream = spark.readStream.schema(schema).json(source)
    good, rejected = chat_text(stream)
    assert good.isStreaming and rejected.isStreaming
    for _ in range(2):  # the second run finds nothing new
        write_new_rows(good, out, state).awaitTermination()
    assert [r["text"] for r in spark.read.json(out).collect()] == [
        "<start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\na<end_of_turn>\n"
    ]
