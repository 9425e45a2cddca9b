from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.chat import (
    ASSISTANT_SYSTEM,
    instruction_messages,
    messages,
    raw_instruction_messages,
    render,
    text2sql_prompt,
    text2sql_text,
    user_content,
)
from corpusloom.functions.text import (
    chars,
    clean_text,
    decode_chars,
    encode_chars,
    keep_known_chars,
    naive_strip,
    strip,
    words,
)
from corpusloom.operators.rows import map_rows, reply_pairs, split_rejects, to_training_form
from corpusloom.operators.splits import sample_preview
from corpusloom.operators.vocabulary import char_codes, char_vocab, code_tokens, roundtrip_mismatch


def one(spark, expression, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return df.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, cleaned",
    [(None, ""), ("", ""), (" nan ", ""), ("NONE", ""), ("None", ""), (" 　", ""), (" A b ", "A b"),
     ("none left", "none left"), ("a\n", "a"), ("\x1ca\x1f", "a"), ("nan\nx", "nan\nx"), ("0", "0")],
)
def test_clean_text(spark, value, cleaned):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(clean_text(F.col("t")).alias("x")).first()["x"] == cleaned


def test_clean_number_keeps_zero(spark):
    assert one(spark, clean_text(F.col("n")), n=0) == "0"


def test_strip_matches_python_on_every_space(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    df = spark.createDataFrame([(s + "x" + s,) for s in spaces], "t string")
    assert {r["x"] for r in df.select(strip(F.col("t")).alias("x")).collect()} == {"x"}


def test_naive_strip(spark):
    df = spark.createDataFrame([(None,), (" a ",)], "t string")
    assert [r[0] for r in df.select(naive_strip(F.col("t"))).collect()] == ["None", "a"]
    assert one(spark, naive_strip(None)) == ""


def test_words_and_chars_unicode(spark):
    text = "안녕, été! a_b 😀😀?"
    assert one(spark, words(F.col("t")), t=text) == ["안녕", ",", "été", "!", "a_b", "😀😀?"]
    assert one(spark, chars(F.col("t")), t=text) == list(text)
    assert one(spark, chars(F.col("t")), t="") == []


def test_char_vocabulary_round_trip(spark):
    texts = ["안녕 😀", "", "abc\tz", "é", "a" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    codes = char_codes(char_vocab(df, "text"))
    assert code_tokens(codes) == sorted(set("".join(texts)))
    assert tuple(roundtrip_mismatch(df, "text", codes).first()) == (len(texts), 0)


def test_unknown_characters(spark):
    codes = {"a": 0, "b": 1}
    assert one(spark, encode_chars(F.col("t"), codes, "drop"), t="axb😀") == [0, 1]
    assert one(spark, keep_known_chars(F.col("t"), codes), t="axb😀") == "ab"
    ids = F.array(F.lit(0), F.lit(7), F.lit(-1), F.lit(1))
    assert one(spark, decode_chars(ids, ["a", "b"], "drop")) == "ab"
    with pytest.raises(Exception, match="character not in vocabulary: x"):
        one(spark, encode_chars(F.col("t"), codes), t="axb")
    with pytest.raises(Exception, match="id not in vocabulary: 7"):
        one(spark, decode_chars(ids, ["a", "b"]))


def test_map_rows(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert map_rows(df, None, ["v"]).columns == ["k"]
    changed = map_rows(df, lambda d: {"v": F.upper(d["v"]), "n": F.length(d["v"])}, ["k", "v"])
    assert changed.columns == ["v", "n"] and tuple(changed.first()) == ("A", 1)


def test_dispatch(spark):
    for column in ("messages", "text", "input_ids"):
        ready = spark.createDataFrame([("x",)], f"{column} string")
        assert to_training_form(ready) is ready
    with pytest.raises(ValueError, match=r"missing columns: \['output'\].*\['a', 'instruction'\]"):
        to_training_form(spark.createDataFrame([("x", 1)], "instruction string, a int"))
    rows = spark.createDataFrame([("q", "a", " i ")], "instruction string, output string, input string")
    built = to_training_form(rows, system=" s ").first()["messages"]
    assert [tuple(m) for m in built] == [("system", "s"), ("user", "q\n\n입력:\ni"), ("assistant", "a")]
    empty = to_training_form(rows.limit(0))
    assert empty.columns == ["messages"] and empty.count() == 0


@pytest.mark.parametrize("row, reason", [((" ", "a"), "empty instruction"), (("q", "NaN"), "empty output"), ((None, None), "empty instruction")])
def test_required_fields(spark, row, reason):
    df = spark.createDataFrame([row, ("q", "a")], "instruction string, output string")
    good, rejected = split_rejects(df, "instruction", "output")
    assert good.count() == 1 and [r["reason"] for r in rejected.collect()] == [reason]
    with pytest.raises(Exception, match=reason):
        to_training_form(df).collect()
    assert to_training_form(df, strict=False).count() == 1


def test_optional_input_and_blank_system(spark):
    q, a = F.lit("q"), F.lit("a")
    assert one(spark, user_content(q, F.lit(" none "))) == "q"
    assert one(spark, user_content(q)) == "q"
    assert len(one(spark, instruction_messages(q, a, system="  "))) == 2
    assert one(spark, raw_instruction_messages(q, a))[0]["content"] == ASSISTANT_SYSTEM


def test_render_endings(spark):
    turns = messages(("user", "hi"), ("assistant", "a\n"))
    closed = "<start_of_turn>user\nhi<end_of_turn>\n<start_of_turn>model\na\n<end_of_turn>\n"
    assert one(spark, render(turns)) == closed
    assert one(spark, render(turns, eos="</s>")) == closed + "</s>"
    assert one(spark, render(turns, "generation")) == closed + "<start_of_turn>model\n"
    assert one(spark, render(turns, "continue")) == closed.removesuffix("<end_of_turn>\n")
    with pytest.raises(ValueError):
        render(turns, "other")


def test_text2sql(spark):
    df = spark.createDataFrame([("q", None, "s")], "q string, c string, s string")
    q, c, s = F.col("q"), F.col("c"), F.col("s")
    row = df.select(
        text2sql_text(q, c, s).alias("clean"), text2sql_text(q, c, s, compat=True).alias("compat"),
        text2sql_text(q, None, s).alias("absent"), text2sql_prompt(q, F.lit("T")).alias("prompt"),
    ).first()
    tail = "<end_of_turn>\n<start_of_turn>model\ns<end_of_turn>"
    assert row["clean"] == row["absent"] == "<start_of_turn>user\nq" + tail
    assert row["compat"] == "<start_of_turn>user\nq\n\n[SCHEMA]\nNone" + tail
    assert row["prompt"] == "Task:q\nSQL table: T\nSQL query:"


def test_reply_pairs_with_a_gap(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 2, "assistant", "b"), (2, 1, "user", "c")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in reply_pairs(df).collect()] == [(1, 0, "a", "b")]


def test_reply_pairs(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in reply_pairs(df).collect()] == [(1, 2, "b", "c")]


def test_preview(spark):
    df = spark.createDataFrame([(i, "b", "a") for i in range(5)], "k long, z string, y string")
    shown = sample_preview(df, ["k"], 3)
    assert shown.count() == 3 and sample_preview(df, ["k"], 0).count() == 0
    assert sample_preview(df, ["k"], 99).count() == 5
    row = shown.first()
    assert row["preview"] == f'{{"k":{row["k"]},"y":"a","z":"b"}}'
