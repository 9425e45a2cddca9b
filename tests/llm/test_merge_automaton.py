"""The work of the merge automaton per text, and what its quicker forms must still give."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import regex

from corpusloom.llm import merge_automaton
from corpusloom.llm.merge_automaton import LONG_WORD, WORDS, Automaton, ByteTokenizer, Encoder, Tables, compiled, joined, read_tokenizer, word_patterns
from corpusloom.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def tables():
    return compiled(read_tokenizer(vocabulary_path()))


def made_up(rng, n):
    return ["".join(rng.choices(["an", "th", "er", "ch", "ou", "ti", "é", "on", "s", "ge"], k=rng.randrange(1, 8))).encode() for _ in range(n)]


def test_few_arcs_are_looked_up(tables, monkeypatch):
    asked = []
    plain = Tables.has_arcs
    monkeypatch.setattr(Tables, "has_arcs", lambda self, states, tokens: asked.append(len(tokens)) or plain(self, states, tokens))
    words = made_up(random.Random(1), 20_000)
    fresh = compiled(read_tokenizer(vocabulary_path()))["tables"]
    found = [p for k in range(0, len(words), 500) for p in fresh.paths(words[k : k + 500])]
    # Pairs of tokens that were met before are not looked at again.
    assert sum(asked) < sum(map(len, words)) // 10
    path = tables["tables"].automaton().path
    assert all(np.frombuffer(p, np.int32).tolist() == path(w) for w, p in list(zip(words, found))[:2000])


def test_decoding_holds_no_row_as_objects(spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(merge_automaton, "_with_column", lambda df, column, out, kind, run: taken.update({out: run}))
    monkeypatch.setattr(Encoder, "decode", lambda self, ids: pytest.fail("a row was decoded by itself"))
    tokenizer = ByteTokenizer(spark, vocabulary_path())
    tokenizer.encode(None), tokenizer.decode(None)
    texts = pa.array(["two words", None, "", "日本 é🙂 <|endoftext|>", "x" * 2000])
    ids = list(taken["ids"](iter([texts, texts.slice(1, 2)])))
    found = list(taken["decoded"](iter([*ids, ids[0].slice(3, 2)])))
    assert [f.to_pylist() for f in found] == [[t or "" for t in texts.to_pylist()], ["", ""], texts.to_pylist()[3:]]


def test_odd_ids(spark, tables):
    labels = pa.array(tables["labels"], pa.binary())
    kind = pa.list_(pa.int32())
    one, two = ([int(np.flatnonzero([x == b for x in tables["labels"]])[0])] for b in (b"\xc3", b"\xa9"))
    assert joined(labels, pa.array([one + two, None, []], kind)).to_pylist() == ["é", "", ""]
    # The halves of a character in two rows are no text, though together they are.
    assert joined(labels, pa.array([one, two], kind)) is None
    assert joined(labels, pa.array([[1, None]], kind)) is None and joined(labels, pa.array([[-1]], kind)) is None
    df = spark.createDataFrame([(1, one), (2, two), (3, None), (4, one + two)], "k int, ids array<int>")
    found = {r["k"]: r["decoded"] for r in ByteTokenizer(spark, vocabulary_path()).decode(df).collect()}
    assert found == {1: "�", 2: "�", 3: "", 4: "é"}


def test_words_are_cut_as_spelled():
    plain, wide, whole = word_patterns()
    assert whole.pattern == WORDS and wide.search("a\U00010000") and not wide.search("a￿")
    rng = random.Random(4)
    every = [chr(i) for i in range(1 << 16) if not 0xD800 <= i < 0xE000]
    assert "".join(every) == "".join(plain.findall("".join(every)))
    some = [" ", "  ", "'", "'s", "'ll", "'S", "a", "é", "1", "²", "Ⅷ", "_", ".", "\n", "\x1c", "\x85", "​", "　", "日", "́", "x're"]
    texts = ["".join(every), *[" ".join(rng.sample(every, 300)) for _ in range(50)]]
    texts += ["".join(rng.choices([*some, rng.choice(every)], k=rng.randrange(30))) for _ in range(3000)]
    for text in texts:
        assert plain.findall(text) == regex.findall(WORDS, text)


def test_forgotten_words_do_not_shift_others(tables, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(merge_automaton, "KEPT_WORDS", 60)
    monkeypatch.setattr(merge_automaton, "BLOCK_WORDS", 7)
    encoder, path = Encoder(tables), tables["tables"].automaton().path
    (mark, mark_id), *_ = tables["added"].items()
    for _ in range(40):
        texts = [" ".join(w.decode() for w in made_up(rng, 6)) for _ in range(3)] + ["y" * rng.choice([64, 65, LONG_WORD + 9]) + f" {mark}a{mark}", None, "é\U0001d49c b"]
        for text, packed in zip(texts, encoder.encode(texts)):
            want = []
            for part in re.split(f"({re.escape(mark)})", text or ""):
                want += [mark_id] if part == mark else [i for w in regex.findall(WORDS, part) for i in path(w.encode())]
            assert np.frombuffer(packed, np.int32).tolist() == want
    assert len(encoder.known) <= 60 and len(encoder.ids) == encoder.counts.sum()


def test_a_byte_without_a_symbol():
    tables = Tables(Automaton([(0, 97), (1, 98)], [(0, 1, 2)], {0: b"a", 1: b"b", 2: b"ab"}))
    assert [np.frombuffer(x, np.int32).tolist() for x in tables.paths([b"abba", b"", b"ab" * LONG_WORD])] == [[2, 1, 0], [], [2] * LONG_WORD]
    for word in (b"abca", b"c", b"abc", b"c" * 999):
        with pytest.raises(KeyError):
            tables.paths([b"ab", word])
