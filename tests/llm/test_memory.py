"""What a Python process of an executor holds, in a task and after it."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import toxic_crf
from corpusloom.llm.common import slices
from corpusloom.llm.merge_automaton import LONG_WORD, Automaton, Encoder, compiled, read_tokenizer
from corpusloom.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def tables():
    return compiled(read_tokenizer(vocabulary_path()))


def test_tables_are_flat_arrays(tables):
    held = vars(tables["tables"])
    assert not [k for k, v in held.items() if isinstance(v, (Automaton, dict, list))]
    # Long words take the same path as all at once.
    word = "".join(random.Random(3).choices("aeinrst'.-09é日", k=LONG_WORD)).encode()
    whole = np.frombuffer(tables["tables"].paths([word[:LONG_WORD]])[0], np.int32).tolist()
    assert tables["tables"].automaton().path(word[:LONG_WORD]) == whole
    assert len(tables["tables"].paths([word * 40])[0]) > 0


def test_encoder_keeps_a_word_once(tables):
    encoder = Encoder(tables)
    encoder.encode([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))])
    # 599 chunks with a space before them and one without; each is one word.
    assert sum(len(v) for v in vars(encoder).values() if isinstance(v, dict) and v is not encoder.added_ids) == 600


def test_words_and_chunks_share_a_map(tables):
    rng = random.Random(5)
    parts = ["'s", "'", "''", "s", "re", "'re", " ", "  ", "\n", "\t ", "a", "é", "9", "12", ".", "-", "　", "\x85", "日本", "x'll"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(400)]
    encoder = Encoder(tables)
    together = [encoder.encode([t])[0] for t in texts]
    assert together == [Encoder(tables).encode([t])[0] for t in texts]


def test_no_words_stay_with_the_model(monkeypatch):
    taken = {}
    rows = SimpleNamespace(mapInArrow=lambda run, schema: taken.update(run=run))
    monkeypatch.setattr(toxic_crf, "keyed", lambda *a: rows)
    model = toxic_crf.Model(np.zeros((1 << 20) + 1, np.float32), np.zeros((2, 2)), np.zeros(3), 0.5, toxic_crf.Settings())
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    toxic_crf.score(SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context)), model)
    batch = pa.RecordBatch.from_pydict({"_id": [1], "_th": [2], "_text": ["one two three"]})
    out = list(taken["run"](iter([batch])))
    assert len(out) == 1 and model._emit is None


def test_slices_give_memory_back(monkeypatch):
    freed = []
    monkeypatch.setattr(pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: freed.append(1)))
    batch = pa.RecordBatch.from_pydict({"x": list(range(600))})
    assert [p.num_rows for p in slices(iter([batch]))] == [256, 256, 88] and freed == [1]
    assert list(slices(iter([]))) == []
