from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.arrays import argmax, cross_entropy, softmax
from corpusloom.operators import keywords, metrics
from corpusloom.operators.keywords import top_keywords
from corpusloom.operators.metrics import (
    clipped_counts,
    corpus_bleu,
    evaluate,
    loss_by_split,
    loss_history,
    metrics_report,
    token_accuracy,
)
from corpusloom.operators.vectors import causal_mean, last_vector, similar_history, sliding_history

DIM = 4


@pytest.fixture(scope="module")
def sequences(spark):
    rng = np.random.default_rng(0)
    data = {0: rng.normal(size=(11, DIM)), 1: rng.normal(size=(1, DIM)), 2: rng.normal(size=(4, DIM))}
    rows = [(s, p, v.tolist()) for s, m in data.items() for p, v in enumerate(m)]
    return data, spark.createDataFrame(rows, "seq int, pos int, v array<double>").repartition(5)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_causal_mean_equals_triangular_product(sequences, block):
    data, df = sequences
    got = {(r["seq"], r["pos"]): r["mean"] for r in causal_mean(df, "seq", "pos", "v", DIM, block).collect()}
    for s, m in data.items():
        tril = np.tril(np.ones((len(m), len(m))))
        expected = tril / tril.sum(1, keepdims=True) @ m
        for p in range(len(m)):
            np.testing.assert_allclose(got[s, p], expected[p])
    assert len(got) == 16


@pytest.mark.parametrize("block, scaled", [(4, True), (16, True), (16, False)])
def test_similar_history_equals_masked_softmax(sequences, block, scaled):
    data, df = sequences
    rows = similar_history(df.select("*", F.transform("v", lambda x: x * 2).alias("w")), "seq", "pos", "v", "w", "v", DIM, block, scaled)
    got = {(r["seq"], r["pos"]): r["output"] for r in rows.collect()}
    for s, m in data.items():
        for start in range(0, len(m), block):
            part = m[start : start + block]
            scores = part @ (2 * part).T * (DIM**-0.5 if scaled else 1)
            scores[np.triu_indices(len(part), 1)] = -np.inf
            weights = np.exp(scores - scores.max(1, keepdims=True))
            expected = weights / weights.sum(1, keepdims=True) @ part
            for p in range(len(part)):
                np.testing.assert_allclose(got[s, start + p], expected[p])


def test_causal_mean_of_many_blocks_and_wide_vectors(spark):
    rng = np.random.default_rng(1)
    data = {f"s{s}": rng.normal(size=(n, 150)) for s, n in enumerate((700, 1, 64, 65))}
    rows = [(s, p, v.tolist()) for s, m in data.items() for p, v in enumerate(m)]
    df = spark.createDataFrame(rows, "seq string, pos long, v array<float>").repartition(7)
    got = {(r["seq"], r["pos"]): r["mean"] for r in causal_mean(df, "seq", "pos", "v", block=64).collect()}
    assert len(got) == len(rows)
    for s, m in data.items():
        expected = np.cumsum(m.astype(np.float32), axis=0, dtype=np.float64) / np.arange(1, len(m) + 1)[:, None]
        for p in range(len(m)):
            np.testing.assert_allclose(got[s, p], expected[p], atol=1e-6)
    assert causal_mean(df.limit(0), "seq", "pos", "v").count() == 0


@pytest.mark.parametrize("block, tile", [(4, 4), (4, 5), (3, 256), (1, 2), (50, 4)])
def test_sliding_history_equals_banded_softmax(spark, block, tile):
    rng = np.random.default_rng(2)
    data = {0: rng.normal(size=(33, DIM)), 1: rng.normal(size=(1, DIM)), 5: rng.normal(size=(9, DIM)) * 400}
    rows = [(s, p, v.tolist()) for s, m in data.items() for p, v in enumerate(m)]
    df = spark.createDataFrame(rows, "seq int, pos int, v array<double>").withColumn("w", F.transform("v", lambda x: x * 2)).repartition(5)
    got = {(r["seq"], r["pos"]): r["output"] for r in sliding_history(df, "seq", "pos", "v", "w", "v", DIM, block, tile=tile).collect()}
    assert len(got) == len(rows)
    for s, m in data.items():
        at = np.arange(len(m))
        scores = m @ (2 * m).T * DIM**-0.5
        scores[(at[None, :] > at[:, None]) | (at[None, :] <= at[:, None] - block)] = -np.inf
        weights = np.exp(scores - scores.max(1, keepdims=True))
        expected = weights / weights.sum(1, keepdims=True) @ m
        for p in range(len(m)):
            np.testing.assert_allclose(got[s, p], expected[p])


def test_last_vector(sequences):
    data, df = sequences
    got = {r["seq"]: r["last"] for r in last_vector(df, "seq", "pos", "v").collect()}
    assert got == {s: m[-1].tolist() for s, m in data.items()}


def test_score_functions(spark):
    scores = [1000.0, 999.0, 1000.0]
    df = spark.createDataFrame([(scores, 1), (scores, -100)], "s array<double>, t int")
    row = df.select(softmax(F.col("s")).alias("p"), argmax(F.col("s")).alias("a")).first()
    e = np.exp(np.array(scores) - 1000)
    np.testing.assert_allclose(row["p"], e / e.sum())
    assert row["a"] == 0
    losses = [r[0] for r in df.select(cross_entropy(F.col("s"), F.col("t"))).collect()]
    assert losses[0] == pytest.approx(-math.log(e[1] / e.sum())) and losses[1] is None


def test_token_accuracy(spark):
    schema = "p array<int>, l array<int>"
    # Label t+1 is compared with prediction t.
    df = spark.createDataFrame([([5, 6, 0, 9], [-100, 5, 6, 7]), ([1, 1], [-100, -100])], schema)
    assert tuple(token_accuracy(df, "p", "l").first()) == (2 / 3, 2, 3)
    ignored = spark.createDataFrame([([1, 1], [-100, -100]), ([1], [4]), ([], [])], schema)
    assert tuple(token_accuracy(ignored, "p", "l").first()) == (None, 0, 0)


def bleu(spark, *pairs):
    return corpus_bleu(spark.createDataFrame(pairs, "p string, r string"), "p", "r").first().asDict()


def test_bleu_by_hand(spark):
    got = bleu(spark, ("the the the the cat sat", "the cat sat on the mat"))
    assert [got[f"precision_{n}"] for n in range(1, 5)] == [4 / 6, 2 / 5, 1 / 4, 0.0] and got["bleu"] == 0.0
    got = bleu(spark, ("a b c d e", "a b c d e f g"), ("x y.", "x y ."))
    p = [8 / 8, 6 / 6, 4 / 4, 2 / 2]
    penalty = math.exp(1 - 10 / 8)
    assert [got[f"precision_{n}"] for n in range(1, 5)] == p
    assert got["bleu"] == pytest.approx(penalty) and got["brevity_penalty"] == pytest.approx(penalty)
    assert (got["translation_length"], got["reference_length"]) == (8, 10)


def test_bleu_tokenization_and_edges(spark):
    same = bleu(spark, ("It cost 1,000.5 (re-\nally) &amp; 3-4?", "It cost 1,000.5 ( really ) & 3 - 4 ?"))
    assert same["bleu"] == pytest.approx(1.0)
    assert bleu(spark, ("", "a b"))["bleu"] == 0.0
    assert bleu(spark, ("a b c d e f", "a b c d e"))["brevity_penalty"] == 1.0


def counted_by_hand(predictions, references):
    matched, total = [0] * 4, [0] * 4
    for p, r in zip(predictions, references):
        for n in range(1, 5):
            have, want = (Counter(zip(*[t[i:] for i in range(n)])) for t in (p, r))
            matched[n - 1] += sum((have & want).values())
            total[n - 1] += max(len(p) - n + 1, 0)
    return [*matched, *total, sum(map(len, references))]


def test_counts_equal_counting_row_by_row():
    rng = random.Random(3)
    for _ in range(200):
        rows = rng.randrange(6)
        sides = [[[rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(rows)] for _ in range(2)]
        assert clipped_counts(*sides) == counted_by_hand(*sides)


def test_one_record_of_one_prediction_column(spark):
    """Ids are spelled as letters; label t+1 is compared with prediction t."""
    rng = random.Random(8)
    rows = []
    for _ in range(30):
        labels = [-100] * 3 + [rng.randrange(6) for _ in range(rng.randrange(0, 12))]
        guesses = [x if rng.random() < 0.8 else rng.randrange(6) for x in [*labels[1:], 0]]
        rows.append((guesses, labels))
    df = spark.createDataFrame(rows, "p array<int>, l array<int>").repartition(4)
    spell = lambda ids: F.array_join(F.transform(ids, lambda i: F.get(F.array(*[F.lit(c) for c in "abcdef"]), i)), " ")
    got = evaluate(df, "p", "l", spell).first()
    pairs = [[(p, x) for p, x in zip(g, labels[1:]) if x != -100] for g, labels in rows]
    assert (got["n_right"], got["n_counted"]) == (sum(p == x for row in pairs for p, x in row), sum(map(len, pairs)))
    assert got["accuracy"] == got["n_right"] / got["n_counted"]
    texts = spark.createDataFrame([tuple(" ".join("abcdef"[x[i]] for x in row) for i in (0, 1)) for row in pairs], "p string, r string")
    alone = corpus_bleu(texts, "p", "r").first()
    assert all(got[name] == alone[name] for name in alone.asDict())
    assert evaluate(df.limit(0), "p", "l", spell).first()["accuracy"] is None


def test_losses(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 3.0), ("a", 1, 10.0)], "split string, batch int, loss double")
    assert tuple(loss_by_split(df, "split", "batch", "loss").first()) == ("a", 2, 6.0)
    steps = spark.range(25).withColumnRenamed("id", "step")
    assert [r["step"] for r in loss_history(steps, "step", 10).orderBy("step").collect()] == [0, 10, 20]


def test_report(spark):
    a, b = spark.range(1).selectExpr("1 AS x", "2 AS y"), spark.range(1).selectExpr("3 AS z", "'q' AS w")
    assert metrics_report(a, b).first().asDict() == {"x": 1, "y": 2, "z": 3, "w": "q"}


def test_keywords_with_hot_and_rare_words(spark):
    docs = [(i, "common " * 3 + f"rare{i} rare{i} twin{i // 2}") for i in range(2000)]
    rows = top_keywords(spark.createDataFrame(docs, "k int, t string"), "k", "t", 3).collect()
    got = {(r["k"], r["rank"]): (r["word"], r["score"]) for r in rows}
    assert len(got) == 6000
    for i in (0, 1, 1999):
        assert got[i, 1] == (f"rare{i}", round(2 * math.log(2000), 6))
        assert got[i, 2] == (f"twin{i // 2}", round(math.log(1000), 6)) and got[i, 3] == ("common", 0.0)


def test_keywords_of_likely_terms_equal_those_of_all(spark, monkeypatch):
    """Few common words, repeated and null keys, against a plain ranking; sure losers are not joined."""
    monkeypatch.setattr(keywords, "COMMON_WORDS", 3)
    rng = random.Random(8)
    docs = [(rng.choice([None, *range(40)]), " ".join(rng.choices("abcdefghijklmnop", [40, 30, *[1] * 14], k=rng.randint(0, 30)))) for _ in range(60)]
    docs += [(100, None), (101, ""), (102, "q q q r r r a")]
    tf = defaultdict(Counter)
    for key, text in docs:
        tf[key].update((text or "").split())
    df = Counter(w for words in tf.values() for w in words)
    want = set()
    for key, words in tf.items():
        scores = {w: round(n * math.log(len(docs) / df[w]), 6) for w, n in words.items()}
        want |= {(key, rank, w) for rank, w in enumerate(sorted(scores, key=lambda w: (-scores[w], w))[:3], 1)}
    rows = keywords.top_keywords(spark.createDataFrame(docs, "k int, t string"), "k", "t", 3)
    assert {(r["k"], r["rank"], r["word"]) for r in rows.collect()} == want
    terms = keywords.count_terms(pa.array([["x", "y", "x", "z"], None, []]))
    assert [sorted((t["word"], t["tf"]) for t in row) for row in terms.to_pylist()] == [[("x", 2), ("y", 1), ("z", 1)], [], []]
    left = keywords.likely_terms(terms, pa.array(["y"]), np.array([0.1]), 2.0, 3.0, 1).to_pylist()
    assert [[t["word"] for t in row] for row in left] == [["x"], [], []]


def test_normal_form_of_arrow_texts(spark):
    """The patterns one after the other, on whole arrays; the plan holds none of them."""
    texts = ["a-\nb c.d, 1.5,x 3-4 &quot;q&quot;", "..,", "é,9.가-7", "", None, "<skipped>{z}~`[w]\\^_ $#!\"%&(*)+/:;<=>?@"]
    plain = []
    for text in texts:
        for old, new in metrics.BLEU_LITERALS if text is not None else ():
            text = text.replace(old, new)
        for pattern, new in metrics.BLEU_PATTERNS if text is not None else ():
            text = re.sub(pattern, new, f" {text} " if pattern is metrics.BLEU_PATTERNS[0][0] else text)
        plain.append(text)
    assert metrics.bleu_normal_form(pa.array(texts)).to_pylist() == plain
    rows = spark.createDataFrame([(t, t) for t in texts], "p string, r string")
    assert "regexp_replace" not in metrics.metric_states(rows, F.col("p"), F.col("r"))._jdf.queryExecution().toString()
    assert corpus_bleu(rows, "p", "r").first()["bleu"] == 1.0
