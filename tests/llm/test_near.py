"""Near duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components
from corpusloom.llm.minhash_join import Banding, grams_of, link_counts, near_duplicates, similar_classes, words_of


def brute(rows, n=5, threshold=0.8):
    """Class (largest id) of each row by single linkage over all pairs."""
    grams = [grams_of(words_of(t or ""), n) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(grams[i] & grams[j])
            if both and both / (len(grams[i]) + len(grams[j]) - both) >= threshold:
                parent[top(i)] = top(j)
    largest = {}
    for i, (key, _) in enumerate(rows):
        largest[top(i)] = max(largest.get(top(i), key), key)
    return {key: largest[top(i)] for i, (key, _) in enumerate(rows)}


def brute_links(rows, n=5, threshold=0.8):
    """Number of different texts that each row's text is linked to."""
    grams = {tuple(words_of(t or "")): grams_of(words_of(t or ""), n) for _, t in rows}
    similar = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= threshold
    degree = {x: sum(similar(a, b) for y, b in grams.items() if x != y) for x, a in grams.items()}
    return {key: degree[tuple(words_of(t or ""))] for key, t in rows}


def family(rng, size, length, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = family(rng, 120, 150, 6) + family(rng, 30, 60, 2) + family(rng, 20, 400, 9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))) for _ in range(80)]
    texts += ["", None, "one", "one", "one two three", "One, two; THREE!"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bands", F.lit(1)).repartition(5)
    got = {r["_id"]: r for r in near_duplicates(df).collect()}
    want = brute(rows)
    assert {k: r["class_id"] for k, r in got.items()} == want
    assert {k for k, r in got.items() if r["kept"]} == set(want.values())
    assert {k: r["n_links"] for k, r in got.items()} == brute_links(rows)


def test_links_across_tiles(spark):
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 90, 120, 8) + ["one two", "one  two", None]))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit(0))
    _, links, texts = similar_classes(df, "doc_id", "text")
    found = connected_components(links, "a", "b")
    want = sum(brute_links(list(enumerate(dict.fromkeys(t or "" for _, t in rows)))).values())
    for how in ({"tile_rows": 7}, {"tile_chars": 2000}, {"tile_rows": 1}, {}):
        assert link_counts(texts, found, Banding(), **how).agg(F.sum("n_links")).first()[0] == want


def test_components_equal_search(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    least = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in range(60):
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = connected_components(spark.createDataFrame(pairs + pairs[:9], "a long, b long"), "a", "b").collect()
    assert len(got) == len(least) and {r["node"]: r["component"] for r in got} == least
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (3, text), (3, text), (4, text + " more"), (5, None), (6, "")]
    got = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and sum(r["kept"] for r in got) == 3
    assert {r["class_id"] for r in got} == {4, 5, 6}
    assert all(r["n_links"] == (1 if r["class_size"] > 1 else 0) for r in got)


def test_bands_follow_from_recall():
    b = Banding(recall=0.99, rows=4)
    missed = (1 - b.threshold**b.rows) ** b.bands
    assert missed <= 0.01 < (1 - b.threshold**b.rows) ** (b.bands - 1)
