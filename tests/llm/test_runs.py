"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries
from corpusloom.llm.tandem_runs import BATCH_WORDS, WORD, RunLimits, collapsed, find_runs, strongest, text_runs

ROOT = "/root/testdata/sf0.001"


def brute(words, limits=RunLimits()):
    """Every longest stretch with a period, by its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 2 * q:
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    rows = [(s, length, q) for (s, length), q in found.items() if length >= max(limits.length, limits.exponent * q)]
    return sorted(rows, key=lambda r: (r[0], r[2]))


def random_text(rng, longest=120):
    n, kinds = rng.choice([0, 1, 2, 5, 17, 60, longest]), rng.choice([1, 2, 3, 5, 50])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    if n > 4 and rng.random() < 0.5:
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 4))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n) if a + (i - a) % p < n]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for limits in (RunLimits(), RunLimits(2, 2), RunLimits(1, 3)):
        for _ in range(60):
            texts = [random_text(rng) for _ in range(rng.randrange(1, 10))]
            assert text_runs(texts, limits) == [brute(t, limits) for t in texts]


def test_equal_texts_side_by_side_do_not_touch():
    text = "a b a b a b a b".split()
    assert text_runs([text] * 3 + [[], ["a"]]) == [[(0, 8, 2)]] * 3 + [[], []]


def test_very_long_texts():
    assert text_runs([["x"] * (BATCH_WORDS + 5)]) == [[(0, BATCH_WORDS + 5, 1)]]
    words = [f"w{i}" for i in range(30_000)] + ["a", "b", "c"] * 9_000
    assert text_runs([words, ["q"] * 6]) == [[(30_000, 27_000, 3)], [(0, 6, 1)]]


def test_strongest_and_collapsed():
    assert strongest([]) is None
    assert strongest([(9, 12, 2), (3, 6, 1), (1, 12, 2)]) == (1, 12, 2)
    words = "x a b a b a b a b y".split()
    assert collapsed(words, brute(words)) == "x a b y"
    assert collapsed([], []) == ""


def test_rows_nulls_and_other_columns(spark):
    text = "go " * 7 + "on"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, " \t\n"), (5, "no-break space"), (6, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "_id": F.lit("x"), "a.b": F.lit(2)})
    got = sorted(find_runs(df).collect(), key=repr)
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["_id"], []).append(r)
    assert [len(by_id[1]), len(by_id[None])] == [2, 1]
    for r in by_id[1] + by_id[None]:
        assert [tuple(x) for x in r["runs"]] == [(0, 7, 1)] and tuple(r["best"]) == (0, 7, 1)
        assert (r["collapsed"], r["n_words"]) == ("go on", 8)
    for key, n, left in ((2, 0, ""), (3, 0, ""), (4, 0, ""), (5, 1, "no-break space"), (6, 2, "one two")):
        (r,) = by_id[key]
        assert (r["n_words"], r["runs"], r["best"], r["collapsed"]) == (n, [], None, left)
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query_equals_brute_force(spark):
    docs = pq.read_table(f"{ROOT}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r["doc_id"]: r for r in queries.op11(spark, ROOT).collect()}
    assert len(got) == len(docs)
    with_tail = 0
    for doc in docs:
        words = WORD.findall(doc["text"] or "")
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = words[a + (i - a) % p]
            with_tail += 1
        # The search is quadratic, so the longest texts are compared where runs are given.
        runs = brute(words) if n <= 1500 else [tuple(r) for r in text_runs([words])[0]]
        r = got[doc["doc_id"]]
        best = strongest(runs) or (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert with_tail > 5
