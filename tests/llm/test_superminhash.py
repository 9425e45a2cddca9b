"""SuperMinHash groups against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.superminhash import Near, _mixed, _WordHashes, near_groups, pairs_by_differences, shingle_hashes, shingles_of, signatures, sketches, with_common, words_of

SCHEMA = "doc_id long, text string"


def brute(rows, near=Near()):
    sets = [shingles_of(words_of(t or ""), near.n) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= near.percent * (len(sets[i]) + len(sets[j]) - both):
                top[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key)
    return {key: (len(sets[i]), least[root(i)]) for i, (key, _) in enumerate(rows)}


def family(rng, size, length, edits):
    base = [f"w{rng.randrange(4000)}" for _ in range(length)]
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"X{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = family(rng, 100, 150, 9) + family(rng, 40, 60, 3) + family(rng, 20, 500, 20) + family(rng, 30, 12, 1)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))) for _ in range(90)]
    texts += ["", None, "one", "One", "one two", "ONE\u000btwo", "one two three", "one two three one two three", "Été x y", "été x y"]
    texts += texts[:15]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"component": F.lit(1), "rid": F.lit("x"), "_th": F.lit(0), "a`b": F.lit(0)}).repartition(5)
    got = {r["_id"]: r for r in near_groups(df).collect()}
    want = brute(rows)
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in got.items()} == want
    assert all(r["kept"] == (k == want[k][1]) for k, r in got.items())


@pytest.mark.parametrize("seed, edits", [(9, 6), (10, 16), (11, 30)])
def test_pairs_by_differences_lose_no_link(spark, seed, edits):
    """All links of pairs of which one is not linked to the lead, for several leads and tile sizes."""
    rng, near = random.Random(seed), Near()
    texts = sorted(set(family(rng, 50, 120, edits)))
    # Pairs that share their edits, and a common passage.
    texts += [t + " tail of two" for t in texts[:12]] + [" ".join(t.split()[:70] + [f"own{i}"] * 3) for i, t in enumerate(texts[12:24])]
    sets = {i: shingles_of(words_of(t), near.n) for i, t in enumerate(texts)}
    linked = lambda a, b: near.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b]))
    codes = {s: i for i, s in enumerate(sorted(set().union(*sets.values())))}
    coded = {i: {codes[s] for s in v} for i, v in sets.items()}
    rows, want = [], set()
    for lead in (0, 7, 40):
        rows += [(lead, i, i, len(coded[lead]), sorted(coded[lead] - v), sorted(v - coded[lead])) for i, v in coded.items() if i != lead]
        want |= {(a, b) for a in sets for b in sets if a < b and lead not in (a, b) and linked(a, b) and not (linked(a, lead) and linked(b, lead))}
    df = spark.createDataFrame(rows, "lead long, rid long, component long, size long, removed array<long>, added array<long>")
    found = [{(r["a"], r["b"]) for r in pairs_by_differences(df, near, tile_rows=t).collect()} for t in (1, 7, 2048)]
    assert found[0] == found[1] == found[2] >= want and want
    assert pairs_by_differences(df.withColumn("component", F.lit(5).cast("long")), near).count() == 0


def test_common_shingles_bound(spark):
    near = Near()
    shingles = spark.createDataFrame([(1, s) for s in range(20)] + [(2, s) for s in range(3, 23)] + [(3, s) for s in range(40, 60)] + [(4, 0)], "rid long, s long")
    rows = spark.createDataFrame([(1, 1, 20), (2, 2, 20), (3, 3, 20), (4, 4, 1)], "rid long, component long, n_shingles long")
    assert {r["rid"] for r in with_common(rows, shingles, near).collect()} == {1, 2, 4}


def test_signatures_equal_one_by_one():
    near, rng = Near(), random.Random(4)
    texts = [[f"w{rng.randrange(40)}" for _ in range(n)] for n in (0, 1, 2, 3, 9, 30, 45)]
    owner, x = shingle_hashes(texts, near.n, _WordHashes())
    got = signatures(owner, x, len(texts), near.registers, near.seed)
    for t in range(len(texts)):
        want = [(1 << 64) - 1] * near.registers
        for h in x[owner == t]:
            seed = int(_mixed(np.array([h], np.uint64) ^ np.uint64(near.seed))[0])
            p = list(range(near.registers))
            for j in range(near.registers):
                draw = int(_mixed(np.array([(seed + j * 0x9E3779B97F4A7C15) % (1 << 64)], np.uint64))[0])
                k = j + (((draw >> 40) * (near.registers - j)) >> 24)
                p[j], p[k] = p[k], p[j]
                want[p[j]] = min(want[p[j]], (j << 32) | (draw & 0xFFFFFFFF))
        assert got[t].tolist() == want


def test_estimate_has_less_variance_than_plain_minhash():
    near, errors = Near(), []
    for seed in range(150):
        x = np.random.default_rng(seed).integers(0, 1 << 63, 200).astype(np.uint64)
        a, b = x[:170], x[30:]
        table = signatures(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2, near.registers, near.seed)
        errors.append(float((table[0] == table[1]).mean()) - 0.7)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < np.sqrt(0.7 * 0.3 / near.registers)
    assert near.bands * near.rows == near.registers and (1 - 0.85**near.rows) ** near.bands <= 1 - near.recall
    assert sketches(table).shape == (2, 3)


def test_nulls_repeats_and_empty(spark):
    assert near_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (7, text), (7, text), (3, text.upper()), (8, None), (9, ""), (None, "solo"), (None, None)]
    got = near_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 8 and sum(r["kept"] for r in got) == 5
    assert sorted((str(r["_id"]), r["n_shingles"], r["component_id"]) for r in got) == sorted(
        [("None", 28, 3), ("7", 28, 3), ("7", 28, 3), ("3", 28, 3), ("8", 0, 8), ("9", 0, 9), ("None", 1, None), ("None", 0, None)]
    )


def test_very_long_texts(spark):
    words = [f"w{i % 9973}x{i % 31}" for i in range(120_000)]
    other = list(words)
    other[500] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:60_000]))]
    got = {r["_id"]: r["component_id"] for r in near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_differences_are_not_joined_back_to_their_sets(spark, monkeypatch):
    """A set's figures stay beside its differences: no join by set makes a row for every difference."""
    schema = "lead long, rid long, component long, size long, removed array<long>, added array<long>"
    sets = [(1, r, r, 20, [1, 2, 3, 4], [100 + r % 2, 200]) for r in range(2, 8)]
    joins, kind = [], type(spark.range(0))
    plain = kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, how=None: joins.append((str(on), how)) or plain(self, other, on, how))
    pairs_by_differences(spark.createDataFrame(sets, schema), Near())
    assert joins and ("['lead', 'rid']", None) not in joins
