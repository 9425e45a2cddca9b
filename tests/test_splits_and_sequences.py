from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.arrays import (
    IGNORED,
    find_pattern,
    last_tokens,
    response_labels,
    strip_prompt,
    truncate,
)
from corpusloom.operators import positions
from corpusloom.operators.positions import hash_cut, key_at, repeatable_hash, running_total, with_next
from corpusloom.operators.sequences import (
    context_rows,
    pad_batches,
    random_blocks,
    stream_cut,
    stream_length,
    stream_offsets,
    stream_rows,
    stream_split,
    token_stream,
)
from corpusloom.operators.splits import (
    ordered_split,
    random_split,
    sample_k,
    seq_batches,
    shuffled_batches,
    train_eval,
)


def digest(seed, *key):
    return hashlib.md5(":".join(str(k) for k in (seed, *key)).encode()).hexdigest()


def keys(spark, n, partitions):
    return spark.range(0, n * 3, 3).withColumnRenamed("id", "k").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_running_total_over_two_keys(spark, partitions):
    rows = [(a, b, (a * 7 + b) % 5) for a in range(20) for b in range(10)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "a int, b int, w int").repartition(partitions)
    got = {(r["a"], r["b"]): r["t"] for r in running_total(df, ["a", "b"], "w", "t").collect()}
    total = 0
    for a, b, w in sorted(rows):
        assert got[a, b] == total
        total += w
    index = {(r["a"], r["b"]): r["row_index"] for r in running_total(df, ["a", "b"]).collect()}
    assert [index[a, b] for a, b, _ in sorted(rows)] == list(range(len(rows)))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_random_split(spark, partitions):
    n = 101
    marked = random_split(keys(spark, n, partitions), ["k"], 0.1, 7)
    parts = {r["k"]: r["split"] for r in marked.collect()}
    expected = sorted(range(0, n * 3, 3), key=lambda k: (digest(7, k), k))[: math.ceil(0.1 * n)]
    assert len(parts) == n and {k for k, s in parts.items() if s == "test"} == set(expected)


def test_train_eval(spark):
    df = keys(spark, 50, 3)
    train, test = train_eval(df, ["k"], test_fraction=0.2)
    assert test.count() == 10 and train.count() == 40 and train.join(test, "k").count() == 0
    assert train_eval(df, ["k"], need_eval=False) == (df, None)
    for fraction in (0, 1, -0.1, 1.5):
        with pytest.raises(ValueError):
            train_eval(df, ["k"], test_fraction=fraction)
    assert random_split(keys(spark, 1, 1), ["k"]).first()["split"] == "test"
    assert random_split(keys(spark, 0, 1), ["k"]).count() == 0


def test_hash_cut_with_equal_hashes_and_two_keys(spark):
    df = spark.createDataFrame([(i, str(j)) for i in range(8) for j in range(8)], "a int, b string")
    ranked = sorted(((digest(3, a, b), a, b) for a in range(8) for b in map(str, range(8))))
    for rank in (0, 1, 31, 63):
        assert hash_cut(df, ["a", "b"], 3, rank).values == ranked[rank]
    assert hash_cut(df, ["a", "b"], 3, 64).values is None


def test_key_at_every_rank(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, -(2**62), 2**62, 0, 7, rng.randrange(10**6)]), rng.choice(["", "a", "ab", "zé", "日本", "ab" * 9])) for _ in range(60)]
    rows = [(a, b, i) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, "a long, b string, c int").repartition(3)
    place = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    few = positions.FEW_ROWS
    try:
        positions.FEW_ROWS = 1  # so that every step is taken
        for order in (["a", "b", "c"], ["b", "c"]):
            want = sorted([tuple(dict(zip("abc", r))[c] for c in order) for r in rows], key=lambda r: [place(v) for v in r])
            for rank in (0, 31, 59):
                assert key_at(df, order, rank) == want[rank]
            assert key_at(df, order, 60) is None
    finally:
        positions.FEW_ROWS = few
    assert key_at(df.limit(0), ["a"], 0) is None
    with pytest.raises(TypeError, match="type double"):
        key_at(df.withColumn("d", F.lit(1.5)), ["d"], 0)


def test_next_rows(spark):
    rng = random.Random(6)
    rows = sorted({(rng.randrange(9), rng.randrange(400), str(rng.randrange(5))) for _ in range(300)})
    rows = list({r[:2]: r for r in rows}.values())
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "a int, b long, v string").repartition(4)
    size = positions.RANGE_ROWS
    try:
        for positions.RANGE_ROWS in (60, 10**6):
            got = sorted(with_next(df, ["a", "b"]).collect())
            assert [tuple(r[:3]) for r in got] == rows
            assert [tuple(r[3:]) for r in got] == [*rows[1:], (None, None, None)]
            index = {(r["a"], r["b"]): r["row_index"] for r in running_total(df, ["a", "b"]).collect()}
            assert [index[r[:2]] for r in rows] == list(range(len(rows)))
    finally:
        positions.RANGE_ROWS = size
    assert with_next(df.limit(0), ["a", "b"]).count() == 0


@pytest.mark.parametrize("n, train", [(0, 0), (1, 0), (9, 8), (10, 9), (101, 90)])
def test_ordered_split(spark, n, train):
    parts = {r["k"]: r["split"] for r in ordered_split(keys(spark, n, 3), ["k"]).collect()}
    assert sorted(k for k, s in parts.items() if s == "train") == sorted(parts)[:train]


def test_batches(spark):
    rows = seq_batches(keys(spark, 10, 3), ["k"], 4).orderBy("k").collect()
    assert [(r["batch_id"], r["row_in_batch"]) for r in rows] == [(i // 4, i % 4) for i in range(10)]
    orders = []
    for epoch in (0, 1):
        first = shuffled_batches(keys(spark, 70, 2), ["k"], 32, 5, epoch).orderBy("row_index").collect()
        again = shuffled_batches(keys(spark, 70, 8), ["k"], 32, 5, epoch).orderBy("row_index").collect()
        assert [r["k"] for r in first] == [r["k"] for r in again]
        assert [r["k"] for r in first] == sorted(range(0, 210, 3), key=lambda k: digest(f"5:{epoch}", k))
        orders.append([r["k"] for r in first])
    assert orders[0] != orders[1]


def test_sample(spark):
    df = keys(spark, 30, 3)
    assert {r["k"] for r in sample_k(df, ["k"], 5, 1).collect()} == set(
        sorted(range(0, 90, 3), key=lambda k: digest(1, k))[:5]
    )
    assert sample_k(df, ["k"], 99).count() == 30 and sample_k(df, ["k"], -1).count() == 0


def value(spark, expression, ids):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    return df.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "ids, pattern, start",
    [([1, 2], [1, 2, 3], -1), ([1, 2, 3], [1, 2], 0), ([1, 2, 3], [2, 3], 1), ([1, 2, 3], [3, 2], -1),
     ([5, 1, 1, 2, 1, 1, 2], [1, 1, 2], 1), ([1, 1, 2], [1, 2], 1), ([], [1], -1), ([], [], 0), ([4], [4], 0)],
)
def test_find_pattern(spark, ids, pattern, start):
    assert value(spark, find_pattern(F.col("ids"), pattern), ids) == start


def test_response_labels(spark):
    ids = F.col("ids")
    assert value(spark, response_labels(ids, [7, 8]), [1, 7, 8, 2, 7, 8, 3]) == [IGNORED] * 3 + [2, 7, 8, 3]
    assert value(spark, response_labels(ids, [7]), [7]) == [IGNORED]
    assert value(spark, response_labels(ids, [9], strict=False), [1, 2]) is None
    with pytest.raises(Exception, match="response marker not found"):
        value(spark, response_labels(ids, [9]), [1, 2])


def test_slices(spark):
    ids = F.col("ids")
    assert value(spark, truncate(ids, 2), [1, 2, 3]) == [1, 2]
    assert value(spark, last_tokens(ids, 2), [1, 2, 3]) == [2, 3]
    assert value(spark, last_tokens(ids, 9), [1, 2, 3]) == [1, 2, 3]
    assert value(spark, strip_prompt(ids, F.lit(1)), [1, 2, 3]) == [2, 3]
    assert value(spark, strip_prompt(ids, F.lit(5)), [1, 2, 3]) == []


def test_context_rows(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4]), (2, [5])], "k int, ids array<int>")
    rows = [(r["t"], r["context"], r["target"]) for r in context_rows(df, ["k"], "ids", 2).orderBy("t").collect()]
    assert rows == [(0, [1], 2), (1, [1, 2], 3)]


def test_padding(spark):
    df = spark.createDataFrame(
        [(0, [1, 2, 3], [1, 1, 1], [-100, 2, 3]), (0, [4], [1], [4]), (1, [5], [1], [5])],
        "batch_id int, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    rows = sorted(tuple(map(tuple, r[1:])) for r in pad_batches(df, pad_id=9).collect())
    assert rows == [
        ((1, 2, 3), (1, 1, 1), (-100, 2, 3)),
        ((4, 9, 9), (1, 0, 0), (4, -100, -100)),
        ((5,), (1,), (5,)),
    ]


@pytest.fixture(scope="module")
def stream(spark):
    """Rows of very different length, one with a third of all tokens, some empty."""
    rng = random.Random(4)
    lengths = [0, 3, 0, 1, 40, 2, 0, 7, 1, 1, 30, 0]
    rows = [(i * 2, [rng.randrange(100) for _ in range(n)]) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k int, ids array<int>").repartition(3)
    flat = [t for _, ids in rows for t in ids]
    return df, flat, stream_offsets(df, ["k"], F.size("ids"))


@pytest.mark.parametrize("chunk", [1, 4, 16, 1000])
def test_token_stream(spark, stream, chunk):
    df, flat, offsets = stream
    assert stream_length(offsets) == len(flat)
    chunks = token_stream(df, F.col("ids"), offsets, ["k"], chunk)
    got = {r["chunk_id"]: (r["start_pos"], r["tokens"]) for r in chunks.collect()}
    assert got == {i // chunk: (i, flat[i : i + chunk]) for i in range(0, len(flat), chunk)}
    assert {r["pos"]: r["token"] for r in stream_rows(chunks).collect()} == dict(enumerate(flat))


@pytest.mark.parametrize("position", [0, 1, 3, 20, 44, 84, 85])
def test_stream_split(spark, stream, position):
    df, flat, offsets = stream
    cut = stream_cut(offsets, ["k"], position)
    parts = stream_split(df, F.col("ids"), cut).orderBy("k").collect()
    assert [t for r in parts if r["split"] == "train" for t in r["tokens"]] == flat[:position]
    assert [t for r in parts if r["split"] == "test" for t in r["tokens"]] == flat[position:]


@pytest.mark.parametrize("grid", [2, 16, 65_536])
def test_random_blocks(spark, stream, grid):
    df, flat, offsets = stream
    drawn = random_blocks(spark, df, F.col("ids"), offsets, ["k"], 50, 6, seed=9, low=2, high=80, grid=grid)
    rows = drawn.collect()
    assert sorted(r["sample_id"] for r in rows) == list(range(50))
    for r in rows:
        s = 2 + int(digest(9, r["sample_id"])[:15], 16) % (78 - 6)
        assert (r["start"], r["x"], r["y"]) == (s, flat[s : s + 6], flat[s + 1 : s + 7])
    with pytest.raises(ValueError, match="not longer than one block"):
        random_blocks(spark, df, F.col("ids"), offsets, ["k"], 1, 85)


def test_hash_is_the_same_in_any_engine(spark):
    row = spark.range(1).select(repeatable_hash(42, F.lit(7), F.lit("x")).alias("h")).first()
    assert row["h"] == digest(42, 7, "x")
