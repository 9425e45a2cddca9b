"""The other operators against brute force, exact round trips and edge cases."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import chat_windows, guess_cost, pareto_mix, projected_nn, sentence_spans, toxic_crf, warc_store
from corpusloom.llm.merge_automaton import Automaton, ByteTokenizer, Tables, ids_digest
from corpusloom.llm.poly_fingerprint import Rolling, exact_duplicates
from corpusloom.llm.queries import QUERIES, vocabulary_path
from tests.compare import connect, difference

ROOT = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, kept string"
EDGE = [
    (1, "Same TEXT", "b", "x"), (2, "same text", None, "y"), (2, "same text", None, "y"), (None, "same text", "a", "z"),
    (3, None, "a", None), (4, "", "b", None), (5, "Ünlike\x00 text", "b", None), (6, "long " * 30_000, "a", None),
]


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, name):
    fn, sql = QUERIES[name]
    assert difference(fn(spark, ROOT), connect(ROOT), sql) is None


# ---- chat windows


@given(st.text(alphabet="<|[]\\/sINT>endSYimtar_ x"))
@settings(max_examples=500, deadline=None)
def test_escape_round_trip(text):
    assert chat_windows.unescape(chat_windows.escape(text)) == text
    assert not any(c in chat_windows.escape(text) for c in ("<|", "</s>", "[INST]", "[/INST]", "<s>"))


def test_chat_round_trip(spark):
    rng = random.Random(3)
    rows = []
    for conv in (1, 2, None, 4):
        for turn in range(60 if conv == 1 else 3):
            role = "system" if turn == 0 else ("user", "assistant")[turn % 2]
            words = rng.choices(["a", "<|end|>", "</s>[INST]", "\\", "é\n", "<|turn|>"], k=rng.randrange(60))
            rows.append((conv, turn, role, " ".join(words)))
    rows += [(5, None, None, None), (5, 1, "assistant", ""), (5, 1, "assistant", ""), (6, 0, "x\ny\\", "z " * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1))
    how = chat_windows.Windows(budget=200, history=40, history_turns=3)
    windows = chat_windows.format_windows(df, how=how)
    got = {r["conv_id"]: r for r in chat_windows.read_back(windows).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        targets = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(targets))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(targets.encode()).hexdigest()
    for w in windows.collect():
        turns = chat_windows.parse_window(w["text"])
        assert sum(how.tokens(t) for _, _, t, _ in turns) <= how.budget or sum(not a for a, *_ in turns) == 1
        if w["conv_id"] == 1 and w["window"]:
            assert turns[0][:2] == (True, "system")
    assert chat_windows.read_back(chat_windows.format_windows(df.limit(0))).count() == 0


def test_registered_chat_query(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{ROOT}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in QUERIES["op1_chat_windows"][0](spark, ROOT).collect()}
    assert set(got) == {t[0] for t in turns}
    for conv, r in got.items():
        mine = sorted(t for t in turns if t[0] == conv)
        whole = "".join(f"{role}\n{text or ''}\n" for _, _, role, text in mine)
        targets = "".join(text or "" for _, _, role, text in mine if role == "assistant")
        assert (r["n_turns"], r["loss_chars"]) == (len(mine), len(targets))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(targets.encode()).hexdigest()
    assert sum(r["n_windows"] > 1 for r in got.values()) > 3 and sum(r["n_repeated"] for r in got.values()) > 3


def test_control_strings_of_turn_templates():
    for mark in ("<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>", "<pad>", "<unk>", "<|im_start|>", "</s>", "[INST]"):
        assert mark not in chat_windows.escape(f"a{mark}b") and chat_windows.unescape(chat_windows.escape(f"a{mark}b")) == f"a{mark}b"


# ---- WARC


def test_archive_round_trip(spark):
    rows = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "u", "<p>é</p>"), (None, "u", "<p>é</p>"), (7, "u", None), (8, "u", ""), (9, "u", "b" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(0))
    payloads, records = warc_store.write_archive(pages)
    assert payloads.count() == 3
    read = warc_store.read_archive(payloads, records).collect()
    assert len(read) == len(rows) and all(r["verified"] for r in read)
    assert sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in read if r["payload_bytes"] == 9)[:2] == [(-1, "revisit", 2), (1, "revisit", 2)]
    for r in warc_store.rebuild(payloads, records).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head).group(1))
        assert rest[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
    # A payload that was changed, or lost, is found out.
    spoiled = payloads.withColumn("payload", F.when(F.octet_length("payload") == 9, F.lit(b"<p>x</p>!")).otherwise(F.col("payload")))
    for broken in (spoiled, payloads.where(F.octet_length("payload") != 9)):
        read = warc_store.read_archive(broken, records).collect()
        assert {r["page_id"] for r in read if not r["verified"]} == {1, 2, None}
        with pytest.raises(Exception, match="unsound record of page"):
            warc_store.read_archive(broken, records, strict=True).collect()
    cut = records.withColumn("header", F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "Content-Length: .*", "Content-Length: 7\r"), "UTF-8"))
    assert not any(r["verified"] for r in warc_store.read_archive(payloads, cut).collect())
    empty = warc_store.write_archive(pages.limit(0))
    assert warc_store.read_archive(*empty).count() == 0


# ---- nearest neighbours


def exact_neighbours(ids, x, k=5):
    """Best k of each query (id divisible by 50) among all other rows, in plain double sums."""
    norms = [math.sqrt(sum(c * c for c in v)) for v in x]
    out = {}
    for i in range(len(ids)):
        if ids[i] % 50 == 0:
            s = sorted((-round(sum(a * b for a, b in zip(x[i], x[j])) / norms[i] / norms[j], 12), ids[j]) for j in range(len(ids)) if j != i)
            out.setdefault(ids[i], []).append([key for _, key in s[:k]])
    return out


def test_recall_and_edges(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(9000, None), (9050, [0.0] * 24), (9100, [float("nan")] * 24), (9200, [float("-inf")] * 24), (9250, [1.0, None] * 12), (9300, []), (None, x[0].tolist())]
    short = [(9400, [1.0, 2.0]), (9450, [2.0, 4.0]), (9451, [2.0, -1.0])]
    df = spark.createDataFrame(rows + bad + short, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "rid": F.lit("x"), "p": F.lit(0)})
    how = projected_nn.Search(block=400, queries=20, sample=300)
    got = {}
    for r in sorted(projected_nn.nearest(df, "_id % 50 = 0", how=how).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact_neighbours(list(range(1500)), x.tolist())
    assert set(got) == {*want, 9400, 9450}
    assert all([rank for rank, _, _ in got[q]] == [1, 2, 3, 4, 5] for q in want)
    assert sum(len({i for _, i, _ in got[q]} & set(want[q][0])) for q in want) / (5 * len(want)) >= 0.9
    assert [i for _, i, _ in got[9400]] == [9450, 9451] and abs(got[9400][0][2] - 1) < 1e-15
    for q in list(want)[:5]:
        for _, i, score in got[q]:
            assert abs(score - float(x[q] @ x[i]) / (np.linalg.norm(x[q]) * np.linalg.norm(x[i]))) < 1e-14
    assert projected_nn.nearest(df.limit(0), "_id % 50 = 0").count() == 0


def test_ties_repeated_ids_and_extreme_vectors(spark):
    """Equal vectors tie exactly wherever they lie; the smaller id comes first."""
    rng = np.random.default_rng(7)
    kinds = rng.standard_normal((6, 13))
    rows = [(i, (kinds[i % 6] * 10.0 ** rng.choice([-200, 0, 200])).tolist()) for i in rng.permutation(600).tolist()]
    plain = [(i, kinds[i % 6].tolist()) for i in range(600, 900)] + [(50, kinds[0].tolist()), (50, kinds[0].tolist())]
    df = spark.createDataFrame(rows + plain, "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in projected_nn.nearest(df, "_id % 50 = 0", how=projected_nn.Search(block=100, queries=3)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, found in got.items():
        assert all(abs(score - 1) < 1e-12 for _, _, score in found)
        if q >= 600:
            same = sorted([i for i in range(600, 900) if i % 6 == q % 6 and i != q])
            exact = [i for _, i, s in sorted(found) if s == max(x for _, _, x in found)]
            assert exact == sorted(exact) and len(found) == 5 and set(exact) <= {*same, *range(600), 50}
    assert len(got[50]) == 15  # three rows ask, and may find one another


def test_share_of_vectors_verified():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 64))
    how = projected_nn.Search()
    found, verified = projected_nn.search_block(np.arange(4000), np.arange(4000), x, np.arange(40), x[:40], np.full(40, 4.0), how)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    scores = u[:40] @ u.T
    scores[np.arange(40), np.arange(40)] = -2
    best = np.argsort(-scores, axis=1)[:, :5]
    right = sum(len({i for q, i, _ in found if q == k} & set(best[k].tolist())) for k in range(40))
    assert right / 200 >= 0.9 and verified < 0.75 * 40 * 4000


# ---- repeated passages


def test_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    line = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 9))) + "."
    passage = [line() for _ in range(8)]
    texts = [" ".join([line() for _ in range(rng.randrange(6))] + (passage if i % 3 else []) + [line() for _ in range(3)]) for i in range(60)]
    texts += ["", None, "One. Two.", "no stop at all " * 40, "no stop at all " * 40]
    rows = list(enumerate(texts))
    runs = sentence_spans.Runs()
    places = {}
    for key, text in rows:
        s = sentence_spans.sentences_of(text or "", runs)
        for i in range(len(s) - runs.sentences + 1):
            part = s[i : i + runs.sentences]
            if sum(x[3] for x in part) >= runs.least_words:
                places.setdefault(tuple(x[0] for x in part), []).append((key, part[0][1], part[-1][2]))
    gone = {key: set() for key, _ in rows}
    for found in places.values():
        for key, start, end in sorted(found)[1:]:
            gone[key] |= set(range(start, end))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(4)
    got = {r["_id"]: r for r in sentence_spans.repeated_spans(df).collect()}
    assert {k: {i for s in r["spans"] for i in range(s["start"], s["end"])} for k, r in got.items()} == gone
    cut = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeats(df).collect()}
    assert sum(passage[3] in (t or "") for t in cut.values()) == 1
    assert sentence_spans.repeated_spans(df.limit(0)).count() == 0


# ---- toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    emit, move = rng.standard_normal(6), rng.standard_normal((2, 2))
    total, mass = 0.0, np.zeros(6)
    for code in range(64):
        y = [(code >> i) & 1 for i in range(6)]
        w = np.exp(sum(e for e, b in zip(emit, y) if b) + sum(move[a, b] for a, b in zip(y, y[1:])))
        total += w
        mass += w * np.array(y)
    p = toxic_crf.Chains(np.zeros(6, dtype=bool)).marginals(emit, move)
    assert np.allclose(p, mass / total)


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(1)
    bad = ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(None, None), (-1, ""), (-2, "you idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(9))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxic_crf.train(docs, marks)
    got = {r["_id"]: r for r in toxic_crf.score(docs, model).withColumn("h", toxic_crf.held_out()).collect()}
    held = [k for k, r in got.items() if r["h"] and k is not None and k >= 0]
    assert len(held) > 100 and all((got[k]["score"] >= 0.3) == (k % 4 == 0) for k in held)
    assert [(s["start"], s["end"]) for s in got[-2]["spans"]] == [(4, 9)]
    assert got[-1]["score"] == got[None]["score"] < 0.3
    nothing = toxic_crf.train(docs, marks.limit(0))
    assert {r["score"] for r in toxic_crf.score(docs, nothing).collect()} == {0.0}


# ---- mixing


def test_mix_edges(spark):
    df = spark.createDataFrame(EDGE, DOCS).withColumn("copies", F.lit(5))
    got = pareto_mix.mix(df).collect()
    assert len(got) == len(EDGE) and all(0 <= r["copies"] <= 2 for r in got)
    assert {r["source"]: r["source_size"] for r in got} == {"a": 30_002, "b": 4, None: 4}
    assert pareto_mix.mixed_rows(df).columns == df.columns
    assert pareto_mix.mix(df.limit(0)).count() == 0


def test_inclusion_probabilities(spark):
    """Proportional to size, expected words are those left, the largest documents certain."""
    rng = random.Random(4)
    sizes = [rng.randrange(1, 60) for _ in range(500)] + [900, 1500, 4000]
    rows = [(i, "w " * n, "a", None) for i, n in enumerate(sizes)] + [(9000, "w " * 10, "b", None)]
    got = {r["_id"]: r for r in pareto_mix.mix(spark.createDataFrame(rows, DOCS)).collect()}
    docs = [got[i] for i in range(len(sizes))]
    left = docs[0]["target"] - docs[0]["target"] // sum(sizes) * sum(sizes)
    assert 0 < left < sum(sizes)
    assert abs(sum(r["p"] * r["size"] for r in docs) - left) < 1e-6 * left
    factor = max(r["p"] / r["size"] for r in docs)
    assert all(abs(r["p"] - min(1.0, factor * r["size"])) < 1e-9 for r in docs) and max(r["p"] for r in docs) == 1.0
    whole = docs[0]["target"] // sum(sizes)
    draw = lambda i: int(hashlib.md5(f"11:{i}".encode()).hexdigest()[:13], 16) / 2**52
    ranked = sorted(range(len(sizes)), key=lambda i: (draw(i) / (1 - draw(i)) * (1 - docs[i]["p"]) / docs[i]["p"], i))
    run = 0
    for i in ranked:
        assert docs[i]["copies"] == whole + (run + sizes[i] / 2 <= left)
        run += sizes[i]


def test_mixed_rows_of_repeated_rows(spark):
    rows = [(1, "a b c", "s", f"x{i}") for i in range(7)] + [(2, "d " * 9, "s", None), (None, "e", "s", "y"), (None, "e", "s", "y")]
    df = spark.createDataFrame(rows, DOCS)
    taken = pareto_mix.mix(df).agg(F.sum("copies")).first()[0]
    assert pareto_mix.mixed_rows(df).count() == taken


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 200), f"s{min(i % 7, 2)}", None) for i in range(4000)]
    got = pareto_mix.mix(spark.createDataFrame(rows, DOCS)).groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 100 for r in got)


# ---- tokenization automaton


def merged(word, ranks):
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not pairs:
            return word
        (_, new), i = min(pairs, key=lambda x: (x[0][0], x[1]))
        word = [*word[:i], new, *word[i + 2 :]]


@given(st.integers(0, 10**6), st.lists(st.sampled_from("abc"), min_size=1, max_size=14))
@settings(max_examples=400, deadline=None)
def test_automaton_equals_merging(seed, word):
    rng = random.Random(seed)
    labels = {0: b"a", 1: b"b", 2: b"c"}
    merges = []
    for _ in range(rng.randrange(12)):
        u, v = rng.choice(list(labels)), rng.choice(list(labels))
        if labels[u] + labels[v] not in labels.values():
            labels[len(labels)] = labels[u] + labels[v]
            merges.append((u, v, len(labels) - 1))
    automaton = Automaton([(0, 97), (1, 98), (2, 99)], merges, labels)
    ranks = {(u, v): (i, uv) for i, (u, v, uv) in enumerate(merges)}
    want = merged(["abc".index(c) for c in word], ranks)
    assert automaton.path("".join(word).encode()) == want
    # All words at once, long ones included.
    words = ["".join(word), "", "".join(word[::-1]), "".join(word) * 40]
    found = [np.frombuffer(x, np.int32).tolist() for x in Tables(automaton).paths([w.encode() for w in words])]
    assert found[0] == want and found == [automaton.path(w.encode()) for w in words]


def test_encode_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    texts = [r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    texts += ["", None, "a  b \n\n c\x1c\x85", "<|endoftext|>x<|endoftext|>", "日本🙂", "a" * 50_000, "I'm we'LL"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = ByteTokenizer(spark, vocabulary_path())
    for r in tokenizer.decode(tokenizer.encode(df)).withColumn("d", ids_digest()).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
        assert r["d"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


# ---- exact duplicates


@given(st.binary(max_size=300), st.integers(1, 50))
@settings(max_examples=200, deadline=None)
def test_fingerprints_compose(data, cut):
    r = Rolling(chunk_bytes=16)
    one = Rolling(chunk_bytes=1024)
    assert r.whole(data) == one.whole(data)
    assert r.combine(r.whole(data[:cut]), r.whole(data[cut:]), len(data[cut:])) == r.whole(data)


def test_collisions_are_told_apart(spark):
    df = spark.createDataFrame(EDGE + [(10 + i, f"text {i % 9}", "s", None) for i in range(60)], DOCS)
    want = {}
    for row in df.collect():
        want.setdefault((row["text"] or "").translate({c: c + 32 for c in range(65, 91)}), []).append(row["doc_id"])
    weak = Rolling(moduli=(3, 2), bases=(1, 1), chunk_bytes=64)
    for rolling, huge in ((Rolling(), 8 << 20), (weak, 1 << 20), (weak, 4)):
        got = exact_duplicates(df, rolling=rolling, huge_bytes=huge, salt_rows=4).collect()
        assert len(got) == df.count() and sum(r["kept"] for r in got) == len(want)
        by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
        for r in got:
            ids = by_sha[r["text_sha256"]]
            assert r["group_size"] == len(ids) and r["keep_id"] == max(i for i in ids if i is not None)
    assert exact_duplicates(df.limit(0)).count() == 0


# ---- secrets


def naive_base(text):
    found = [(m.start(), 0, m.end()) for m in guess_cost.ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_secrets(spark):
    texts = [
        None, "", 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"', "AKIA" + "A1" * 8, "pwd: x9$Kq!27vLp.", "PASSWORD=Ab.cdefgh1",
        "passphrase: password123", "ſecret=abcdefgh1", "the secret of life", "x" * 100_000 + " api-key api_key:zz9zz9zz9 " + "0f" * 20,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("secrets", F.lit(1))
    got = {r["_id"]: r for r in guess_cost.scan(df).collect()}
    for i, text in enumerate(texts):
        assert got[i]["base_sha256"] == hashlib.sha256(naive_base(text or "").encode()).hexdigest()
    assert [(s["kind"], s["start"]) for s in got[4]["secrets"]] == [("guess", 5)]
    assert got[6]["secrets"] == [] and got[8]["secrets"] == []


def brute_cost(value, ranks):
    """The least cost over all cuts, by trying every piece at every place."""
    low = value.lower()

    @functools.cache
    def rest(i, in_single):
        if i == len(value):
            return 0.0
        best = rest(i + 1, True) + guess_cost.SINGLE + (0 if in_single else guess_cost.PIECE)
        for j in range(i + 2, len(value) + 1):
            word, prices = low[i:j], []
            if j - i >= 3 and len(set(word)) == 1:
                prices.append(math.log10(10 * (j - i)))
            if j - i >= 3 and all(a + b in guess_cost._NEXT for a, b in zip(word, word[1:])):
                prices.append(math.log10(40 * (j - i)))
            if word in ranks:
                prices.append(math.log10(ranks[word]) + (0.5 if value[i:j] != word else 0))
            if guess_cost._DATE.fullmatch(value[i:j]):
                prices.append(math.log10(365 * 40))
            best = min([best, *(rest(j, False) + p + guess_cost.PIECE for p in prices)])
        return best

    return rest(0, False)


def test_cost_is_the_minimum_over_all_cuts():
    rng = random.Random(1)
    ranks = guess_cost.ranked_words(["zmy", "cat", "aaaa", "xyzzy"])
    parts = ["abc", "xxx", "pass", "1999", "2001-05", "qwe", "Z", "zmy", "a", "1", "q", "w", "aaaa"]
    for _ in range(3000):
        value = "".join(rng.choice([*parts, chr(rng.randrange(33, 127))]) for _ in range(rng.randrange(1, 9)))
        assert abs(guess_cost.guess_cost(value, ranks) - brute_cost(value, ranks)) < 1e-9
    assert guess_cost.guess_cost("a" * 50_000) < 6 and guess_cost.guess_cost("qw" * 5_000) > 50


def test_contexts_and_corpus_words(spark):
    texts = ["Authorization: Bearer x9Kq27vLpZ", "see postgres://me:h7Gk2pQw9z@host/db", "password = zebrazebra", "x-api-key: Tr0ub4dor&3xyz", "time: 12:30"]
    texts += ["the zebra ran"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit(1))
    assert guess_cost.corpus_words(df, most=3) == ["ran", "the", "zebra"]
    got = {r["_id"]: [(s["kind"], texts[r["_id"]][s["start"] : s["end"]]) for s in r["secrets"]] for r in guess_cost.scan(df).collect()}
    assert got[0] == [("guess", "x9Kq27vLpZ")] and got[1] == [("guess", "h7Gk2pQw9z")]
    assert got[2] == [("assign", "password = zebrazebra")] and got[3] == [("guess", "Tr0ub4dor&3xyz")] and got[4] == []
    again = df.union(df).union(spark.createDataFrame([(None, None, 1), (None, "", 1)], df.schema))
    assert guess_cost.scan(again).count() == 2 * len(texts) + 2 and guess_cost.scan(df.limit(0)).count() == 0


def test_cost_prefers_the_cheapest_cut():
    assert guess_cost.guess_cost("") == 0
    assert guess_cost.guess_cost("password2021") < guess_cost.guess_cost("pxsswqrd2q21")
    assert guess_cost.guess_cost("aaaaaaaa") < 4 and guess_cost.guess_cost("qwertyui") < 4
    assert guess_cost.guess_cost("x9$Kq!27vLp") > 10


# ---- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    ids = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        last, docs = docs, stage(spark, docs, ROOT)
        if name != "BPE encoding":
            assert docs.columns == last.columns
        rows = [r["doc_id"] for r in docs.collect()]
        assert set(rows) <= ids
        if name != "mixing sources" and name != "BPE encoding":
            assert len(set(rows)) == len(rows)
            ids = set(rows)


def test_marked_words_are_those_of_plain_counts():
    """Words far more frequent in toxic documents, by themselves or by a beginning, from numbers instead of strings."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "vilest", "vile", "vilely", "go", "x.", "Vilenesses"], [9, 9, *[6 * (i % 2)] * 3, 5, 2, 3 * (i % 2)], k=12)) for i in range(40)]
    y = np.arange(40) % 2
    settings = toxic_crf.Settings(ratio=3.0)
    vocabulary = {"\n": 0}
    numbered = [toxic_crf._numbered(t, vocabulary) for t in texts]
    marked = toxic_crf._marked(numbered, y, vocabulary, settings)
    shares = [Counter(), Counter()]
    for text, label in zip(texts, y):
        shares[label].update({f for w in set(toxic_crf.TOKEN.findall(text.lower())) - toxic_crf.BREAKS for f in toxic_crf.features(w)})
    few = max(settings.least, settings.least_share * 20)
    for word, i in vocabulary.items():
        telling = [f for f in toxic_crf.features(word) if f[0] != "s" and shares[1][f] >= few and (shares[1][f] + 0.1) / 20 > 3.0 * (shares[0][f] + 0.5) / 20]
        assert marked[i] == (word not in toxic_crf.BREAKS and bool(telling))
    assert marked.any() and not marked.all()


def test_training_holds_no_strings_of_the_whole_sample():
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(400)) for _ in range(300)]
    tracemalloc.start()
    toxic_crf.fit(texts, [i % 2 for i in range(300)], 0.5, toxic_crf.Settings(buckets=1 << 10, epochs=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
