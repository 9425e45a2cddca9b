"""Byte-pair vocabulary, next-token table, generation, scoring and routing."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import chars
from corpusloom.operators import bpe, bpe_training
from corpusloom.operators.bpe_training import train_bpe
from corpusloom.operators.generation import (
    adapter_models,
    generate,
    generate_from,
    pack_model,
    route_to_adapters,
    score_prompts,
    top_p_filter,
)
from corpusloom.operators.merging import MergeTable, merge_one, merge_words
from corpusloom.operators.ngram import bigram_loss, bigram_model, boundary_tokens, pair_counts
from corpusloom.operators.sequences import stream_cut, stream_length, stream_offsets
from corpusloom.operators.vocabulary import word_freq
from corpusloom.plans import tokens
from corpusloom.plans.common import documents, rendered_pairs
from corpusloom.plans.registry import load_all
from corpusloom.plans.sequences import MARKER
from tests import bpe_sql
from tests.compare import connect, difference

QUERIES = load_all()


def one_by_one(counts: dict[str, int], specials, merges: int):
    """Plain training: count everything again after every single merge."""
    tokens = [*specials, *sorted({c for w in counts for c in w})]
    codes = {t: i for i, t in enumerate(tokens)}
    words = [([codes[c] for c in w], n) for w, n in counts.items()]
    done = []
    while len(done) < merges:
        pairs = Counter()
        for ids, n in words:
            for pair in zip(ids, ids[1:]):
                pairs[pair] += n
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p))
        merged = tokens[a] + tokens[b]
        if merged not in codes:
            codes[merged] = len(tokens)
            tokens.append(merged)
        done.append((a, b, codes[merged]))
        again = []
        for ids, n in words:
            out = []
            for i in ids:
                if out and (out[-1], i) == (a, b):
                    out[-1] = codes[merged]
                else:
                    out.append(i)
            again.append((out, n))
        words = again
    return tuple(tokens), tuple(done)


BOUNDS = [dict(looked_at=50, fetched_words=0, neighbours_of=50), dict(looked_at=4, fetched_words=6, neighbours_of=3), {}]


@pytest.mark.parametrize("seed, letters, bounds, merges", [(0, "ab", 0, 5), (1, "abc", 1, 6), (2, "abcdefgh가나", 2, 25)])
def test_training_in_rounds_equals_one_by_one(spark, seed, letters, bounds, merges):
    rng = random.Random(seed)
    counts = Counter("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(120))
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    tokenizer = train_bpe(table, max_merges=merges, **BOUNDS[bounds])
    assert (tokenizer.tokens, tokenizer.merges) == one_by_one(counts, bpe.SPECIAL_TOKENS, merges)


def test_pieces_reach_the_driver_not_words(spark, monkeypatch):
    """576 words hold one pair, more than may be fetched: it is one piece, and no round needs bounds."""
    letters = "cdefghijklmnopqrstuvwxyz"
    counts = {"ab" + x + y: 1 + (x < y) for x in letters for y in letters} | {"aaaa": 600, "aaaaa": 1}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows, plain = [], bpe_training.merges_in_words
    monkeypatch.setattr(bpe_training, "merges_in_words", lambda pieces, *rest: rows.append(len(pieces)) or plain(pieces, *rest))
    monkeypatch.setattr(bpe_training, "merges_by_bounds", None)
    tokenizer = train_bpe(table, max_merges=6, looked_at=2, fetched_words=30)
    assert (tokenizer.tokens, tokenizer.merges) == one_by_one(counts, bpe.SPECIAL_TOKENS, 6)
    assert max(rows) <= 30 and len(rows) <= 6


def in_rounds(counts, merges, looked_at, fetched_words, neighbours_of):
    """The rounds of the trainer without Spark."""
    vocabulary = bpe_training._Vocabulary(sorted({c for w in counts for c in w}), 1 << 30, merges)
    words = [([vocabulary.codes[c] for c in w], n) for w, n in counts.items()]
    while not vocabulary.full:
        pairs, held = Counter(), Counter()
        for ids, n in words:
            for pair, times in Counter(zip(ids, ids[1:])).items():
                pairs[pair] += n * times
                held[pair] += 1
        top = sorted(((*p, n) for p, n in pairs.items()), key=lambda t: (-t[2], t[:2]))[: looked_at + 1]
        if not top:
            break
        few = min(int(np.searchsorted(np.cumsum([held[t[:2]] for t in top]), fetched_words, side="right")), looked_at)
        ranked = top[:few] if few else top[:neighbours_of]
        rest = top[len(ranked)] if len(ranked) < len(top) else None
        limit = (-rest[2], *rest[:2]) if rest else None
        known = {t[:2]: t[2] for t in ranked}
        if few:
            inside = [(ids, n) for ids, n in words if any(p in known for p in zip(ids, ids[1:]))]
            steps = bpe_training.merges_in_words(inside, known, limit, vocabulary)
        else:
            place, beside = {t[:2]: p for p, t in enumerate(ranked)}, defaultdict(Counter)
            for ids, n in words:
                for i, pair in enumerate(zip(ids, ids[1:])):
                    if pair in place and i > 0:
                        beside[place[pair], 0][ids[i - 1]] += n
                    if pair in place and i + 2 < len(ids):
                        beside[place[pair], 1][ids[i + 2]] += n
            steps = bpe_training.merges_by_bounds(ranked, {k: list(c.items()) for k, c in beside.items()}, limit, vocabulary)
        assert steps
        table = MergeTable(steps)
        words = [(merge_words(np.array(ids), np.zeros(len(ids)), table)[0].tolist(), n) for ids, n in words]
    return tuple(vocabulary.tokens), tuple(vocabulary.merges)


def test_every_round_is_exact():
    """Against plain merging on many small random corpora, for all kinds of rounds."""
    rng = random.Random(5)
    for _ in range(150):
        letters = "abcde"[: rng.randint(1, 5)]
        counts = Counter("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 50)))
        want = one_by_one(counts, (), 25)
        for bounds in ((50, 0, 50), (3, 0, 2), (4, 6, 3), (100, 1000, 5), (10, 12, 10)):
            assert in_rounds(counts, 25, *bounds) == want


def test_words_merge_at_once_as_one_by_one():
    rng = random.Random(1)
    for _ in range(400):
        k = rng.randint(1, 4)
        merges = [(rng.randrange(k + i), rng.randrange(k + i), k + i) for i in range(rng.randint(1, 6))]
        words = [[rng.randrange(k) for _ in range(rng.choice([0, 1, 3, 9, 1500]))] for _ in range(rng.randint(1, 5))]
        table = MergeTable(merges)
        ids, word = merge_words(np.array(sum(words, [])), np.repeat(np.arange(len(words)), [len(w) for w in words]), table)
        assert [ids[word == w].tolist() for w in range(len(words))] == [merge_one(w, table.ranks) for w in words]


def test_vocab_size_stops_training(spark):
    table = spark.createDataFrame([("abcabc", 3), ("aaaa", 2)], "word string, n long")
    assert len(train_bpe(table, vocab_size=9).tokens) == 9
    assert len(train_bpe(table, vocab_size=5).merges) == 0
    everything = train_bpe(table)
    assert "abcabc" in everything.tokens and "aaaa" in everything.tokens
    assert train_bpe(table.limit(0)).tokens == bpe.SPECIAL_TOKENS


ROOT = "/root/testdata/sf0.001"


def test_small_vocabulary_equals_sql(spark):
    con = connect(ROOT)
    small = train_bpe(word_freq(documents(spark, ROOT), "text"), max_merges=bpe_sql.MERGES)
    assert difference(small.merge_table(spark), con, bpe_sql.SQL_MERGES) is None
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    assert difference(tokens.encoded_documents(spark, ROOT, small).select("doc_id", ids.alias("ids")), con, bpe_sql.SQL_ENCODE) is None
    assert difference(tokens.decoded_documents(spark, ROOT, small), con, bpe_sql.SQL_DECODE) is None
    assert difference(tokens.token_counts(spark, ROOT, small), con, bpe_sql.SQL_TOKENS) is None


def test_full_vocabulary_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = documents(spark, ROOT)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    trainer = tokenizers.trainers.BpeTrainer(special_tokens=list(bpe.SPECIAL_TOKENS), vocab_size=bpe.VOCAB_SIZE, show_progress=False)
    library.train_from_iterator(texts.values(), trainer)
    ours = tokens.trained_tokenizer(spark, ROOT)
    assert len(ours.tokens) == 10_000
    assert list(ours.tokens) == [t for t, _ in sorted(library.get_vocab().items(), key=lambda x: x[1])]
    for row in QUERIES["bpe_encode"][0](spark, ROOT).collect():
        assert row["ids"] == " ".join(map(str, library.encode(texts[row["doc_id"]], add_special_tokens=False).ids))
    for row in QUERIES["bpe_decode"][0](spark, ROOT).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids + [ours.id_of(bpe.END)]
        assert row["text"] == library.decode(ids, skip_special_tokens=True)
        assert row["text_with_specials"] == library.decode(ids, skip_special_tokens=False)
    assert QUERIES["bpe_merges"][0](spark, ROOT).count() == len(ours.merges)
    found = {r["token"]: r["n"] for r in QUERIES["ids_to_tokens"][0](spark, ROOT).collect()}
    assert found == Counter(t for text in texts.values() for t in library.encode(text, add_special_tokens=False).tokens)
    again = QUERIES["bpe_roundtrip"][0](spark, ROOT).first()
    assert (again["n_texts"], again["n_lost"]) == (len(texts), 0)
    assert again["n_mismatch"] == sum(library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) != t for t in texts.values())
    vocab = {r["id"]: (r["token"], r["is_special"], r["pad_id"]) for r in QUERIES["vocab_roundtrip"][0](spark, ROOT).collect()}
    assert vocab == {i: (t, i < 4, 3) for i, t in enumerate(ours.tokens)}


def test_unseen_characters_specials_and_long_words(spark):
    tokenizers = pytest.importorskip("tokenizers")
    texts = ["the cat then sat there", "that other thing the", "here the rather"]
    library = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    trainer = tokenizers.trainers.BpeTrainer(special_tokens=list(bpe.SPECIAL_TOKENS), vocab_size=40, show_progress=False)
    library.train_from_iterator(texts, trainer)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    ours = train_bpe(word_freq(docs, "text"), 40)
    glued = [f"x{s}the {s} {s}{s}" for s in bpe.SPECIAL_TOKENS] + ["hello</s>", "<s>the</s>the", "the" * 20_000, "</s", "<pad></pad>"]
    extra = spark.createDataFrame([(t,) for t in ["안녕 unseen 漢字 the", "", *glued]], "text string")
    rows = docs.union(extra).select("text", bpe.encode(F.col("text"), ours).alias("ids"))
    rows = rows.withColumns({"tokens": bpe.ids_to_tokens(F.col("ids"), ours), "back": bpe.decode(F.col("ids"), ours)})
    for row in rows.collect():
        expected = library.encode(row["text"], add_special_tokens=False)
        assert row["ids"] == expected.ids
        # Unknown characters show as the unknown token here, as their own text in the library.
        assert row["tokens"] == [library.id_to_token(i) for i in expected.ids]
        assert row["back"] == library.decode(expected.ids, skip_special_tokens=True)
    nulls = spark.createDataFrame([(None,), ("the",), (None,)], "text string").coalesce(1)
    assert [r[0] is None for r in nulls.select(bpe.encode(F.col("text"), ours)).collect()] == [True, False, True]


SMALL = bpe.BpeTokenizer((*bpe.SPECIAL_TOKENS, "a", "b", "ab"), ((4, 5, 6),))


def merging_task(monkeypatch):
    """What the encoder runs on the Arrow batches of a task."""
    taken = {}
    with monkeypatch.context() as patched:
        patched.setattr(bpe.F, "arrow_udf", lambda kind: lambda run: taken.update(run=run) or (lambda column: column))
        patched.setattr(bpe, "_words_and_specials", lambda text, specials: text)
        bpe.encode(None, SMALL)
    return taken["run"]


def test_encoder_holds_little_beside_its_batch(monkeypatch):
    """Five million words in a batch of 34 MB; one array of numbers of their ids took as much."""
    words, rows = 5_000_000, 5_000
    flat = pa.DictionaryArray.from_arrays(pa.array(np.arange(words, dtype=np.int32) % 3), pa.array(["ab", "b", "abab"])).dictionary_decode()
    batch = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * (words // rows)), flat)
    run, ids = merging_task(monkeypatch), 0
    tracemalloc.start()
    for part in run(iter([batch])):
        ids += len(part.flatten())
        del part
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == sum([1, 1, 2][i % 3] for i in range(words)) and peak < 60e6


def test_pieces_of_a_batch_equal_the_whole(monkeypatch):
    monkeypatch.setattr(bpe, "ROWS_WORDS", 3, raising=False)
    monkeypatch.setattr(bpe, "MERGED_BYTES", 2, raising=False)
    monkeypatch.setattr(bpe, "GATHERED_WORDS", 2, raising=False)
    rows = [None, ["ab", "c"], [], ["<s>", "abab", "b"], None, ["b", "a", "ab", "abb", "<pad>"], ["a"], [], None]
    want = [None, [6, 0], [], [1, 6, 6, 5], None, [5, 4, 6, 6, 5, 3], [4], [], None]
    run = merging_task(monkeypatch)
    for kind in (pa.string(), pa.large_string()):
        batch = pa.array(rows, pa.list_(kind))
        parts = [p.to_pylist() for p in run(iter([batch, batch.slice(2, 5), batch.slice(4, 1)]))]
        assert sum(parts, []) == [*want, *want[2:7], *want[4:5]]
        assert max(sum(len(r or []) for r in p) for p in parts) == 6


def test_texts_are_encoded_once_for_counting(spark, tmp_path):
    """Ids that repeat or are null, no text, texts of spaces only, and special tokens inside."""
    docs = [(1, "ab ab a"), (1, "ab b"), (2, None), (3, ""), (3, " \t"), (None, "a<s>ab"), (None, "a"), (4, "ab"), (4, "ab"), (5, "</s><pad> <s")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = tokens.token_counts(spark, str(tmp_path), SMALL)
    assert counts._jdf.queryExecution().executedPlan().toString().count("merge_rows(") == 1
    n, found = Counter(), defaultdict(set)
    for doc, text in docs:
        for token in re.findall(r"<s>|</s>|<pad>|ab|a|b|[^\w\s]|s", text or ""):
            token = token if token in SMALL.tokens else "<unk>"
            n[token] += 1
            found[token].add(doc)
    assert {(r["token"], r["n"], r["n_docs"]) for r in counts.collect()} == {(t, n[t], len(found[t])) for t in n}


def brute_pairs(texts, fraction):
    stream = "".join(texts)
    cut = math.floor(fraction * len(stream))
    counts = Counter()
    for split, part in (("train", stream[:cut]), ("test", stream[cut:])):
        counts.update((split, a, b) for a, b in zip(part, part[1:]))
    return counts


@pytest.mark.parametrize("texts", [["ab", "", "c", "abcabc", "b"], ["a" * 30, "b"], ["x", "y", "z"]])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.9])
def test_next_token_table(spark, texts, fraction):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    tokens = chars(F.col("text"))
    offsets = stream_offsets(df, ["k"], F.size(tokens), boundary_tokens(tokens))
    cut = stream_cut(offsets, ["k"], math.floor(fraction * stream_length(offsets)))
    counts = pair_counts(df, tokens, offsets, cut)
    expected = brute_pairs(texts, fraction)
    assert {(r["split"], r["prev"], r["next"]): r["n"] for r in counts.collect()} == dict(expected)
    totals = Counter()
    for (split, a, _), n in expected.items():
        totals[a] += n if split == "train" else 0
    model = {(r["prev"], r["next"]): r["p"] for r in bigram_model(counts).collect()}
    assert model == {(a, b): n / totals[a] for (s, a, b), n in expected.items() if s == "train"}
    for row in bigram_loss(counts, bigram_model(counts)).collect():
        mine = {(a, b): n for (s, a, b), n in expected.items() if s == row["split"]}
        covered = {p: n for p, n in mine.items() if p in model}
        assert row["n_pairs"] == sum(mine.values())
        assert row["n_uncovered"] == sum(mine.values()) - sum(covered.values())
        if covered:
            loss = -sum(n * math.log(model[p]) for p, n in covered.items()) / sum(covered.values())
            assert row["loss"] == pytest.approx(loss)
        else:
            assert row["loss"] is None


def test_smoothing(spark):
    counts = spark.createDataFrame([("train", "a", "b", 3), ("train", "a", "c", 1)], "split string, prev string, next string, n long")
    rows = {r["next"]: (r["p"], r["unseen_p"]) for r in bigram_model(counts, alpha=1.0, vocab_size=5).collect()}
    assert rows == {"b": (4 / 9, 1 / 9), "c": (2 / 9, 1 / 9)}


MODEL = [("a", "b", 0.5), ("a", "c", 0.3), ("a", "d", 0.2), ("b", "a", 1.0), ("c", "a", 0.5), ("c", "e", 0.5)]


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame(MODEL, "prev string, next string, p double")


def kept_by_hand(rows, temperature, top_p):
    powered = sorted(((p ** (1 / temperature), t) for t, p in rows), key=lambda x: (-x[0], x[1]))
    total, before, kept = sum(w for w, _ in powered), 0.0, []
    for w, t in powered:
        if before < top_p or not kept:
            kept.append((t, w / total))
        before += w / total
    mass = sum(q for _, q in kept)
    return [(t, q / mass) for t, q in kept]


@pytest.mark.parametrize("temperature, top_p", [(1.0, 1.0), (1.0, 0.5), (1.0, 0.51), (0.5, 0.9), (2.0, 0.0)])
def test_top_p(model, temperature, top_p):
    rows = top_p_filter(model, ["prev"], temperature=temperature, top_p=top_p).collect()
    for prev in "abc":
        got = sorted((r["rank"], r["next"], r["p"]) for r in rows if r["prev"] == prev)
        expected = kept_by_hand([(n, p) for a, n, p in MODEL if a == prev], temperature, top_p)
        assert [t for _, t, _ in got] == [t for t, _ in expected]
        assert [p for _, _, p in got] == pytest.approx([p for _, p in expected])


def draw(seed, prompt, step):
    return int(hashlib.md5(f"{seed}:{prompt}:{step}".encode()).hexdigest()[:13], 16) / 2**52


def walk(table, seed, prompt, current, limit):
    out = []
    for step in range(limit):
        if current not in table:
            break
        u, total = draw(seed, prompt, step), 0.0
        for token, p in table[current]:
            total += p
            current = token
            if total > u:
                break
        out.append(current)
    return out


@pytest.mark.parametrize("durable_every", [3, 20])
def test_generation_follows_the_table(spark, model, durable_every):
    prompts = spark.createDataFrame([(i, "abcz"[i % 4]) for i in range(40)], "prompt_id long, current string")
    packed = pack_model(top_p_filter(model, ["prev"]), ["prev"])
    rows = generate(prompts, packed, 8, 8, seed=3, durable_every=durable_every).collect()
    table = defaultdict(list)
    for prev in "abc":
        table[prev] = kept_by_hand([(n, p) for a, n, p in MODEL if a == prev], 1.0, 1.0)
    for r in rows:
        assert r["generated"] == walk(dict(table), 3, r["prompt_id"], r["current"], 8)


def test_adapters(spark, model):
    adapters = spark.createDataFrame([("x", 1.0, 0.1, 2), ("y", 1.0, 1.0, 4)], "adapter string, temperature double, top_p double, max_tokens int")
    prompts = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x")], "prompt_id long, current string, adapter string")
    group = ["adapter", "prev"]
    kept = top_p_filter(adapter_models(model, adapters), group, temperature=F.col("temperature"), top_p=F.col("top_p"))
    routed = route_to_adapters(prompts, adapters)
    rows = {
        r["prompt_id"]: r
        for r in generate(routed, pack_model(kept, group), F.col("max_tokens"), 4, group=("adapter",)).collect()
    }
    assert rows[1]["generated"] == ["b", "a"] and rows[3]["generated"] == ["a", "b"]  # top_p 0.1 is greedy
    table = {prev: kept_by_hand([(n, p) for a, n, p in MODEL if a == prev], 1.0, 1.0) for prev in "abc"}
    assert rows[2]["generated"] == walk(table, 42, 2, "a", 4)
    lost = spark.createDataFrame([(1, "a", "q")], prompts.schema)
    with pytest.raises(Exception, match="unknown adapter: q"):
        route_to_adapters(lost, adapters).collect()


@pytest.mark.parametrize("temperature, top_p", [(1.0, 1.0), (1.0, 0.5), (0.5, 0.9), (2.0, 0.0)])
def test_generation_for_reached_tokens_only(spark, model, temperature, top_p):
    prompts = spark.createDataFrame([(f"{i}:{i % 3}", "abcz"[i % 4], temperature, top_p, i % 7) for i in range(40)], "prompt_id string, current string, t double, tp double, n int")
    rows = generate_from(prompts, model, F.col("t"), F.col("tp"), F.col("n"), 6, seed=3, durable_every=4).collect()
    table = {prev: kept_by_hand([(n, p) for a, n, p in MODEL if a == prev], temperature, top_p) for prev in "abc"}
    assert len(rows) == 40
    for r in rows:
        assert r["generated"] == walk(table, 3, r["prompt_id"], r["current"], r["n"])


def test_every_user_turn_is_a_prompt(spark):
    turns = spark.read.parquet(f"{ROOT}/conversations.parquet").where("role = 'user'").count()
    for name in ("generate_prompts", "adapter_routing", "score_prompts"):
        assert QUERIES[name][0](spark, ROOT).count() == turns


def test_metrics_on_byte_pair_ids(spark):
    """The record of the registered query against the library's ids, row by row."""
    tokenizer = tokens.trained_tokenizer(spark, ROOT)
    marker = bpe.encode_text(MARKER, tokenizer)
    texts = rendered_pairs(spark, ROOT).select("conv_id", "turn", "text", bpe.encode(F.col("text"), tokenizer).alias("ids")).collect()
    labels = {(r["conv_id"], r["turn"]): r["labels"] for r in QUERIES["response_labels_bpe"][0](spark, ROOT).collect()}
    right = counted = 0
    for r in texts:
        ids = r["ids"]
        start = next(i for i in range(len(ids)) if ids[i : i + len(marker)] == marker) + len(marker)
        want = [-100] * start + ids[start:]
        assert labels[r["conv_id"], r["turn"]] == " ".join(map(str, want))
        guess = [(ids[i + 1] if i + 1 < len(ids) else 3) if i % 7 else 3 for i in range(len(ids))]
        right += sum(g == x for g, x in zip(guess, want[1:]) if x != -100)
        counted += len(ids) - start
    got = QUERIES["metrics_report_bpe"][0](spark, ROOT).first()
    assert (got["n_right"], got["n_counted"]) == (right, counted) and 0 < got["bleu"] < 1


def test_scoring_plug_in(spark):
    def make():
        calls = []

        def score(prompts: pd.Series):
            calls.append(len(prompts))
            return [f"{p}:{len(calls)}" for p in prompts]

        return score

    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "prompt_id long, prompt string").coalesce(1)
    rows = score_prompts(prompts, make).collect()
    assert [r["generated"] for r in sorted(rows)] == [f"p{i}:1" for i in range(5)]


def test_few_python_steps_share_a_stage(spark):
    """Each step of a stage holds a Python worker beside every task."""
    prompts = spark.createDataFrame([("p", "a", 1.0, 1.0, 40)], "prompt_id string, current string, t double, tp double, n int")
    model = spark.createDataFrame([("a", "a", 1.0)], "prev string, next string, p double")
    rows = generate_from(prompts, model, F.col("t"), F.col("tp"), F.col("n"), 40)
    assert 1 <= rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") <= 3
    assert rows.first()["generated"] == ["a"] * 40
