"""Byte-pair training in rounds, each of which makes every merge whose order is certain.

The words (distinct, with their counts) and the counts of all neighbouring pairs
are tables. A round looks at the most frequent pairs and takes as many merges as
it can prove to be the next ones, rewrites the words that hold them, and updates
the pair table by the differences. Merges only lower the counts of the pairs that
were not looked at, so what counts for a proof is the first of these.

* Words are cut where two neighbours are not a pair looked at. A merge of this round
  joins what neighbours of some pair became, and is at most as frequent as that
  pair was, so it lies inside the pieces. Equal pieces are counted together, which
  makes them few however many words there are. They are fetched and merged one
  merge at a time: every count that decides is exact. The round ends when the
  next pair could be one that was not looked at. If there are too many pieces,
  fewer pairs are looked at.
* If the pieces of a single pair are too many, the neighbours of the pairs are
  counted where the words are. A merge (a, b) can only make pairs as frequent as
  x before a b, or y after it, so pairs that are more frequent than any of these
  and lose too little to change places are the next ones. One merge at least is
  always certain.

What the driver holds is bounded by parameters: pairs looked at, pieces fetched.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import chars, encode_chars
from corpusloom.operators.bpe import SPECIAL_TOKENS, VOCAB_SIZE, BpeTokenizer
from corpusloom.operators.merging import MergeTable, merge_words
from corpusloom.operators.vocabulary import UNICODE_POINTS
from corpusloom.session import collect_bounded, materialize

LOOKED_AT = 4096
FETCHED_WORDS = 200_000
NEIGHBOURS_OF = 128
# Pairs looked at in the first round; later rounds go by the pieces that were found.
FIRST_LOOKED_AT = 64

Pair = tuple[int, int]
Step = tuple[int, int, int]


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, number of the word) of a column of id arrays."""
    sizes = np.diff(ids.offsets.to_numpy())
    return ids.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(ids)), sizes)


def _lists(symbols: np.ndarray, word: np.ndarray, words: int) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.bincount(word, minlength=words))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols.astype(np.int32)))


def _pairs_inside(symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key of the pair that starts there) inside the words."""
    at = np.flatnonzero(word[1:] == word[:-1])
    return at, (symbols[at] << 32) | symbols[at + 1]


def _rewrite(table: MergeTable):
    """(ids, n, old): words after the merges; ``old`` holds the symbols of changed words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = batch.column("ids"), batch.column("n")
            symbols, word = _flat(ids)
            at, _ = _pairs_inside(symbols, word)
            hit = table.look(symbols[at], symbols[at + 1]) < np.iinfo(np.int64).max
            changed = np.unique(word[at[hit]])
            mask = np.zeros(len(ids), dtype=bool)
            mask[changed] = True
            inside = mask[word]
            new, new_word = merge_words(symbols[inside], word[inside], table)
            symbols, all_words = np.concatenate([symbols[~inside], new]), np.concatenate([word[~inside], new_word])
            order = np.argsort(all_words, kind="stable")
            old = ids.take(pa.array(np.arange(len(ids)), mask=~mask))
            yield pa.RecordBatch.from_arrays([_lists(symbols[order], all_words[order], len(ids)), n, old], ["ids", "n", "old"])

    return run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(l, r, n): how pair counts change by the rewriting."""
    for batch in batches:
        parts = []
        for name, sign in (("ids", 1), ("old", -1)):
            symbols, word = _flat(batch.column(name))
            at, keys = _pairs_inside(symbols, word)
            parts.append((keys, batch.column("n").to_numpy()[word[at]] * sign))
        keys, n = (np.concatenate(p) for p in zip(*parts))
        if not len(keys):
            continue
        distinct, place = np.unique(keys, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, n)
        yield pa.RecordBatch.from_arrays([pa.array(distinct >> 32), pa.array(distinct & 0xFFFFFFFF), pa.array(total)], ["l", "r", "n"])


PAIR_ROWS = "l long, r long, n long"


def pair_counts(words: DataFrame) -> DataFrame:
    """(l, r, n): occurrences of each pair over (ids, n)."""
    empty = F.array().cast("array<int>")
    rows = words.select("ids", "n", empty.alias("old")).mapInArrow(_difference, PAIR_ROWS)
    return rows.groupBy("l", "r").agg(F.sum("n").alias("n"))


def updated(pairs: DataFrame, rewritten: DataFrame) -> DataFrame:
    """Pair counts after a rewriting; only changed words are looked at."""
    change = rewritten.where(F.col("old").isNotNull()).mapInArrow(_difference, PAIR_ROWS)
    total = pairs.unionByName(change).groupBy("l", "r").agg(F.sum("n").alias("n"))
    return total.where("n > 0")


def _pieces(pairs: list[Pair]):
    """(ids, n): the longest stretches of words in which all neighbours are pairs looked at.

    ids holds the symbols as 32-bit numbers; equal stretches of a batch are one row.
    """
    keys = np.array(sorted((a << 32) | b for a, b in pairs), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word = _flat(batch.column("ids"))
            at, found = _pairs_inside(symbols, word)
            place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            linked = np.zeros(len(symbols) + 1, dtype=bool)  # to the next symbol, and one cell before the first
            linked[at[keys[place] == found] + 1] = True
            after, before = linked[1:], linked[:-1]
            first = np.flatnonzero(after & ~before)
            if not len(first):
                continue
            inside = np.flatnonzero(after | before)
            ends = np.r_[np.searchsorted(inside, first), len(inside)].astype(np.int32) * 4
            data = pa.py_buffer(symbols[inside].astype(np.int32).tobytes())
            ids = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), data]).dictionary_encode()
            n = np.zeros(len(ids.dictionary), dtype=np.int64)
            np.add.at(n, ids.indices.to_numpy(), batch.column("n").to_numpy()[word[first]])
            yield pa.RecordBatch.from_arrays([ids.dictionary, pa.array(n)], ["ids", "n"])

    return run


def _neighbours(pairs: list[Pair]):
    """(p, side, s, n): symbols before (side 0) and after (1) the p-th pair, with counts."""
    keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word = _flat(batch.column("ids"))
            weight = batch.column("n").to_numpy()
            at, found = _pairs_inside(symbols, word)
            place = np.minimum(np.searchsorted(keys, found, sorter=order), len(keys) - 1)
            hit = keys[order[place]] == found
            at, which = at[hit], order[place[hit]]
            rows = []
            for side, beside in ((0, at - 1), (1, at + 2)):
                inside = (beside >= 0) & (beside < len(symbols))
                beside, p, here = beside[inside], which[inside], at[inside]
                inside = word[beside] == word[here]
                rows.append((p[inside], np.full(inside.sum(), side), symbols[beside[inside]], weight[word[here[inside]]]))
            p, side, s, n = (np.concatenate(c) for c in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (p, side, s, n)], ["p", "side", "s", "n"])

    return run


class _Vocabulary:
    """Tokens and merges so far."""

    def __init__(self, tokens: list[str], size: int, max_merges: int | None):
        self.tokens, self.size, self.max_merges = tokens, size, max_merges
        self.codes = {t: i for i, t in enumerate(tokens)}
        self.merges: list[Step] = []

    @property
    def full(self) -> bool:
        return len(self.tokens) >= self.size or (self.max_merges is not None and len(self.merges) >= self.max_merges)

    def add(self, left: int, right: int) -> tuple[Step, bool]:
        """The new merge, and whether its token was known: it then gains occurrences."""
        merged = self.tokens[left] + self.tokens[right]
        known = merged in self.codes
        if not known:
            self.codes[merged] = len(self.tokens)
            self.tokens.append(merged)
        step = (left, right, self.codes[merged])
        self.merges.append(step)
        return step, known


def merges_in_words(words: list[tuple[list[int], int]], known: dict[Pair, int], limit: tuple[int, int, int] | None, vocabulary: _Vocabulary) -> list[Step]:
    """Merges in order, while the next one is certain to come before ``limit``.

    words, or pieces of them, hold every occurrence of the pairs in ``known``;
    ``limit`` is (-n, l, r) of the first pair that was not looked at, none if there
    is no other.
    """
    first_new = len(vocabulary.tokens)
    words = [(list(ids), n) for ids, n in words]
    counts: dict[Pair, int] = defaultdict(int)
    where: dict[Pair, set[int]] = defaultdict(set)

    def exact(pair: Pair) -> bool:
        return pair in known or pair[0] >= first_new or pair[1] >= first_new

    for w, (ids, n) in enumerate(words):
        for pair in zip(ids, ids[1:]):
            if pair in known:
                counts[pair] += n
                where[pair].add(w)
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    steps: list[Step] = []
    while heap and not vocabulary.full:
        top = heapq.heappop(heap)
        pair = top[1:]
        if counts[pair] != -top[0]:
            if counts[pair] > 0:
                heapq.heappush(heap, (-counts[pair], *pair))
            continue
        if limit is not None and top >= limit:
            break
        step, was_known = vocabulary.add(*pair)
        steps.append(step)
        if was_known:
            break
        touched: set[Pair] = set()
        for w in where.pop(pair):
            ids, n = words[w]
            merged: list[int] = []
            i = 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    merged.append(step[2])
                    i += 2
                else:
                    merged.append(ids[i])
                    i += 1
            for old in zip(ids, ids[1:]):
                if exact(old):
                    counts[old] -= n
            for new in zip(merged, merged[1:]):
                if exact(new):
                    counts[new] += n
                    where[new].add(w)
                    touched.add(new)
            words[w] = (merged, n)
        counts[pair] = 0
        for new in touched:
            if counts[new] > 0:
                heapq.heappush(heap, (-counts[new], *new))
    return steps


def merges_by_bounds(ranked: list[tuple[int, int, int]], beside: dict[tuple[int, int], list[tuple[int, int]]], limit: tuple[int, int, int] | None, vocabulary: _Vocabulary) -> list[Step]:
    """Merges in order, as far as bounds on all counts leave no doubt.

    ranked: (l, r, n), most frequent first; beside: symbols and counts before
    (side 0) and after (1) each of them, by (place, side).
    """
    first = {(a, b): n for a, b, n in ranked}
    low, high = dict(first), dict(first)
    lost: dict[Pair, int] = {}
    place = {(a, b): p for p, (a, b, _) in enumerate(ranked)}
    newest, steps = 0, []
    while low and not vocabulary.full:
        order = sorted((-high[p], *p) for p in low)
        pair = order[0][1:]
        sure = (-low[pair], *pair)
        certain = low[pair] > newest and (len(order) < 2 or sure < order[1]) and (limit is None or sure < limit)
        # The order of equal symbols in a row depends on where a row begins, so
        # such a pair is only taken on counts that nothing has touched.
        if steps and not (certain and pair[0] != pair[1]):
            break
        step, known = vocabulary.add(*pair)
        steps.append(step)
        if known or pair[0] == pair[1]:
            break
        # Neighbours were counted before this round: some of these may be gone.
        gone = first[pair] - low.pop(pair)
        del high[pair]
        for side in (0, 1):
            for s, n in beside.get((place[pair], side), []):
                newest = max(newest, n)
                other = (s, pair[0]) if side == 0 else (pair[1], s)
                if other in low:
                    low[other] -= n
                    more = max(lost.get(other, 0), n - gone)
                    high[other] -= more - lost.get(other, 0)
                    lost[other] = more
    return steps


def train_bpe(
    word_counts: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    max_merges: int | None = None,
    specials: tuple[str, ...] = SPECIAL_TOKENS,
    looked_at: int = LOOKED_AT,
    fetched_words: int = FETCHED_WORDS,
    neighbours_of: int = NEIGHBOURS_OF,
) -> BpeTokenizer:
    """Train on (word, n): special tokens, then the alphabet, then merges up to ``vocab_size``.

    The most frequent pair wins; ties go to the smaller left id, then the smaller
    right id. The result does not depend on the last three parameters, which bound
    what reaches the driver in a round. Words are written once a round, so a lost
    executor costs one round; rounds get longer as pairs get rarer.
    """
    spread = int(word_counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    word_counts = materialize(word_counts.select("word", F.col("n").cast("long").alias("n")).repartition(spread, "word"), "word-counts")
    alphabet = word_counts.select(F.explode(chars(F.col("word"))).alias("c")).distinct().orderBy("c")
    letters = [row["c"] for row in collect_bounded(alphabet, UNICODE_POINTS, "alphabet")]
    tokens = [*specials, *[c for c in letters if c not in specials]]
    vocabulary = _Vocabulary(tokens, vocab_size, max_merges)
    codes = {c: vocabulary.codes[c] for c in letters}
    # Words of one character never form a pair.
    longer = word_counts.where(F.char_length("word") > 1)
    words = materialize(longer.select(encode_chars(F.col("word"), codes).alias("ids"), "n"), "bpe-words")
    pairs = materialize(pair_counts(words), "bpe-pairs")
    looked = FIRST_LOOKED_AT
    while not vocabulary.full:
        top = pairs.orderBy(F.desc("n"), "l", "r").limit(looked_at + 1).collect()
        if not top:
            break
        few, rows = min(looked, looked_at, len(top)) if fetched_words else 0, []
        while few:
            known = {(r["l"], r["r"]): r["n"] for r in top[:few]}
            found = words.mapInArrow(_pieces(list(known)), "ids binary, n long").groupBy("ids").agg(F.sum("n").alias("n"))
            rows = found.limit(fetched_words + 1).collect()
            if len(rows) <= fetched_words:
                break
            few //= 2
        if few:
            looked = few * (4 if 8 * len(rows) < fetched_words else 2 if 2 * len(rows) < fetched_words else 1)
            limit = (-top[few]["n"], top[few]["l"], top[few]["r"]) if few < len(top) else None
            pieces = [(np.frombuffer(r["ids"], np.int32).tolist(), r["n"]) for r in rows]
            steps = merges_in_words(pieces, known, limit, vocabulary)
        else:
            looked = 1
            ranked = [(r["l"], r["r"], r["n"]) for r in top[:neighbours_of]]
            rest = top[len(ranked)] if len(ranked) < len(top) else None
            found = words.mapInArrow(_neighbours([(a, b) for a, b, _ in ranked]), "p long, side long, s long, n long")
            beside: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            rows = found.groupBy("p", "side", "s").agg(F.sum("n").alias("n"))
            for r in collect_bounded(rows, 2 * neighbours_of * len(vocabulary.tokens), "neighbours"):
                beside[r["p"], r["side"]].append((r["s"], r["n"]))
            limit = (-rest["n"], rest["l"], rest["r"]) if rest else None
            steps = merges_by_bounds(ranked, beside, limit, vocabulary)
        if vocabulary.full:
            break
        rewritten = materialize(words.mapInArrow(_rewrite(MergeTable(steps)), "ids array<int>, n long, old array<int>"), "bpe-words")
        pairs = materialize(updated(pairs, rewritten), "bpe-pairs")
        words = rewritten.select("ids", "n").where(F.size("ids") > 1)
    return BpeTokenizer(tuple(vocabulary.tokens), tuple(vocabulary.merges), specials=specials)
