"""Toxic spans by a two-label linear-chain conditional random field.

Training takes a bounded sample of labelled documents. Their words get token
labels: a word of a toxic document counts as toxic if it, or its beginning, is
far more frequent in toxic documents than in clean ones. The field learns
weights of word features (the word, its first 4, 5 and 6 characters, its last 4)
and of label transitions by gradient steps on the exact conditional likelihood.

Scoring runs over all rows: forward-backward marginals of every token of the
whole text; a sentence is a chain. Tokens with a marginal of one half or more
form the offending spans; the largest marginal and the sum over those tokens give
the document's score through a two-variable logistic curve, fitted on sample
documents that the field was not trained on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, slices
from corpusloom.operators.positions import repeatable_hash, unit_number
from corpusloom.session import collect_bounded

TOKEN = re.compile(r"\w+|[.!?\n]")
BREAKS = frozenset(".!?\n")
KEPT_WORDS = 250_000


@dataclass(frozen=True)
class Settings:
    #: Bound of the training sample: about so many documents of each label.
    sample_rows: int = 1500
    buckets: int = 1 << 20
    epochs: int = 30
    rate: float = 1.0
    decay: float = 1e-4
    #: A token label needs this ratio of document shares, so many documents and
    #: this share of the toxic ones.
    ratio: float = 12.0
    least: int = 3
    least_share: float = 0.02
    seed: int = 5


def features(word: str) -> list[str]:
    return ["w:" + word, *["p:" + word[:n] for n in (4, 5, 6) if len(word) > n], "s:" + word[-4:]]


def _ids(word: str, buckets: int) -> list[int]:
    return [zlib.crc32(f.encode()) % buckets for f in features(word)]


class Chains:
    """Sentences of a run of tokens, longest first, for stepping through all at once."""

    def __init__(self, breaks: np.ndarray):
        n = len(breaks)
        inside = ~breaks
        first = inside & np.concatenate(([True], breaks[:-1])) if n else inside
        starts = np.flatnonzero(first)
        ends = np.flatnonzero(inside & np.concatenate((breaks[1:], [True]))) + 1 if n else starts
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        self.starts, self.lengths = starts[order], lengths[order]
        # How many chains have a token at step t.
        longest = int(self.lengths[0]) if len(order) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(longest), side="left")

    def marginals(self, emit: np.ndarray, move: np.ndarray, pairs: bool = False):
        """P(toxic) of every token, 0 at breaks; with ``pairs`` also the expected moves.

        emit: score of label 1 less that of label 0. move[a, b]: score of b
        after a. Forward and backward values are kept as log odds and log sums.
        """
        n = len(emit)
        f0, f1, b0, b1 = (np.zeros(n) for _ in range(4))
        for t, k in enumerate(self.active):
            at = self.starts[:k] + t
            if t == 0:
                f1[at] = emit[at]
            else:
                p0, p1 = f0[at - 1], f1[at - 1]
                n0 = np.logaddexp(p0 + move[0, 0], p1 + move[1, 0])
                n1 = np.logaddexp(p0 + move[0, 1], p1 + move[1, 1]) + emit[at]
                f0[at], f1[at] = n0, n1
        for t in range(len(self.active) - 2, -1, -1):
            at = self.starts[: self.active[t + 1]] + t
            q0, q1 = b0[at + 1], b1[at + 1] + emit[at + 1]
            b0[at] = np.logaddexp(q0 + move[0, 0], q1 + move[0, 1])
            b1[at] = np.logaddexp(q0 + move[1, 0], q1 + move[1, 1])
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp((f0 + b0) - (f1 + b1)))
        if not pairs:
            return p
        expected = np.zeros((2, 2))
        for t in range(1, len(self.active)):
            at = self.starts[: self.active[t]] + t
            total = np.logaddexp(f0[at] + b0[at], f1[at] + b1[at])
            for a, fa in enumerate((f0, f1)):
                for b, (bb, e) in enumerate(((b0, 0.0), (b1, emit[at]))):
                    expected[a, b] += np.exp(fa[at - 1] + move[a, b] + e + bb[at] - total).sum()
        return p, expected


class _Emissions(dict):
    """Word to its score; breaks between chains have minus infinity."""

    def __init__(self, weights: np.ndarray, buckets: int):
        super().__init__({b: float("-inf") for b in BREAKS})
        self.weights, self.buckets = weights, buckets

    def __missing__(self, word: str) -> float:
        value = float(self.weights[_ids(word, self.buckets)].sum() + self.weights[-1])
        if len(self) < KEPT_WORDS and len(word) <= 64:
            self[word] = value
        return value


@dataclass
class Model:
    """Small enough to send to every task: one weight per feature bucket."""

    weights: np.ndarray
    move: np.ndarray
    curve: np.ndarray
    prior: float
    settings: Settings
    _emit: _Emissions | None = field(default=None, repr=False)

    def token_marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens of all texts, and where each text's tokens begin."""
        tokens: list[str] = []
        begins = [0]
        for text in texts:
            tokens += TOKEN.findall(text.lower())
            tokens.append("\n")
            begins.append(len(tokens))
        if self._emit is None:
            self._emit = _Emissions(self.weights, self.settings.buckets)
        emit = np.fromiter(map(self._emit.__getitem__, tokens), dtype=np.float64, count=len(tokens))
        breaks = np.isneginf(emit)
        emit[breaks] = 0
        p = Chains(breaks).marginals(emit, self.move)
        p[breaks] = 0
        return p, np.array(begins)

    def summaries(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(top marginal as log odds, log of 1 + sum over offending tokens) per text; marginals; begins."""
        p, begins = self.token_marginals(texts)
        if not texts:
            return np.zeros((0, 2)), p, begins
        top = np.clip(np.maximum.reduceat(p, begins[:-1]), 1e-6, 1 - 1e-6)
        return np.column_stack([np.log(top / (1 - top)) / 4, np.log1p(np.add.reduceat(np.where(p >= 0.5, p, 0), begins[:-1]))]), p, begins

    def scores(self, summaries: np.ndarray) -> np.ndarray:
        if not self.curve.any():
            return np.full(len(summaries), self.prior)
        return 1 / (1 + np.exp(-(self.curve[0] + summaries @ self.curve[1:])))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a ridge that keeps it finite."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (weight * (y - p)) - 0.01 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def _numbered(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """The tokens of a text as numbers; new words enter the vocabulary."""
    found = TOKEN.findall(text.lower())
    return np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), dtype=np.int32, count=len(found))


def _marked(tokens: list[np.ndarray], y: np.ndarray, vocabulary: dict[str, int], settings: Settings) -> np.ndarray:
    """For each word whether it, or one of its beginnings, is far more frequent in toxic documents.

    Documents are counted by numbers of words and beginnings, so that no list of
    strings of the whole sample is held.
    """
    beginnings: dict[str, int] = {}
    counted, size = np.zeros(len(vocabulary), dtype=bool), len(vocabulary)
    numbers = np.full((len(vocabulary), 4), -1, dtype=np.int32)
    for word, i in vocabulary.items():
        if word not in BREAKS:
            counted[i] = True
            numbers[i, 0] = i
            for place, n in enumerate((4, 5, 6), 1):
                if len(word) > n:
                    numbers[i, place] = size + beginnings.setdefault(word[:n], len(beginnings))
    # The last cell takes what a word does not have.
    shares = np.zeros((2, size + len(beginnings) + 1))
    for ids, label in zip(tokens, y):
        ids = np.unique(ids)
        shares[label, np.unique(numbers[ids[counted[ids]]])] += 1
    shares[:, -1] = 0
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    few = max(settings.least, settings.least_share * n1)
    telling = (shares[1] >= few) & ((shares[1] + 0.1) / n1 > settings.ratio * (shares[0] + 0.5) / n0)
    telling[-1] = False
    return counted & telling[numbers].any(axis=1)


def fit(texts: list[str], toxic: list[int], prior: float, settings: Settings) -> Model:
    """A model from a sample; ``prior`` is the share of toxic rows among all labelled ones."""
    y = np.array(toxic)
    model = Model(np.zeros(settings.buckets + 1, dtype=np.float32), np.zeros((2, 2)), np.zeros(3), prior, settings)
    if len(y) == 0 or y.min() == y.max():
        return model
    vocabulary: dict[str, int] = {"\n": 0}
    tokens = [_numbered(t, vocabulary) for t in texts]
    marked = _marked(tokens, y, vocabulary, settings)

    # Every other document trains the field, the rest fit the curve.
    train = np.arange(len(y)) % 2 == 0
    if len(set(y[train])) < 2 or len(set(y[~train])) < 2:
        train[:] = True
    ends = [np.append(tokens[i], 0) for i in np.flatnonzero(train)]
    words = np.concatenate(ends)
    labels = (marked[words] & np.repeat(y[train] == 1, [len(e) for e in ends])).astype(np.float64)
    del tokens, ends
    # Words of the training documents, in the order in which they first occur.
    used, first, words = np.unique(words, return_index=True, return_inverse=True)
    order = np.argsort(first)
    words = np.argsort(order)[words]
    every = list(vocabulary)
    names = [every[i] for i in used[order].tolist()]
    del vocabulary, every
    lists = [[settings.buckets] if w in BREAKS else [*_ids(w, settings.buckets), settings.buckets] for w in names]
    owner = np.repeat(np.arange(len(names)), [len(x) for x in lists])
    flat = np.concatenate([np.array(x, dtype=np.int32) for x in lists])
    breaks = np.array([w in BREAKS for w in names])[words]
    del lists, used, first, order
    words = words.astype(np.int32)
    chains = Chains(breaks)
    inside = ~breaks
    # Moves between labels inside chains.
    both = inside[1:] & inside[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][both].astype(int), labels[1:][both].astype(int)), 1)
    g2, m2 = np.full(settings.buckets + 1, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(settings.epochs):
        emit = np.bincount(owner, model.weights[flat], minlength=len(names))[words]
        emit[breaks] = 0
        p, expected = chains.marginals(emit, model.move, pairs=True)
        by_word = np.bincount(words[inside], (labels - p)[inside], minlength=len(names))
        grad = np.bincount(flat, by_word[owner], minlength=settings.buckets + 1) - settings.decay * model.weights
        step = seen - expected
        g2 += grad**2
        m2 += step**2
        model.weights = (model.weights + settings.rate * grad / np.sqrt(g2)).astype(np.float32)
        model.move = model.move + settings.rate * step / np.sqrt(m2)
    rest = ~train if (~train).any() else train
    x = np.concatenate([model.summaries([texts[i] for i in part])[0] for part in np.array_split(np.flatnonzero(rest), 20) if len(part)])
    yr = y[rest]
    weight = np.where(yr == 1, prior / max(1, (yr == 1).sum()), (1 - prior) / max(1, (yr == 0).sum())) * len(yr)
    model.curve = _logistic(x, yr, weight)
    model._emit = None
    return model


def held_out(id_col: str = "_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a sample of the labelled rows that are not held out.

    docs: (doc_id, text); labels: (doc_id, toxic). At most about
    ``settings.sample_rows`` documents of each label reach the driver, chosen by
    hash of the id; label counts are taken over all labelled rows. Null ids and
    labels are not used, of repeated labels the larger holds; rows that repeat an id
    and a text are one sample row. Without labelled rows every score is 0.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out())
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, settings.sample_rows / n))).otherwise(share)
    chosen = marked.where(unit_number(repeatable_hash(settings.seed, "_id")) < share)
    # The ids are few whatever the size of the tables, so they go to the texts.
    ids = [(r["_id"], r["toxic"]) for r in collect_bounded(chosen, 4 * settings.sample_rows * max(1, len(counts)), "sampled ids")]
    few = F.broadcast(docs.sparkSession.createDataFrame(ids, "_id long, toxic int"))
    rows = keyed(docs, "doc_id", "text").join(few, "_id").dropDuplicates(["_id", "_th"])
    sample = sorted((r["_id"], r["_text"], r["toxic"]) for r in rows.select("_id", "_text", "toxic").collect()) if ids else []
    return fit([r[1] for r in sample], [int(r[2] > 0) for r in sample], counts.get(1, 0) / total if total else 0.0, settings)


def _spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Runs of tokens with marginal >= 0.5, as (start, end) in code points."""
    out: list[tuple[int, int]] = []
    last = False
    lowered = text.lower()
    if len(lowered) != len(text):  # a few characters grow when lowered
        back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    else:
        back = None
    for token, value in zip(TOKEN.finditer(lowered), p):
        if value >= 0.5:
            start, end = token.span()
            if back is not None:
                start, end = back[start], back[end - 1] + 1
            if last:
                out[-1] = (out[-1][0], end)
            else:
                out.append((start, end))
        last = value >= 0.5
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _th, score, spans), one row per row of ``docs``.

    score: 0 to 1. spans: offending (start, end) in code points, end exclusive.
    Null and empty texts have no tokens and get the score of a text without any
    toxic token. Only the text is an input of the score, so rows that repeat a text
    get the same score, and rows that repeat an id are separate rows. A very long
    text is scored whole. An empty table gives an empty one; other columns are not
    read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for part in slices(batches):
            texts = part.column(2).to_pylist()
            summaries, p, begins = held.summaries(texts)
            scores = held.scores(summaries)
            hot = np.maximum.reduceat(p, begins[:-1]) >= 0.5 if texts else []
            spans = [
                [{"start": a, "end": b} for a, b in _spans(t, p[begins[i] : begins[i + 1]])] if hot[i] else []
                for i, t in enumerate(texts)
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                ["_id", "_th", "score", "spans"],
            )
        held._emit = None  # the process stays, and the model with it; the words of this task do not

    return keyed(docs, id_col, text_col).mapInArrow(
        run, "_id long, _th long, score double, spans array<struct<start: long, end: long>>"
    )
