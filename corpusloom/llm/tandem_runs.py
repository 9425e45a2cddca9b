"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

The texts of one batch are laid end to end and get one suffix array (SA, its
inverse ISA, and LCP) in which suffixes of different texts share nothing. Every
LCP interval of depth d holds the suffixes that share their first d words. Its
children are the stretches between its minima; for each suffix i outside the
largest child, i + d and i - d are looked up in the interval through ISA. A hit
whose next words differ is a branching square: two equal halves of d words that
do not move one word to the right. A run ends in exactly one branching square of
its smallest period, so moving the squares to the left and leaving out those
whose period is a multiple of a shorter one gives every run once.

A text is handled as a whole inside one task: about 60 bytes a word plus 4 bytes
for every doubling of its longest repeat. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import keyed, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BATCH_WORDS = 200_000
NEAR_STEPS = 8
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Rewrite = Callable[[int | None, list[str]], list[str]]


@dataclass(frozen=True)
class RunLimits:
    """A run has at least ``length`` words and ``exponent`` times its smallest period."""

    length: int = 6
    exponent: int = 4


def _group_starts(keys: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys at these slots: first slot and size of the group of each."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    return np.repeat(slots[first], sizes), np.repeat(sizes, sizes)


def enhanced_suffix_array(symbols: np.ndarray, owner: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SA, ISA, LCP) of texts laid end to end, by prefix doubling.

    owner: the text of each position, ascending; end: where that text ends.
    LCP[k] belongs to the slots k - 1 and k. Only suffixes that are not yet told
    apart are sorted again, so prose costs little more than its first sort.
    """
    n = len(symbols)
    keys = owner.astype(np.int64) * (int(symbols.max()) + 1) + symbols
    sa = np.argsort(keys, kind="stable")
    open_slots = np.arange(n)
    start, sizes = _group_starts(keys[sa], open_slots)
    rank = np.full(n + 1, -1, dtype=np.int32)
    rank[sa] = start
    levels, width = [rank], 1
    open_slots, start = open_slots[sizes > 1], start[sizes > 1]
    while len(open_slots):
        at = sa[open_slots]
        follows = np.where(at + width < end[at], rank[np.minimum(at + width, n)], -1)
        keys = start.astype(np.int64) * (n + 2) + follows + 1
        order = np.argsort(keys, kind="stable")
        sa[open_slots] = at = at[order]
        start, sizes = _group_starts(keys[order], open_slots)
        rank = rank.copy()
        rank[at] = start
        levels.append(rank)
        width *= 2
        open_slots, start = open_slots[sizes > 1], start[sizes > 1]
    isa = rank[:n]
    lcp = np.zeros(n + 1, dtype=np.int64)
    slot = 1 + np.flatnonzero(levels[0][sa[:-1]] == levels[0][sa[1:]])
    i, j = sa[slot - 1].copy(), sa[slot].copy()
    for level in reversed(range(len(levels))):
        same = levels[level][i] == levels[level][j]
        lcp[slot[same]] += 1 << level
        i[same] += 1 << level
        j[same] += 1 << level
    return sa, isa, lcp


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(interval of each slot border or -1, left, right, depth) of all intervals of depth > 0.

    One pass with a stack of open intervals; lcp ends with a 0.
    """
    of = np.full(len(lcp), -1, dtype=np.int64)
    left: list[int] = []
    right: list[int] = []
    depth: list[int] = []
    stack: list[int] = []
    borders = np.flatnonzero(lcp > 0)
    found: list[int] = []
    last = -1
    for k, d in zip(borders.tolist(), lcp[borders].tolist()):
        if k != last + 1:
            for t in stack:
                right[t] = last
            stack = []
        begin = k - 1
        while stack and depth[stack[-1]] > d:
            t = stack.pop()
            right[t] = k - 1
            begin = left[t]
        if not stack or depth[stack[-1]] < d:
            stack.append(len(left))
            left.append(begin)
            right.append(-1)
            depth.append(d)
        found.append(stack[-1])
        last = k
    for t in stack:
        right[t] = last
    of[borders] = found
    return of, np.array(left, np.int64), np.array(right, np.int64), np.array(depth, np.int64)


def branching_squares(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half length) of every square that differs from the one a word further right."""
    of, left, right, depth = lcp_intervals(lcp)
    if not len(left):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    borders = np.flatnonzero(of >= 0)
    ids = np.concatenate([np.arange(len(left)), of[borders]])
    starts = np.concatenate([left, borders])
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    after = np.r_[starts[1:], 0]
    after[np.r_[firsts[1:], len(ids)] - 1] = right + 1
    sizes = after - starts
    # The first of the largest children of each interval is left out.
    largest = np.repeat(np.maximum.reduceat(sizes, firsts), np.diff(np.r_[firsts, len(ids)]))
    is_large = np.flatnonzero(sizes == largest)
    _, one = np.unique(ids[is_large], return_index=True)
    small = np.ones(len(ids), dtype=bool)
    small[is_large[one]] = False
    ids, starts, sizes = ids[small], starts[small], sizes[small]
    slots = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    ids = np.repeat(ids, sizes)
    i, d, low, high = sa[slots], depth[ids], left[ids], right[ids]
    n = len(symbols)

    def inside(j: np.ndarray) -> np.ndarray:
        r = isa[np.clip(j, 0, n - 1)]
        return (r >= low) & (r <= high)

    def differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (y >= end[i]) | (symbols[np.minimum(x, n - 1)] != symbols[np.minimum(y, n - 1)])

    ahead = (i + d < end[i]) & inside(i + d) & differ(i + d, i + 2 * d)
    behind = (i - d >= begin[i]) & inside(i - d) & differ(i, i + d)
    starts, halves = np.concatenate([i[ahead], i[behind] - d[behind]]), np.concatenate([d[ahead], d[behind]])
    pairs = np.unique(np.stack([starts + 2 * halves, halves]), axis=1)
    return pairs[0] - 2 * pairs[1], pairs[1]


def moved_left(symbols: np.ndarray, start: np.ndarray, half: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many words each square moves to the left and stays a square."""
    moved = np.zeros(len(start), dtype=np.int64)
    live = np.arange(len(start))
    for _ in range(NEAR_STEPS):
        at = start[live] - moved[live] - 1
        live = live[(at >= begin[live]) & (symbols[at] == symbols[at + half[live]])]
        moved[live] += 1
    for s in live.tolist():
        at, d, first, width = int(start[s] - moved[s]), int(half[s]), int(begin[s]), 4 * NEAR_STEPS
        while at > first:
            w = min(width, at - first)
            unlike = np.flatnonzero(symbols[at - w : at] != symbols[at - w + d : at + d])
            at -= w if not len(unlike) else w - 1 - int(unlike[-1])
            if len(unlike):
                break
            width *= 2
        moved[s] = start[s] - at
    return moved


def runs_of(symbols: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, limits: RunLimits = RunLimits()) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period."""
    found: list[np.ndarray] = []
    if len(symbols):
        sa, isa, lcp = enhanced_suffix_array(symbols, owner, end)
        start, half = branching_squares(symbols, begin, end, sa, isa, lcp)
        stop = start + 2 * half  # squares come by end, then by half length
        while len(start):
            first = np.flatnonzero(np.r_[True, stop[1:] != stop[:-1]])
            moved = moved_left(symbols, start[first], half[first], begin[start[first]])
            from_, period, text = start[first] - moved, half[first], owner[start[first]]
            found.append(np.stack([text, from_ - begin[start[first]], stop[first] - from_, period], axis=1))
            # Other squares that end here repeat this period if they lie inside the run.
            sizes = np.diff(np.r_[first, len(start)])
            covered = (start >= np.repeat(from_, sizes)) & (half % np.repeat(period, sizes) == 0)
            start, half, stop = start[~covered], half[~covered], stop[~covered]
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[rows[:, 2] >= np.maximum(limits.length, limits.exponent * rows[:, 3])]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        return found


def _batches(texts: list[list[str]]) -> Iterator[tuple[int, list[list[str]]]]:
    """Neighbouring texts of at most BATCH_WORDS words together; a longer one is alone."""
    first, words = 0, 0
    for k, text in enumerate(texts):
        if k > first and words + len(text) > BATCH_WORDS:
            yield first, texts[first:k]
            first, words = k, 0
        words += len(text)
    if first < len(texts):
        yield first, texts[first:]


def text_runs(texts: list[list[str]], limits: RunLimits = RunLimits()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, part in _batches(texts):
        ids, sizes = _Ids(), np.array([len(t) for t in part])
        symbols = np.fromiter((ids[w] for t in part for w in t), dtype=np.int64, count=int(sizes.sum()))
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(part)), sizes)
        rows = runs_of(symbols, owner, np.repeat(ends - sizes, sizes), np.repeat(ends, sizes), limits)
        for text, start, length, period in rows.tolist():
            result[first + text].append((start, length, period))
    return result


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties go to the smallest start, then period."""
    best = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, joined by one space, without those after the first period of a run."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return " ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _scan(rewrite: Rewrite | None, limits: RunLimits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = part.column(0).to_pylist()
            texts = [WORD.findall(t) for t in part.column(1).to_pylist()]
            if rewrite is not None:
                texts = [rewrite(key, words) for key, words in zip(ids, texts)]
            runs = text_runs(texts, limits)
            named = [[dict(zip(("start", "length", "period"), r)) for r in row] for row in runs]
            best = [None if b is None else dict(zip(("start", "length", "period"), b)) for b in map(strongest, runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(named, pa.list_(RUN_TYPE)),
                    pa.array(best, RUN_TYPE), pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.string()),
                ],
                ["_id", "n_words", "runs", "best", "collapsed"],
            )

    return run


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None, limits: RunLimits = RunLimits()) -> DataFrame:
    """(_id, n_words, runs, best, collapsed), one row per row of ``df``.

    Words are the stretches without ASCII white space, numbered from 0. ``runs``
    holds (start, length, period) of every longest stretch with that smallest
    period and at least ``limits``; ``best`` is the one with the greatest length
    / period, ties to the smallest start, then period, null without runs.
    ``collapsed`` leaves out words that repeat: all of a run after its first
    period. ``rewrite`` may change the words of a row first.

    A null or empty text has no words, no runs and an empty ``collapsed``. Rows
    that repeat an id, null included, are separate rows; an empty table gives an
    empty one. Other columns are not read. A very long text is one batch of its
    own.
    """
    run = "struct<start: long, length: long, period: long>"
    return (
        keyed(df, id_col, text_col).select("_id", "_text")
        .mapInArrow(_scan(rewrite, limits), f"_id long, n_words long, runs array<{run}>, best {run}, collapsed string")
    )
