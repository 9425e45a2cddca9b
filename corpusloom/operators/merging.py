"""Byte-pair merges of many words at once, on flat arrays of symbol ids."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.iinfo(np.int64).max
LONG_WORD = 1024


class MergeTable:
    """Merges (left, right, merged) in rank order; of repeated pairs the first counts."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.ranks = {(a, b): (rank, c) for rank, (a, b, c) in reversed(list(enumerate(merges)))}
        pairs = np.array([(a << 32) | b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(pairs)
        values = np.array([r for r, _ in self.ranks.values()], dtype=np.int64)
        # A last key that no pair reaches, so that every search ends inside.
        self.keys = np.append(pairs[order], NONE)
        self.values = np.append(values[order], NONE)
        self.merged = np.array([c for _, _, c in merges] or [0], dtype=np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` if it does not merge."""
        keys = (left << 32) | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.values[at], NONE)


def merge_one(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the earliest-learned merge present, leftmost first, until none is left.

    A heap of mergeable pairs over a linked list: n log n in the word's length.
    """
    n = len(ids)
    ids = list(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
    heap = [(rank, i, merged, a, b) for rank, merged, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, merged, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of the two has been merged since
        ids[i], ids[j] = merged, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (ids[left], ids[right]) in ranks:
                rank, new = ranks[ids[left], ids[right]]
                heapq.heappush(heap, (rank, left, new, ids[left], ids[right]))
    return [i for i in ids if i >= 0]


def _alternate(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring hits (a pair of equal symbols in a row of them) every other one."""
    if not (hit[1:] & hit[:-1]).any():
        return hit
    at = np.flatnonzero(hit)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    run = np.repeat(first, np.diff(np.r_[first, len(at)]))
    out = np.zeros_like(hit)
    out[at[(np.arange(len(at)) - run) % 2 == 0]] = True
    return out


def merge_words(ids: np.ndarray, word: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """(ids, word) after all merges; ``word`` numbers the words in ascending order.

    In each round every word takes its earliest merge at all places. Words without
    a merge left are set aside; very long words go through a heap one by one.
    """
    ids, word = ids.astype(np.int64), word.astype(np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    sizes = np.bincount(word) if len(word) else np.zeros(0, np.int64)
    for w in np.flatnonzero(sizes > LONG_WORD).tolist():
        low, high = np.searchsorted(word, (w, w + 1))
        merged = np.array(merge_one(ids[low:high].tolist(), table.ranks), dtype=np.int64)
        done.append((merged, np.full(len(merged), w)))
    if done:
        short = sizes[word] <= LONG_WORD
        ids, word = ids[short], word[short]

    def ranks_at(at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(ids) - 1)
        found = table.look(ids[at], ids[after])
        return np.where((at + 1 < len(ids)) & (word[at] == word[after]), found, NONE)

    rank = ranks_at(np.arange(len(ids))) if len(ids) else np.zeros(0, np.int64)
    while len(ids):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lengths = np.diff(np.r_[starts, len(ids)])
        least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        live = least < NONE
        if not live.all():
            done.append((ids[~live], word[~live]))
            ids, word, rank, least = ids[live], word[live], rank[live], least[live]
            if not len(ids):
                break
        hit = _alternate(rank == least)
        ids[hit] = table.merged[rank[hit]]
        keep = np.r_[True, ~hit[:-1]]
        at = (np.cumsum(keep) - 1)[hit]
        ids, word, rank = ids[keep], word[keep], rank[keep]
        rank[at] = ranks_at(at)
        before = at[at > 0] - 1
        rank[before] = ranks_at(before)
    if not done:
        return ids, word
    ids, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(word, kind="stable")
    return ids[order], word[order]
