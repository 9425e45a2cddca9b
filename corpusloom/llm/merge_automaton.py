"""Byte-pair encoding with a deterministic automaton compiled from the merge list.

The automaton reads tokens and accepts exactly the token sequences that merging
yields. It starts as one state with a loop for every single symbol and takes the
merges in order. The gadget of merge (u, v): what follows a ``u`` becomes a copy
of the state that followed it, without the arc ``v``; the new token ``uv`` gets an
arc wherever ``u`` then ``v`` could be read, to where ``v`` led. All arcs of one
token lead to one state, so a state is a copy of its parent without one arc, made
at a known merge, and every arc of every state follows from two rules:

* a token merged since the state was made may follow if its left part may;
* an older token may follow if it is not the one removed and the parent has it.

The driver compiles the automaton once into flat arrays. A pre-split word has
exactly one path through it; it is found in one pass over its bytes, because every
prefix of the word has exactly one path as well. All new words of a slice of rows
go through the automaton together, one token at a time: the longest that the last
state has an arc for, and back from where none leads on. As a place is reached by
one path only, it is entered once. Decoding emits the labels.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import slices

#: How the byte-level pre-tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: The code points with the property White_Space.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Words that a task keeps, and the longest of them; others are computed anew.
KEPT_WORDS = 250_000
KEPT_LENGTH = 64

#: Longer words go through the automaton one at a time.
LONG_WORD = 256

#: Words whose ids are put together at once.
BLOCK_WORDS = 1 << 16

#: Answers about pairs of a state and a token that are kept, a power of two.
KEPT_ARCS = 1 << 17


@lru_cache(1)
def word_patterns() -> tuple[re.Pattern, re.Pattern, regex.Pattern]:
    """``WORDS`` spelled out for the first 65,536 code points, what finds other ones, and ``WORDS``.

    The spelled-out form takes half the time. It tries letters and numbers before
    contractions, as no two of these can match at one place.
    """

    def members(kind: str) -> str:
        found = [i for i in range(1 << 16) if not 0xD800 <= i < 0xE000 and regex.match(kind, chr(i))]
        firsts = [i for i, before in zip(found, [-2, *found]) if i != before + 1]
        lasts = [i for i, after in zip(found, [*found[1:], -2]) if i != after - 1]
        return "".join(f"\\u{i:04x}-\\u{j:04x}" for i, j in zip(firsts, lasts))

    letter, number = members(r"\p{L}"), members(r"\p{N}")
    plain = rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{_SPACE}{letter}{number}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    return re.compile(plain), re.compile("[\U00010000-\U0010ffff]"), regex.compile(WORDS)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte: visible Latin-1 characters are their
    own, the other bytes follow from U+0100 on in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_tokenizer(path: str) -> dict:
    """Merges, labels and added tokens of a byte-level tokenizer file, on the driver.

    Raises ``ValueError`` for settings that this automaton does not stand for.
    """
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    model, split = stored["model"], stored["pre_tokenizer"]
    unsupported = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    unsupported += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
    if unsupported or stored.get("normalizer") or stored.get("post_processor") or split != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        raise ValueError(f"not a plain byte-level tokenizer: {unsupported or split}")
    added = {}
    for x in stored.get("added_tokens", []):
        if x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"]:
            raise ValueError(f"added token {x['content']!r} has options that are not supported")
        added[x["content"]] = x["id"]
    symbols, vocab = byte_symbols(), model["vocab"]
    label = lambda token: bytes(symbols[c] for c in token)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {
        "singles": [(vocab[c], b) for c, b in symbols.items() if c in vocab],
        "merges": [(vocab[u], vocab[v], vocab[u + v]) for u, v in merges],
        "labels": {i: label(t) for t, i in vocab.items() if t not in added} | {i: t.encode() for t, i in added.items()},
        "added": added,
    }


class Automaton:
    """States, implicit arcs, and a byte trie over the arc labels."""

    def __init__(self, singles: list[tuple[int, int]], merges: list[tuple[int, int, int]], labels: dict[int, bytes]):
        size = max(labels) + 1
        self.born = [0] * size  # the merge that made the token; 0: a single symbol
        self.left = [-1] * size
        self.base = [0] * size  # the state that followed the token when it was made
        self.cut: dict[int, int] = {}  # u << 32 | v -> the merge that removed v after u
        self.after = [0] * size  # the state an arc of this token leads to
        # The states in order: whose copies they are, and the merge that made them.
        self.owner, self.made = [-1], [0]
        made: set[int] = set()
        idle: set[int] = set()  # tokens that no word yields
        for step, (u, v, uv) in enumerate(merges, 1):
            if uv in made or uv in (u, v):
                raise ValueError(f"two merges make token {uv}")
            made.add(uv)
            # Earlier merges may leave no place where v follows u.
            if u in idle or v in idle or not self.has_arc(self.after[u], v):
                idle.add(uv)
                continue
            # Where v led before this merge: for u == v that is the old state.
            self.after[uv] = self.base[uv] = self.after[v]
            self.born[uv], self.left[uv] = step, u
            # The copy of the state after u that lacks v.
            self.owner.append(u)
            self.made.append(step)
            self.cut[u << 32 | v] = step
            self.after[u] = len(self.owner) - 1
        # The trie: node * 256 + byte -> node, and the token that ends at a node.
        trie: dict[int, int] = {}
        ends = [-1]
        for token, label in [(t, bytes([b])) for t, b in singles] + [(uv, labels[uv]) for _, _, uv in merges if uv not in idle]:
            node = 0
            for byte in label:
                node = trie.setdefault(node * 256 + byte, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = token
        self.trie, self.ends = trie, ends
        self.lengths = [len(labels.get(i, b"")) for i in range(size)]

    def has_arc(self, state: int, token: int) -> bool:
        """Follow the two rules, all copies made for one token at a time.

        The parents of a state are the earlier copies for the same token, then
        the state that followed this token when it was made, and so on. Among
        the copies up to ``made``, the one that removed ``part`` (the token, its
        left part, the left part of that) counts if it was made after ``part``
        and not after the token that ``part`` is the left part of.
        """
        born, left, cut = self.born, self.left, self.cut
        while state:
            owner, last = self.owner[state], self.made[state]
            part, until = token, last
            while part >= 0:
                step = cut.get(owner << 32 | part, 0)
                if born[part] < step <= until:
                    return False
                until = min(last, born[part])
                part = left[part]
            state = self.base[owner]
        return True

    def path(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word, the plain form of ``Tables.paths``."""
        n = len(word)
        came: list[int] = [-1] * (n + 1)
        for i in range(n):
            if i and came[i] < 0:
                raise KeyError(word[i - 1])
            state = self.after[came[i]] if i else 0
            node = 0
            for j in range(i, n):
                node = self.trie.get(node * 256 + word[j], -1)
                if node < 0:
                    break
                token = self.ends[node]
                if token >= 0 and came[j + 1] < 0 and self.has_arc(state, token):
                    came[j + 1] = token
        if n and came[n] < 0:
            raise KeyError(word[n - 1])
        out = []
        while n:
            out.append(came[n])
            n -= self.lengths[came[n]]
        return out[::-1]


class _Sorted:
    """A map from whole numbers to whole numbers, looked up for many keys at once.

    Open addressing in a table of twice the size or more; the multiplier spreads
    the keys and neighbouring places take what falls together.
    """

    def __init__(self, entries: dict[int, int], missing: int):
        bits = max(4, (4 * len(entries)).bit_length())
        self.shift, self.mask, self.missing = np.uint64(64 - bits), (1 << bits) - 1, missing
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, missing, dtype=np.int32)
        keys, values = np.array(list(entries), dtype=np.int64), np.array(list(entries.values()), dtype=np.int32)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            _, one = np.unique(place, return_index=True)
            first = np.zeros(len(keys), dtype=bool)
            first[one] = True
            put = free & first
            self.keys[place[put]], self.values[place[put]] = keys[put], values[put]
            keys, values, place = keys[~put], values[~put], (place[~put] + 1) & self.mask

    def getter(self) -> Callable[[int, int], int]:
        """``look`` for one key at a time, as ``dict.get``."""
        keys, values, shift, mask = memoryview(self.keys), memoryview(self.values), int(self.shift), self.mask

        def get(key: int, missing: int) -> int:
            place = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> shift
            while keys[place] != key:
                if keys[place] < 0:
                    return missing
                place = (place + 1) & mask
            return values[place]

        return get

    def _place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.values[place], self.missing)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            place[rest] = (place[rest] + 1) & self.mask
            found = self.keys[place[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[place[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out


class _Trie:
    """The byte trie as a double array: byte b leads from node n to ``base[n] + b``, if ``above`` there is n."""

    def __init__(self, automaton: Automaton):
        n = len(automaton.trie)
        keys, below = np.fromiter(automaton.trie, np.int64, n), np.fromiter(automaton.trie.values(), np.int64, n)
        order = np.argsort(keys)
        keys, below = keys[order], below[order]
        nodes, first, sizes = np.unique(keys >> 8, return_index=True, return_counts=True)
        codes, begin = (keys & 255).tolist(), np.zeros(len(nodes), dtype=np.int64)
        used, top = bytearray(b"\x01") + bytes(1023), 0
        # Nodes with many children come first. Each takes the first free places from ``start``
        # on, which leaves what is nearly full behind; single children fill that.
        start = alone = 1
        for k in np.argsort(-sizes, kind="stable").tolist():
            if top + 1024 > len(used):
                used.extend(bytes(len(used)))
            low, *rest = codes[first[k] : first[k] + sizes[k]]
            at, tries = used.find(0, max(low, start if rest else alone)), 0
            while any(used[at - low + byte] for byte in rest):
                at, tries = used.find(0, at + 1), tries + 1
            if rest:
                start = at if tries > 16 else start
            elif at > low:
                alone = at
            begin[k] = at - low
            for byte in (low, *rest):
                used[at - low + byte] = 1
            top = max(top, at - low + (rest[-1] if rest else low))
        place = np.zeros(len(automaton.ends), dtype=np.int64)
        place[below] = np.repeat(begin, sizes) + (keys & 255)
        self.base, self.above, self.ends = (np.full(top + 258, x, dtype=np.int32) for x in (0, -1, -1))
        self.base[place[nodes]], self.ends[place] = begin, automaton.ends
        self.above[place[below]] = place[keys >> 8]
        # The longest token that ends at a node or above it. Children come after their parents.
        longest = list(automaton.ends)
        for key, child in automaton.trie.items():
            if longest[child] < 0:
                longest[child] = longest[key >> 8]
        self.longest = np.full(top + 258, -1, dtype=np.int32)
        self.longest[place] = longest

    def getter(self) -> Callable[[int, int], int]:
        """The next node for node * 256 + byte, as ``dict.get``."""
        base, above = memoryview(self.base), memoryview(self.above)

        def get(key: int, missing: int) -> int:
            place = base[key >> 8] + (key & 255)
            return place if above[place] == key >> 8 else missing

        return get

    def look(self, data: np.ndarray) -> np.ndarray:
        """The longest token that begins at each byte of ``data``; a value of 256 ends all."""
        node, at, step = np.zeros(len(data), dtype=np.int32), np.arange(len(data)), 0
        while len(at):
            here = node[at]
            place = self.base[here] + data[at + step]
            inside = np.flatnonzero(self.above[place] == here)
            at = at[inside]
            node[at] = place[inside]
            step += 1
        return self.longest[node]


class Tables:
    """A compiled automaton as flat arrays."""

    def __init__(self, automaton: Automaton):
        flat = lambda values: np.array(values, dtype=np.int32)
        self.born, self.left, self.after = flat(automaton.born), flat(automaton.left), flat(automaton.after)
        self.owner, self.made, self.lengths = flat(automaton.owner), flat(automaton.made), flat(automaton.lengths)
        # The state before the copies of a state's token; the first state has none.
        self.base = flat(automaton.base)
        self.before = np.where(self.owner >= 0, self.base[self.owner], 0)
        self.cut = _Sorted(automaton.cut, 0)
        self.trie = _Trie(automaton)
        # The next token that is a beginning of a token.
        self.shorter = np.full(len(self.born), -1, dtype=np.int32)
        at = np.flatnonzero(self.trie.ends >= 0)
        self.shorter[self.trie.ends[at]] = self.trie.longest[self.trie.above[at]]
        # Pairs of a state and a token that were looked at last, by their hash: the pair * 2, 1 more if there is an arc.
        self.seen = np.full(KEPT_ARCS, -1, dtype=np.int64)

    def automaton(self) -> Automaton:
        """The automaton on these arrays, for long words, one at a time; nothing is copied."""
        found = Automaton.__new__(Automaton)
        for name in ("born", "left", "base", "after", "owner", "made", "lengths"):
            setattr(found, name, memoryview(getattr(self, name)))
        found.ends = memoryview(self.trie.ends)
        found.cut, found.trie = SimpleNamespace(get=self.cut.getter()), SimpleNamespace(get=self.trie.getter())
        return found

    def has_arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """``Automaton.has_arc`` for many pairs of a state and a token."""
        out = np.ones(len(states), dtype=bool)
        live = np.flatnonzero(states > 0)
        states = states[live].astype(np.int64)
        tokens = tokens[live].astype(np.int64)
        while len(live):
            owner, last = self.owner[states].astype(np.int64), self.made[states]
            part, until, at = tokens, last, np.arange(len(live))
            while len(at):
                step, born = self.cut.look((owner[at] << 32) | part), self.born[part]
                removed = (born < step) & (step <= until)
                out[live[at[removed]]] = False
                until = np.minimum(last[at], born)
                part = self.left[part].astype(np.int64)
                go = ~removed & (part >= 0)
                at, part, until = at[go], part[go], until[go]
            states = self.before[states].astype(np.int64)
            go = out[live] & (states > 0)
            live, states, tokens = live[go], states[go], tokens[go]
        return out

    def kept_arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """``has_arcs``, of which the last answers are kept: few pairs are most of a text."""
        pairs = (states.astype(np.int64) << 32) | tokens
        place = ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - KEPT_ARCS.bit_length())).astype(np.int64)
        seen = self.seen[place]
        new = np.flatnonzero(seen >> 1 != pairs)
        if len(new):
            seen[new] = pairs[new] * 2 + self.has_arcs(states[new], tokens[new])
            self.seen[place[new]] = seen[new]
        return seen & 1 == 1

    def paths(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-split word as packed int32. KeyError if a byte has no symbol."""
        ids, counts = self.flat_paths(words)
        packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [packed[low:high] for low, high in zip([0, *ends], ends)]

    def flat_paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-split words, one word after the other, and how many each has.

        The words advance together. Each has a place, the state there and the
        token to try next, from the longest that begins there to shorter ones; when none
        is left it goes back by its last token and tries what is shorter than that.
        """
        if not words:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        long = [k for k, word in enumerate(words) if len(word) > LONG_WORD]
        if long:
            plain = self.automaton()
            found = self.flat_paths([word if len(word) <= LONG_WORD else b"" for word in words])
            return spliced(*found, long, [np.array(plain.path(words[k]), dtype=np.int32) for k in long])
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        home = np.cumsum(sizes + 1) - sizes - 1
        # Every word has one place more than bytes.
        data = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8).astype(np.int32)
        data[home + sizes] = 256
        came = np.full(len(data), -1, dtype=np.int32)  # the token that came to each place
        first = self.trie.look(data)
        live = np.flatnonzero(sizes > 0)
        begin, stop = home[live], home[live] + sizes[live]
        at, state, token = begin.copy(), np.zeros(len(live), dtype=np.int32), first[begin]
        while len(at):
            back = np.flatnonzero(token < 0)
            if len(back):
                if (at[back] == begin[back]).any():
                    raise KeyError("a byte without a symbol")
                last = came[at[back]]
                at[back] -= self.lengths[last]
                token[back] = self.shorter[last]
                state[back] = np.where(at[back] > begin[back], self.after[came[at[back]]], 0)
            open_ = np.flatnonzero(token >= 0)
            open_ = open_[came[at[open_] + self.lengths[token[open_]]] < 0]
            go = open_[self.kept_arcs(state[open_], token[open_])]
            taken = token[go]
            token = np.where(token >= 0, self.shorter[token], -1)
            at[go] += self.lengths[taken]
            came[at[go]] = taken
            state[go], token[go] = self.after[taken], first[at[go]]
            ended = at == stop
            if ended.any():
                more = ~ended
                at, begin, stop, state, token = at[more], begin[more], stop[more], state[more], token[more]
        # Backwards from the end, all words at once.
        passed = np.zeros(len(data), dtype=bool)
        live = np.flatnonzero(sizes > 0)
        begin, at = home[live], home[live] + sizes[live]
        while len(at):
            passed[at] = True
            at = at - self.lengths[came[at]]
            more = at > begin
            at, begin = at[more], begin[more]
        return came[passed], np.add.reduceat(passed, home, dtype=np.int64)


def spliced(ids: np.ndarray, counts: np.ndarray, words: list[int], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` and ``counts`` of each word, with the parts as the ids of some words that have none."""
    sizes = [len(part) for part in parts]
    places = np.repeat((np.cumsum(counts) - counts)[words], sizes)
    counts[words] = sizes
    return np.insert(ids, places, np.concatenate(parts)), counts


class _Numbers(dict):
    """Words and their numbers; one that is not there gets the next number and is ``fresh``."""

    def __init__(self):
        self.kept, self.fresh = 0, []

    def __missing__(self, word: str) -> int:
        number = self[word] = self.kept + len(self.fresh)
        self.fresh.append(word)
        return number


class Encoder:
    """Text to packed ids and back, with the added tokens taken out first."""

    def __init__(self, compiled: dict):
        self.tables: Tables = compiled["tables"]
        self.added_ids: dict[str, int] = compiled["added"]
        self.labels: list[bytes] = compiled["labels"]
        self.known = _Numbers()
        # The ids of the known words by their number, and how many each has.
        self.ids, self.counts = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.plain, self.wide, self.split = word_patterns()
        by_length = sorted(self.added_ids, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None

    def _words(self, text: str | None) -> list[str]:
        """The words of a text; an added token is one, and no other word can be equal to it."""
        if not text:
            return []
        if self.added is not None and self.added.search(text):
            parts = self.added.split(text)
            return list(chain.from_iterable([p] if i % 2 else self._words(p) for i, p in enumerate(parts)))
        return (self.plain if text.isascii() or not self.wide.search(text) else self.split).findall(text)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words, one word after the other, and how many each has."""
        added = [k for k, word in enumerate(words) if word in self.added_ids]
        found = self.tables.flat_paths([b"" if word in self.added_ids else word.encode() for word in words])
        return spliced(*found, added, [np.array([self.added_ids[words[k]]], dtype=np.int32) for k in added]) if added else found

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Forget of the new words what is long, and all once there is enough."""
        known, fresh = self.known, self.known.fresh
        full = known.kept + len(fresh) > KEPT_WORDS
        short = np.array([not full and len(word) <= KEPT_LENGTH for word in fresh], dtype=bool)
        for k in np.flatnonzero(~short).tolist():
            del known[fresh[k]]
        if not full:
            # A number that was forgotten stays empty.
            self.ids = np.concatenate([self.ids, ids[np.repeat(short, counts)]])
            self.counts = np.concatenate([self.counts, counts * short])
            known.kept += len(fresh)
        known.fresh = []

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and where each begins and the last ends."""
        words = [self._words(text) for text in texts]
        starts = np.cumsum([0, *map(len, words)])
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(starts[-1]))
        del words
        ids, counts = self.ids, self.counts
        if self.known.fresh:
            new_ids, new_counts = self._learn(self.known.fresh)
            ids, counts = np.concatenate([ids, new_ids]), np.concatenate([counts, new_counts])
            self._keep(new_ids, new_counts)
        first = np.cumsum(counts) - counts
        counts = counts[numbers]
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(ends[-1], dtype=np.int32)
        for k in range(0, len(numbers), BLOCK_WORDS):
            part = slice(k, k + BLOCK_WORDS)
            low, high = ends[k], ends[min(k + BLOCK_WORDS, len(numbers))]
            out[low:high] = ids[np.repeat(first[numbers[part]] - ends[:-1][part], counts[part]) + np.arange(low, high)]
        return out, ends[starts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed int32 ids of each text."""
        ids, ends = self.encode_flat(texts)
        return [ids[low:high].tobytes() for low, high in zip(ends.tolist(), ends[1:].tolist())]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


def joined(labels: pa.Array, rows: pa.Array) -> pa.Array | None:
    """The texts of a column of ids, their labels joined by Arrow; None for bytes that are no text and for odd ids."""
    try:
        taken = labels.take(rows.flatten())
        if taken.null_count:
            return None
        counts = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int32, len(taken) + 1, 4 * taken.offset)[np.cumsum([0, *counts])]
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), data]).cast(pa.string())
    except (pa.ArrowInvalid, pa.ArrowIndexError):
        return None


def compiled(tokenizer: dict) -> dict:
    """The tables that go to the executors, from the parts of a tokenizer file."""
    labels = tokenizer["labels"]
    return {
        "tables": Tables(Automaton(tokenizer["singles"], tokenizer["merges"], labels)),
        "added": tokenizer["added"],
        "labels": [labels.get(i, b"") for i in range(max(labels) + 1)],
    }


def _with_column(df: DataFrame, column: str, out: str, kind: str, values: Callable[[Iterator[pa.Array]], Iterator[pa.Array]]) -> DataFrame:
    """``df`` with a new column, made from slices of the values of another.

    Columns travel under plain names, so that theirs may hold any character.
    """
    if out in df.columns:
        raise ValueError(f"the table already has a column {out}")
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []

        def read() -> Iterator[pa.Array]:
            for part in slices(batches):
                parts.append(part)
                yield part.column(at)

        for made in values(read()):
            part = parts.pop()
            yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, "made"])

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema] + [f"made {kind}"])
    return plain.mapInArrow(run, schema).toDF(*df.columns, out)


class ByteTokenizer:
    """A tokenizer on a cluster: the driver compiles the file and sends its tables once.

    The tables are as large as the vocabulary, a few MB, and do not grow with
    the data. Executors need not have the file.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.shared = spark.sparkContext.broadcast(compiled(read_tokenizer(path)))

    def encode(self, df: DataFrame, text_col: str = "text", out: str = "ids") -> DataFrame:
        """``df`` with the ids of the whole text as array<int>; null and empty texts give no ids.

        Rows are encoded one by one, so rows that repeat stay, and an empty table
        gives an empty one. Very long texts are encoded whole.
        All rows and columns stay; a column named ``out`` in ``df`` is an error.
        """
        shared = self.shared

        def run(slices_of_texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = Encoder(shared.value)
            for texts in slices_of_texts:
                ids, ends = encoder.encode_flat(texts.to_pylist())
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

        return _with_column(df, text_col, out, "array<int>", run)

    def decode(self, df: DataFrame, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
        """``df`` with the text of the ids; null ids give the empty text."""
        shared = self.shared

        def run(slices_of_ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder, labels = Encoder(shared.value), pa.array(shared.value["labels"], pa.binary())
            for rows in slices_of_ids:
                texts = joined(labels, rows)
                yield pa.array([encoder.decode(ids or []) for ids in rows.to_pylist()], pa.string()) if texts is None else texts

        return _with_column(df, ids_col, out, "string", run)


def ids_digest(ids_col: str = "ids"):
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256)
