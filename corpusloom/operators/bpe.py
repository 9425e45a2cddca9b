"""Byte-pair vocabulary: encoding and decoding. ``bpe_training`` makes it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import id_tokens, words
from corpusloom.operators.merging import MergeTable, merge_words

# Special tokens in id order, and their roles.
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<pad>")
UNKNOWN, BEGIN, END, PAD = SPECIAL_TOKENS

VOCAB_SIZE = 10_000
# What a task holds beside its batch: words whose rows are worked on together, bytes
# of distinct words that are merged at once, words whose ids are gathered at once.
ROWS_WORDS = 1 << 21
MERGED_BYTES = 1 << 19
GATHERED_WORDS = 1 << 17
# The pre-tokenizer on the driver: Python's classes are Unicode-aware as they are.
WORDS = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class BpeTokenizer:
    """Token strings by id and merges in rank order; the vocabulary size bounds both."""

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]
    unknown: str | None = UNKNOWN
    pad: str | None = PAD
    end: str | None = END
    specials: tuple[str, ...] = SPECIAL_TOKENS

    def id_of(self, token: str | None) -> int | None:
        return self.tokens.index(token) if token in self.tokens else None

    @property
    def pad_id(self) -> int:
        """The padding id; the end token stands in if there is no padding token."""
        for token in (self.pad, self.end):
            if token is not None and self.id_of(token) is not None:
                return self.id_of(token)
        raise ValueError("the tokenizer needs a padding token or an end token")

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, t in self.specials) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "id int, token string, is_special boolean")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        names = self.tokens
        rows = [(r, names[a], names[b], names[c]) for r, (a, b, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, merged string")


def _words_and_specials(text: Column, specials: list[str]) -> Column:
    """Words of the text between special tokens, and these tokens as words of their own."""
    if not specials:
        return words(text)
    listed = "|".join(r"\Q" + s + r"\E" for s in sorted(specials, key=len, reverse=True))
    pieces = F.split(text, rf"(?<=(?:{listed}))|(?=(?:{listed}))")
    cut = F.flatten(F.transform(pieces, lambda p: F.when(p.isin(*specials), F.array(p)).otherwise(words(p))))
    # The pattern looks around at every character, which costs more than all words of a text.
    return F.when(reduce(or_, [text.contains(s) for s in specials]), cut).otherwise(words(text))


def _byte_offsets(strings: pa.Array) -> np.ndarray:
    """Where each string begins, and the last one ends; nothing is copied."""
    if not len(strings):
        return np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    return np.frombuffer(strings.buffers()[1], kind)[strings.offset : strings.offset + len(strings) + 1]


def _ranges(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, number) of neighbours that take at most so much together, or of a single one."""
    first = 0
    while first < len(offsets) - 1:
        end = max(first + 1, int(np.searchsorted(offsets, int(offsets[first]) + most, side="right")) - 1)
        yield first, end - first
        first = end


class WordEncoder:
    """Ids of words: characters to ids, then all merges, for many words at once."""

    def __init__(self, tokenizer: BpeTokenizer):
        codes = {t: i for i, t in enumerate(tokenizer.tokens)}
        self.specials = {s: codes[s] for s in tokenizer.specials if s in codes}
        letters = sorted((ord(t), i) for t, i in codes.items() if len(t) == 1)
        self.points = np.array([p for p, _ in letters] or [-1], dtype=np.int64)
        self.letters = np.array([i for _, i in letters] or [-1], dtype=np.int64)
        unknown = tokenizer.id_of(tokenizer.unknown)
        self.unknown = -1 if unknown is None else unknown
        self.table = MergeTable(list(tokenizer.merges))

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word)."""
        plain = [w for w in words if w not in self.specials]
        points = np.frombuffer("".join(plain).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        place = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        ids = np.where(self.points[place] == points, self.letters[place], self.unknown)
        ordinary = np.array([w not in self.specials for w in words], dtype=bool)
        word = np.repeat(np.flatnonzero(ordinary), [len(w) for w in plain])
        ids, word = merge_words(ids[ids >= 0], word[ids >= 0], self.table)
        special = np.flatnonzero(~ordinary)
        if len(special):
            ids = np.concatenate([ids, [self.specials[words[w]] for w in special.tolist()]])
            word = np.concatenate([word, special])
            order = np.argsort(word, kind="stable")
            ids, word = ids[order], word[order]
        return ids, np.bincount(word, minlength=len(words))

    def pieces(self, rows: pa.Array) -> Iterator[pa.Array]:
        """``rows`` of a batch, some rows at a time."""
        for first, n in _ranges(rows.offsets.to_numpy(), ROWS_WORDS):
            yield self.rows(rows.slice(first, n))

    def rows(self, rows: pa.Array) -> pa.Array:
        """Id arrays of arrays of words; each distinct word of the rows is merged once."""
        found = rows.flatten().dictionary_encode()
        merged = [self.words(found.dictionary.slice(*r).to_pylist()) for r in _ranges(_byte_offsets(found.dictionary), MERGED_BYTES)]
        ids, sizes = (np.concatenate(m).astype(np.int32) for m in zip(*merged)) if merged else (np.zeros(0, np.int32),) * 2
        starts = np.cumsum(sizes) - sizes
        values, index = [np.zeros(0, dtype=np.int32)], found.indices.to_numpy()
        for first in range(0, len(index), GATHERED_WORDS):
            word = index[first : first + GATHERED_WORDS]
            each = sizes[word]
            ends = np.cumsum(each)
            values.append(ids[np.arange(each.sum()) + np.repeat(starts[word] - (ends - each), each)])
        ends = np.zeros(len(index) + 1, dtype=np.int32)
        np.cumsum(sizes[index], out=ends[1:])
        offsets = ends[rows.offsets.to_numpy() - rows.offsets[0].as_py()]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)), mask=rows.is_null())


def encode(text: Column, tokenizer: BpeTokenizer) -> Column:
    """Token ids of a text; one unknown id per unknown character, null for null.

    Special tokens in the text are taken out first and keep their ids; none is
    added. Spark splits the text; only the merging inside words runs in Python, on
    pieces of Arrow batches, once per distinct word of each. Nothing is shuffled:
    sending every word of the corpus to its dictionary row and back would move
    far more data than the texts hold.
    """
    encoder = WordEncoder(tokenizer)

    @F.arrow_udf("array<int>")
    def merge_rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = None
        for rows in batches:
            yield from encoder.pieces(rows)
        # The process outlives the task, and Arrow would keep what its batches took.
        del rows
        pa.default_memory_pool().release_unused()

    return merge_rows(_words_and_specials(text, list(encoder.specials)))


def encode_text(text: str, tokenizer: BpeTokenizer) -> list[int]:
    """Ids of one short text on the driver, such as a marker to look for."""
    plain = [m.group() for m in WORDS.finditer(text)]
    return WordEncoder(tokenizer).words(plain)[0].tolist()


def decode(ids: Column, tokenizer: BpeTokenizer, skip_specials: bool = True) -> Column:
    """Tokens joined by spaces, with or without the special ones."""
    if skip_specials:
        special = [i for i, t in enumerate(tokenizer.tokens) if t in tokenizer.specials]
        ids = F.filter(ids, lambda i: ~i.isin(*special)) if special else ids
    return F.array_join(ids_to_tokens(ids, tokenizer), " ")


def ids_to_tokens(ids: Column, tokenizer: BpeTokenizer) -> Column:
    return id_tokens(ids, list(tokenizer.tokens))
