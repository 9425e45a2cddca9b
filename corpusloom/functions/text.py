"""Cleaning, splitting and dictionary lookups on text columns."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as a Unicode-aware strip sees it, the words that
# stand for a missing value, and the pre-tokenizer's pattern.
SPACE = r"[\s\x1c-\x1f]"
MISSING_WORDS = ("none", "nan")
WORD_PATTERN = r"(?U)\w+|[^\w\s]+"

_STRIP = rf"(?U)\A{SPACE}++|(?<!{SPACE}){SPACE}++\z"
_MISSING = rf"(?i)\A(?:{'|'.join(MISSING_WORDS)})\z"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` knows only the space)."""
    return F.regexp_replace(text, _STRIP, "")


def clean_text(value: Column) -> Column:
    """Text of any value, stripped; null and words for "missing" become empty."""
    return F.coalesce(F.regexp_replace(strip(value.cast("string")), _MISSING, ""), F.lit(""))


def naive_strip(value: Column | None) -> Column:
    """Compatibility form: an absent column is empty, a null in it is the text "None"."""
    if value is None:
        return F.lit("")
    return F.coalesce(strip(value.cast("string")), F.lit("None"))


def chars(text: Column) -> Column:
    """Characters of a text, one array item per code point."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def charset(text: Column) -> Column:
    """Sorted distinct characters of one text."""
    return F.array_sort(F.array_distinct(chars(text)))


def words(text: Column) -> Column:
    """Runs of word characters, or of characters neither word nor space."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def char_lookup(entries: dict[str, int]):
    """Function from a one-character Column to its id, null if unknown.

    The map becomes one constant in the plan: pages of 256 code points, so a
    lookup is two array reads whatever the size of the alphabet. Unicode bounds
    it to 1,114,112 entries, and unused pages stay empty.
    """
    pages: dict[int, dict[int, int]] = {}
    for char, code in entries.items():
        pages.setdefault(ord(char) >> 8, {})[ord(char) & 255] = code
    table = [
        [pages[p].get(k) for k in range(max(pages[p]) + 1)] if p in pages else []
        for p in range(max(pages, default=-1) + 1)
    ]
    constant = F.from_json(F.lit(json.dumps(table)), "array<array<int>>")

    def find(char: Column) -> Column:
        point = F.ascii(char)
        return F.get(F.get(constant, F.shiftright(point, 8)), point.bitwiseAND(255))

    return find


def encode_chars(text: Column, entries: dict[str, int], unknown: str = "error") -> Column:
    """Character ids of a text. Unknown characters: "error" fails, "drop" leaves them out."""
    find = char_lookup(entries)
    if unknown == "drop":
        return F.filter(F.transform(chars(text), find), lambda i: i.isNotNull())
    if unknown != "error":
        raise ValueError(f"unknown must be 'error' or 'drop', not {unknown!r}")
    return F.transform(
        chars(text),
        lambda c: F.coalesce(
            find(c), F.raise_error(F.concat(F.lit("character not in vocabulary: "), c)).cast("int")
        ),
    )


def keep_known_chars(text: Column, entries: dict[str, int]) -> Column:
    """The text without the characters that are not in the vocabulary."""
    find = char_lookup(entries)
    return F.array_join(F.filter(chars(text), lambda c: find(c).isNotNull()), "")


def id_tokens(ids: Column, tokens: list[str], unknown: str = "error") -> Column:
    """Token strings of an id array. Unknown ids: "error" fails, "drop" leaves them out."""
    constant = F.from_json(F.lit(json.dumps(tokens, ensure_ascii=False)), "array<string>")
    if unknown == "drop":
        found = F.transform(ids, lambda i: F.when(i >= 0, F.get(constant, i)))
        return F.filter(found, lambda t: t.isNotNull())
    if unknown != "error":
        raise ValueError(f"unknown must be 'error' or 'drop', not {unknown!r}")
    return F.transform(
        ids,
        lambda i: F.coalesce(
            F.when(i >= 0, F.get(constant, i)),
            F.raise_error(F.concat(F.lit("id not in vocabulary: "), i.cast("string"))).cast("string"),
        ),
    )


def decode_chars(ids: Column, tokens: list[str], unknown: str = "error") -> Column:
    """Text of a character id array."""
    return F.array_join(id_tokens(ids, tokens, unknown), "")
