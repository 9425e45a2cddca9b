"""Secrets: fixed patterns, and values in credential contexts that are costly to guess.

The cost of a value is the least sum, over all ways to cut it into known words,
dates, repeats, keyboard walks and single characters, of the logarithm (base 10)
of the guesses that each piece takes. It is found by dynamic programming from
left to right. Costly values in credential contexts become spans of their own. Words
are ranked by a short list of common parts of passwords and by the corpus itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, quoted, slices
from corpusloom.session import collect_bounded

# The patterns of the three basic kinds, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of fewer never counts
KINDS = ("assign", "access", "hex", "guess")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Words before a value that make it a credential, with names of headers.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth(?:orization)?)"""
    r"""["']?\x20*[:=]\x20*(?:(?:bearer|basic|token)\x20+)?["']?([^\s"'<>]{6,})""",
    re.ASCII | re.IGNORECASE,
)
#: The password of a user in a URL.
IN_URL = re.compile(r"://[^\s/:@\"'<>]{1,64}:([^\s/@\"'<>]{6,256})@")
#: One of these is in every text that either pattern can match.
HINTS = ("passw", "passp", "passc", "pwd", "secret", "token", "api", "key", "credential", "auth")

#: Common parts of passwords and placeholders, most common first.
WORDS = (
    "password", "qwerty", "admin", "welcome", "letmein", "login", "test", "user", "guest", "root", "master", "dragon",
    "monkey", "shadow", "secret", "token", "hello", "love", "pass", "default", "changeme", "example", "sample", "demo",
    "your", "here", "my", "key", "api", "access", "auth", "null", "none", "true", "false", "undefined", "todo", "xxx",
    "value", "string", "env", "config", "public", "private", "server", "client", "database", "summer", "winter",
    "spring", "autumn", "sunshine", "princess", "football", "baseball", "superman", "batman", "iloveyou", "trustno1",
)
#: Words of the corpus that are known besides, by documents that hold them.
CORPUS_WORDS = 20_000
WORD_GROUPS = 16
SHORTEST, LONGEST = 3, 20

# Rows of a keyboard, and how far each is moved to the right, in quarters of a key.
_KEYS = (("1234567890", 0), ("qwertyuiop", 2), ("asdfghjkl", 3), ("zxcvbnm", 5))
_LONGEST_WALK = 64
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_LONGEST_DATE = 10
#: A single character takes this many guesses; a piece more costs this much.
SINGLE, PIECE = 1.0, 0.3
#: Guesses for a run of n: repeats of one character, walks over neighbouring keys; for a date.
REPEAT, WALK, DATE = 10, 40, 365 * 40


def _neighbours() -> frozenset[str]:
    """Pairs of keys that touch: beside each other, or on the rows above and below; and letters in order."""
    place = {c: (4 * x + shift, y) for y, (row, shift) in enumerate(_KEYS) for x, c in enumerate(row)}
    near = {a + b for a, (x, y) in place.items() for b, (u, v) in place.items() if a != b and abs(y - v) <= 1 and abs(x - u) <= (4 if y == v else 3)}
    letters = "abcdefghijklmnopqrstuvwxyz"
    return frozenset(near | {a + b for a, b in zip(letters, letters[1:])} | {b + a for a, b in zip(letters, letters[1:])})


_NEXT = _neighbours()


def ranked_words(corpus: list[str] | tuple[str, ...] = ()) -> dict[str, int]:
    """Word to rank: the common parts of passwords first, then the words of a corpus, most common first."""
    rank: dict[str, int] = {}
    for word in (*WORDS, *corpus):
        if word not in rank and len(word) <= LONGEST:
            rank[word] = len(rank) + 1
    return rank


_COMMON = ranked_words()


def pieces_ending_at(value: str, low: str, j: int, repeat_from: int, walk_from: int, ranks: dict[str, int]) -> Iterator[tuple[int, float]]:
    """(start, price) of the pieces that end at j and are not single characters.

    A repeat may start anywhere in its run; starts further than ``LONGEST`` into
    it are never part of a cheapest cut, as moving them to the left costs less
    than any piece before them. A walk has at most ``_LONGEST_WALK`` keys.
    """
    for start in range(repeat_from, min(repeat_from + LONGEST, j - 3) + 1):
        yield start, log10(REPEAT * (j - start))
    for start in range(max(walk_from, j - _LONGEST_WALK), j - 2):
        yield start, log10(WALK * (j - start))
    for start in range(max(0, j - LONGEST), j - 1):
        rank = ranks.get(low[start:j])
        if rank:
            yield start, log10(rank) + (0.5 if value[start:j] != low[start:j] else 0)
    for start in range(max(0, j - _LONGEST_DATE), j - 3):
        if value[start].isdigit() and _DATE.fullmatch(value, start, j):
            yield start, log10(DATE)


def guess_cost(value: str, ranks: dict[str, int] = _COMMON) -> float:
    """log10 of the guesses for ``value``; 0 for the empty value.

    The least sum over all cuts into pieces. A stretch of single characters is
    one piece, so there are two states at each place: the cheapest way that ends
    in such a stretch, which the next character may join, and the cheapest that
    ends in another piece. Time is linear in the length.
    """
    n = len(value)
    low = value.lower() if len(value.lower()) == n else value
    inf = float("inf")
    single, closed = [inf] * (n + 1), [inf] * (n + 1)
    closed[0] = 0.0
    repeat_from = walk_from = 0
    for j in range(1, n + 1):
        if j >= 2:
            if low[j - 2] != low[j - 1]:
                repeat_from = j - 1
            if low[j - 2] + low[j - 1] not in _NEXT:
                walk_from = j - 1
        single[j] = min(single[j - 1] + SINGLE, closed[j - 1] + SINGLE + PIECE)
        for start, price in pieces_ending_at(value, low, j, repeat_from, walk_from, ranks):
            cost = min(single[start], closed[start]) + price + PIECE
            if cost < closed[j]:
                closed[j] = cost
    return min(single[n], closed[n])


def corpus_words(df: DataFrame, text_col: str = "text", most: int = CORPUS_WORDS) -> list[str]:
    """The ``most`` words of 3 to 20 letters a-z that most rows hold, A-Z in lower case.

    Counted over all rows and whole texts; ties go by the word. The best of each of
    ``WORD_GROUPS`` groups of words are found first, so what reaches the driver is
    bounded by ``most`` whatever the number of partitions.
    """
    letters = F.regexp_extract_all(F.lower(F.coalesce(quoted(text_col), F.lit(""))), F.lit(rf"(?<![a-z])[a-z]{{{SHORTEST},{LONGEST}}}(?![a-z])"), F.lit(0))
    counts = df.select(F.explode(F.array_distinct(letters)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    best = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(WORD_GROUPS))).orderBy(F.desc("n"), "word")
    few = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    rows = collect_bounded(few.select("word", "n"), WORD_GROUPS * most, "words of the groups")
    return [r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))[:most]]


def find_secrets(text: str, least_cost: float, ranks: dict[str, int] = _COMMON) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, cost) by start, then kind; cost 0 where no value is priced."""
    found = []
    low = text.lower()
    near = any(h in low for h in HINTS) or not text.isascii()
    if near:
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end(), guess_cost(m.group(2), ranks)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), 0.0) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), 0.0) for m in HEX.finditer(text)]
    values = {m.span(1) for m in CONTEXT.finditer(text)} if near else set()
    if "://" in text:
        values |= {m.span(1) for m in IN_URL.finditer(text)}
    for start, end in values:
        cost = guess_cost(text[start:end], ranks)
        if cost >= least_cost:
            found.append((start, 3, end, cost))
    return [(s, KINDS[k], e, c) for s, k, e, c in sorted(found)]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_cost: float = 8.0, words: int = CORPUS_WORDS) -> DataFrame:
    """(_id, _th, secrets, base_sha256), one row per row of ``df``.

    secrets: (kind, start, end, cost) in code points, end exclusive, by start
    and then kind. Basic spans cover the whole match. A "guess" span covers the
    value in a credential context (after a credential word, an authorization
    header, or as the password in a URL) if it takes at least 10**least_cost
    guesses; it may lie inside a basic span. ``cost`` prices the value of "assign"
    and "guess" spans. Known words are the fixed common ones and the ``words`` most
    common of the table. base_sha256 digests the basic spans as kind:start:end,
    joined by commas. Null counts as empty; a text without secrets has an empty
    list. Rows that repeat an id, null included, are separate rows; an empty
    table gives an empty one; other columns are not read.
    """
    ranks = ranked_words(corpus_words(df, text_col, words)) if words else _COMMON
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))
        known = shared.value
        for part in slices(batches):
            lists = [find_secrets(t, least_cost, known) for t in part.column(2).to_pylist()]
            base = [",".join(f"{k}:{s}:{e}" for s, k, e, _ in x if k != "guess") for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1),
                    pa.array([[{"kind": k, "start": s, "end": e, "cost": c} for s, k, e, c in x] for x in lists], kind),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                ],
                ["_id", "_th", "secrets", "base_sha256"],
            )

    return keyed(df, id_col, text_col).mapInArrow(
        run, "_id long, _th long, secrets array<struct<kind: string, start: long, end: long, cost: double>>, base_sha256 string"
    )


def count_kind(kind: str):
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
