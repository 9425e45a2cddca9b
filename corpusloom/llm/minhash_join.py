"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Bands and rows follow from the recall wanted at the threshold. Texts with the
same word sequence form one class and are joined once. Classes that share a band
hash are candidates; a bucket of g classes is not expanded into g*g pairs:

1. Every class is compared with the most central class of each of its buckets.
   Exact matches link classes into components.
2. Inside a bucket only classes of different components can still add a
   connection. Those outside the bucket's largest component are compared with
   all classes of other components in it.

A one-bit sketch of all hash values drops pairs far below the threshold before
their texts are fetched. In the second step an exact bound drops more: grams that
no other candidate text has cannot be shared, so a text with u of n such grams has
at most n - u in common with any other. What is left is verified on the exact n-gram
sets. Every pair that shares a bucket is now either compared or in one component.

3. Links inside a component are counted without a row per pair: the component is
   dealt into tiles of bounded size, and a task takes two tiles and counts the
   links of each text from the sizes of all intersections of their gram sets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, slices
from corpusloom.llm.components import connected_components
from corpusloom.session import materialize

WORD = re.compile(r"\w+")
KEPT_WORDS = 250_000
SKETCH_BITS = 192


@dataclass(frozen=True)
class Banding:
    """n words a gram, Jaccard ``threshold``, and the recall wanted at it."""

    n: int = 5
    threshold: float = 0.8
    recall: float = 0.999
    rows: int = 6
    seed: int = 7

    @property
    def bands(self) -> int:
        """Fewest bands so that a pair at the threshold shares one with ``recall``."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.rows))

    @property
    def sketch_floor(self) -> int:
        """Equal sketch bits that a pair at the threshold has but for 5 deviations.

        Bits of two texts are equal with probability (1 + similarity) / 2.
        """
        p = (1 + self.threshold) / 2
        return math.floor(SKETCH_BITS * p - 5 * math.sqrt(SKETCH_BITS * p * (1 - p)))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(words: list[str], n: int) -> set[str]:
    """Distinct runs of n words; a shorter text is one gram of all its words."""
    if not words:
        return set()
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(self) < KEPT_WORDS and len(word) <= 64:
            self[word] = value
        return value


def gram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of n word hashes; a shorter text is padded to one run."""
    if len(w) < n:
        w = np.concatenate([w, np.zeros(n - len(w), dtype=np.uint64)])
    x = np.zeros(len(w) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            x = (x ^ w[i : i + len(x)]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
    return x


class Signer:
    """Band hashes and sketch of a text, in steps of bounded memory."""

    def __init__(self, banding: Banding):
        self.b = banding
        rng = np.random.default_rng(banding.seed)
        self.k = max(SKETCH_BITS, banding.bands * banding.rows)
        self.mul = (rng.integers(0, 1 << 31, self.k, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.add = rng.integers(0, 1 << 32, self.k, dtype=np.uint64).astype(np.uint32)[:, None]
        self.fold = (rng.integers(0, 1 << 62, banding.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        self.band = rng.integers(0, 1 << 62, banding.bands, dtype=np.uint64)
        self.words = _Hashes()

    def hashed(self, words: list[str]) -> np.ndarray:
        w = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint64, count=len(words))
        return gram_hashes(w, self.b.n)

    def sign(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        x = self.hashed(words)
        least = np.full(self.k, 0xFFFFFFFF, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for start in range(0, len(x), 512):
                grams = (x[start : start + 512] >> np.uint64(32)).astype(np.uint32)[None, :]
                np.minimum(least, (grams * self.mul + self.add).min(axis=1), out=least)
            rows = least[: self.b.bands * self.b.rows].astype(np.uint64).reshape(self.b.bands, self.b.rows)
            bands = self.band.copy()
            for r in range(self.b.rows):
                bands = (bands ^ rows[:, r]) * self.fold[r]
                bands ^= bands >> np.uint64(31)
            bits = ((least[:SKETCH_BITS] * np.uint32(0x85EBCA6B)) >> np.uint32(31)).astype(np.uint8)
        return bands.view(np.int64), np.packbits(bits).view(np.int64)


def _signatures(banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(banding)
        for part in slices(batches):
            classes, counts, bands, sketches = [], [], [], []
            for text in part.column(2).to_pylist():
                words = words_of(text)
                digest = hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()
                classes.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
                counts.append(len(words))
                b, s = signer.sign(words) if words else (np.zeros(0, np.int64), np.zeros(3, np.int64))
                bands.append(b)
                sketches.append(s)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array([c[0] for c in classes], pa.int64()),
                    pa.array([c[1] for c in classes], pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())), *[pa.array([int(s[i]) for s in sketches], pa.int64()) for i in range(3)],
                ],
                ["_id", "_th", "c1", "c2", "n_words", "bands", "k0", "k1", "k2"],
            )

    return run


def _equal_bits(a: str, b: str) -> Column:
    return F.lit(SKETCH_BITS) - sum(F.bit_count(F.col(f"{a}.k{i}").bitwiseXOR(F.col(f"{b}.k{i}"))) for i in range(3))


def _verify(banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, set[str]] = OrderedDict()

        def grams(node: int, text: str) -> set[str]:
            if node not in kept:
                kept[node] = grams_of(words_of(text), banding.n)
                if len(kept) > 32:
                    kept.popitem(last=False)
            return kept[node]

        for part in slices(batches, 64):
            out = []
            for a, b, x, y in zip(*[c.to_pylist() for c in part.columns]):
                ga, gb = grams(a, x), grams_of(words_of(y), banding.n)
                both = len(ga & gb)
                out.append(both / (len(ga) + len(gb) - both))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.float64())], ["a", "b", "jaccard"])

    return run


def _grams(banding: Banding):
    """(rid, gram): 64-bit hashes of the distinct grams of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            rids, hashes = [], []
            for rid, text in zip(*[c.to_pylist() for c in part.columns]):
                grams = grams_of(words_of(text), banding.n)
                rids += [rid] * len(grams)
                hashes += [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little", signed=True) for g in grams]
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(hashes, pa.int64())], ["rid", "gram"])

    return run


def intersections(grams: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of distinct hashes, in blocks of columns."""
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    values, column, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    # A hash that one set alone has is in no intersection.
    place = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(grams), len(grams)))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(column, (start, start + columns)))
        marks = np.zeros((len(grams), min(columns, int(column[-1]) + 1 - start)), dtype=np.float32)
        marks[owner[part], column[part] - start] = 1
        total += marks @ marks.T
    return total


def _count_links(banding: Banding):
    """(rid, n): links of each text to the texts of the other tile, or of its own."""

    def counted(group: tuple, rids: list[int], tiles: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
        both, sizes, tile = intersections(grams), np.array([len(g) for g in grams]), np.array(tiles)
        linked = both / (sizes[:, None] + sizes[None, :] - both) >= banding.threshold
        np.fill_diagonal(linked, False)
        if group[1] != group[2]:
            linked &= tile[:, None] != tile[None, :]
        return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(linked.sum(axis=1), pa.int64())], ["rid", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(banding)
        last, rids, tiles, grams = None, [], [], []
        for part in slices(batches, 64):
            for component, p, q, tile, rid, text in zip(*[c.to_pylist() for c in part.columns]):
                if (component, p, q) != last:
                    if len(rids) > 1:
                        yield counted(last, rids, tiles, grams)
                    last, rids, tiles, grams = (component, p, q), [], [], []
                rids.append(rid)
                tiles.append(tile)
                grams.append(np.unique(signer.hashed(words_of(text))))
        if len(rids) > 1:
            yield counted(last, rids, tiles, grams)

    return run


def link_counts(texts: DataFrame, found: DataFrame, banding: Banding, tile_rows: int = 256, tile_chars: int = 2_000_000) -> DataFrame:
    """(rid, n_links): how many texts of its component each text is linked to.

    texts: (rid, _text), found: (node, component). Tiles hold about
    ``tile_rows`` texts or ``tile_chars`` characters; each text is sent once for
    every tile of its component, so a group of g texts makes g * g / tile_rows
    rows and never a row per pair.
    """
    placed = texts.join(found.withColumnRenamed("node", "rid"), "rid")
    sizes = found.join(texts.select(F.col("rid").alias("node"), F.length("_text").alias("chars")), "node")
    sizes = sizes.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / tile_rows), F.ceil(F.sum("chars") / tile_chars), F.lit(1)).cast("long").alias("tiles"))
    dealt = placed.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64("rid"), "tiles"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
    dealt = dealt.select("component", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "rid", "_text")
    dealt = dealt.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")
    counts = dealt.mapInArrow(_count_links(banding), "rid long, n long")
    return counts.groupBy("rid").agg(F.sum("n").alias("n_links"))


def similar_classes(df: DataFrame, id_col: str, text_col: str, banding: Banding = Banding()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, texts).

    members: (_id, _th, rid, node), one row per row of ``df``; ``node`` is the
    row number of the class's representative, the row with the largest id.
    links: (a, b, jaccard), verified pairs of class nodes, a < b, enough to connect
    what belongs together.
    texts: (rid, _text) of the nodes that share a bucket with another.
    """
    signed = keyed(df, id_col, text_col).mapInArrow(
        _signatures(banding),
        "_id long, _th long, c1 long, c2 long, n_words long, bands array<long>, k0 long, k1 long, k2 long",
    )
    signed = materialize(signed.withColumn("rid", F.monotonically_increasing_id()), "signatures")
    tops = signed.where("n_words > 0").groupBy("c1", "c2").agg(F.max(F.expr("struct(_id is not null as has, coalesce(_id, 0L) as id, rid)")).alias("top"))
    tops = tops.select("c1", "c2", F.col("top.rid").alias("node"))
    # A text without words has no grams: it is alone.
    members = signed.where("n_words > 0").select("_id", "_th", "rid", "c1", "c2").join(tops, ["c1", "c2"]).select("_id", "_th", "rid", "node")
    members = materialize(members.union(signed.where("n_words = 0").select("_id", "_th", "rid", F.col("rid").alias("node"))), "members")
    nodes = materialize(signed.where("n_words > 0").join(tops.select(F.col("node").alias("rid")), "rid", "left_semi"), "nodes")

    rows = nodes.select("rid", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(rows.join(shared, "key"), "bucket-rows")
    # The class that meets most others in all its buckets is the most central:
    # the text that a family of edited copies comes from is in every bucket of it.
    met = buckets.groupBy("rid").agg(F.sum("n").alias("met"))
    leads = buckets.join(met, "rid").groupBy("key").agg(F.max(F.struct("met", "rid")).getField("rid").alias("lead"))
    buckets = materialize(buckets.select("key", "rid").join(leads, "key"), "buckets")
    sketches = nodes.select("rid", "k0", "k1", "k2")
    # Texts of classes that share a bucket with another, each fetched once.
    wanted = nodes.join(buckets.select("rid").distinct(), "rid", "left_semi").select("rid", F.col("_id").alias("_wid"), F.col("_th").alias("_wth"))
    texts = keyed(df, id_col, text_col).join(wanted, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_th") == F.col("_wth")))
    texts = materialize(texts.select("rid", "_text").dropDuplicates(["rid"]), "candidate-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        x, y = texts.select(F.col("rid").alias("a"), F.col("_text").alias("x")), texts.select(F.col("rid").alias("b"), F.col("_text").alias("y"))
        full = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
        found = full.mapInArrow(_verify(banding), "a long, b long, jaccard double")
        return materialize(found.where(F.col("jaccard") >= banding.threshold), "links")

    def near(pairs: DataFrame) -> DataFrame:
        s, t = sketches.alias("s"), sketches.alias("t")
        met = pairs.alias("p").join(s, F.col("p.a") == F.col("s.rid")).join(t, F.col("p.b") == F.col("t.rid"))
        return met.where(_equal_bits("s", "t") >= banding.sketch_floor).select("p.a", "p.b")

    tried = buckets.where("rid != lead").select(F.least("lead", "rid").alias("a"), F.greatest("lead", "rid").alias("b")).distinct()
    first = near(tried)
    links = verified(first)
    found = connected_components(links, "a", "b").withColumnRenamed("node", "rid")
    placed = buckets.select("key", "rid").join(found, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("m")).where("m > 1")
    open_rows = placed.join(mixed.select("key", "main"), "key")
    # Grams that only one of these texts has; equal hashes could only hide some.
    asked = texts.join(open_rows.select("rid").distinct(), "rid", "left_semi")
    grams = materialize(asked.mapInArrow(_grams(banding), "rid long, gram long"), "candidate-grams")
    alone = grams.groupBy("gram").agg(F.min("rid").alias("rid"), F.count("*").alias("n")).where("n = 1").groupBy("rid").agg(F.count("*").alias("u"))
    sizes = grams.groupBy("rid").agg(F.count("*").alias("n")).join(alone, "rid", "left")
    sizes = sizes.select("rid", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("common"))
    keys = open_rows.groupBy("rid").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    open_rows = materialize(open_rows.join(sketches, "rid").join(sizes, "rid").join(keys, "rid"), "open-buckets")
    s, t = open_rows.where("component != main").alias("s"), open_rows.alias("t")
    most = F.least("s.common", "t.common")
    again = s.join(
        t,
        (F.col("s.key") == F.col("t.key")) & (F.col("s.component") != F.col("t.component"))
        & ((F.col("t.component") == F.col("t.main")) | (F.col("s.rid") < F.col("t.rid")))
        & (most >= F.lit(banding.threshold) * (F.col("s.n") + F.col("t.n") - most) - 1e-9)
        & (_equal_bits("s", "t") >= banding.sketch_floor)
        # The first of the open buckets that two texts share gives the pair. They
        # are of different components, so one of them is outside the main one.
        & (F.array_min(F.array_intersect("s.keys", "t.keys")) == F.col("s.key")),
    )
    again = again.select(F.least("s.rid", "t.rid").alias("a"), F.greatest("s.rid", "t.rid").alias("b")).distinct()
    # Pairs of the first step that failed are in different components, too.
    links = links.union(verified(again.join(tried, ["a", "b"], "left_anti")))
    return members, links, texts


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", banding: Banding = Banding(), count_links: bool = False) -> DataFrame:
    """(_id, _th, rid, class_id, class_size, kept), as in ``near_duplicates``; ``n_links`` on demand."""
    members, links, texts = similar_classes(df, id_col, text_col, banding)
    found = connected_components(links, "a", "b")
    rows = members.join(found.select(F.col("node").alias("_n"), "component"), F.col("node") == F.col("_n"), "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    counted = []
    if count_links:
        degree = link_counts(texts, found, banding).select(F.col("rid").alias("_d"), "n_links")
        rows = rows.join(degree, F.col("node") == F.col("_d"), "left")
        counted = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")]
    tops = rows.groupBy("component").agg(F.max(F.expr("struct(_id is not null as has, coalesce(_id, 0L) as id, rid)")).alias("top"), F.count("*").alias("class_size"))
    return rows.join(tops, "component").select(
        "_id", "_th", "rid", F.when(F.col("top.has"), F.col("top.id")).alias("class_id"), "class_size",
        *counted, (F.col("rid") == F.col("top.rid")).alias("kept"),
    )


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", banding: Banding = Banding()) -> DataFrame:
    """(_id, _th, rid, class_id, class_size, n_links, kept), one row per row of ``df``.

    Two texts are linked if the Jaccard similarity of their sets of n-word runs
    (lower-cased ``\\w+`` words) is at least the threshold; texts with equal word
    sequences are copies. ``class_id`` is the largest id of all texts that links
    connect, ``n_links`` the number of different texts that this text is linked
    to, ``kept`` marks one row of each class, the one with the largest id. Copies
    share the links of their text. A text without words, null included, is alone.
    A null id comes before all others; rows that repeat an id are separate rows. An
    empty table gives an empty one; other columns are not read. A very long text is
    signed and verified whole.
    """
    return near_groups(df, id_col, text_col, banding, count_links=True)
