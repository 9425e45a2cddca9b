"""Near duplicates by SuperMinHash signatures, banding, exact verification, union-find.

Every shingle of a set draws one random permutation of the registers and enters
register p[j] with the value j + r, r in [0, 1). Ranks of one shingle are thus
spread over the registers, which lowers the variance of the estimate. Shingles
are walked step by step j for a whole batch of texts at once; a text stops as
soon as all its registers hold a value below j + 1, since later steps only make
larger ones. Signatures are cut into bands; texts with equal words are one class
and are signed once.

A bucket of g classes is never expanded into g * g pairs:

1. Every class is verified against the class of its bucket that meets most others;
   links join classes into components.
2. Classes that share a bucket with another component may have links left. Sets
   with too many shingles that no other of them holds cannot, and are set aside.
   The others are joined by exact prefix filters on what they remove from, and add
   to, the set of the class that step 1 compared them with: two classes of which
   one is not linked to that class need a number of these differences in common.
   Edits of one text seldom agree in most of their edits, so families of
   thousands of edited copies, or of texts with one common passage, leave few pairs.

Every pair of classes that shares a bucket is thus verified, in one component, or
ruled out by an exact bound. Links are verified on full shingle sets. Postings of
a frequent difference are dealt into tiles, so no task holds all pairs of one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, slices
from corpusloom.llm.components import connected_components
from corpusloom.session import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEPT_WORDS = 250_000
BATCH_WORDS = 200_000
TILE_ROWS = 2048
SKETCH_LONGS = 3


@dataclass(frozen=True)
class Near:
    """Shingles of n words; a link needs 100 * intersection >= percent * union.

    ``rows`` registers a band, and as many bands as a pair at the threshold needs
    to share one with probability ``recall``.
    """

    n: int = 3
    percent: int = 85
    recall: float = 0.99999
    rows: int = 6
    seed: int = 13

    @property
    def bands(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def sketch_floor(self) -> int:
        """Equal sketch bits that a pair at the threshold has but for 6 deviations."""
        p = (1 + self.percent / 100) / 2
        return math.floor(self.registers * p - 6 * math.sqrt(self.registers * p * (1 - p)))

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)



def words_of(text: str) -> list[str]:
    # Bytes have no case but that of A-Z.
    return WORD.findall(text.encode().lower().decode())


def shingles_of(words: list[str], n: int) -> set[tuple[str, ...]]:
    """Distinct runs of n words; a shorter text is one run of all its words."""
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each bit of the result depends on all bits of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(self) < KEPT_WORDS and len(word) <= 64:
            self[word] = value
        return value


def shingle_hashes(texts: list[list[str]], n: int, hashes: dict) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, by text; 64-bit hashes.

    A text of fewer than n words is padded by zeros, which no word hashes to but
    by chance, so that it differs from the runs of longer texts.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    padded = np.where(sizes > 0, np.maximum(sizes, n), 0)
    ends = np.cumsum(padded)
    begin = ends - padded
    w = np.zeros(int(padded.sum()) + n, dtype=np.uint64)
    place = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    w[place] = np.fromiter((hashes[x] for t in texts for x in t), dtype=np.uint64, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), padded)
    starts = np.flatnonzero(np.arange(len(owner)) + n <= ends[owner]) if len(owner) else np.zeros(0, np.int64)
    owner = owner[starts]
    x = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            x = _mixed(x * np.uint64(0x9E3779B97F4A7C15) + w[starts + i] + np.uint64(i + 1))
    order = np.lexsort((x, owner))
    owner, x = owner[order], x[order]
    first = np.ones(len(x), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (x[1:] != x[:-1])
    return owner[first], x[first]


def signatures(owner: np.ndarray, hashes: np.ndarray, texts: int, registers: int, seed: int) -> np.ndarray:
    """SuperMinHash of each text as 40-bit numbers: step j above 32 bits of r.

    Row t holds the registers of text t; a text without shingles keeps the largest
    number everywhere. Shingles are those of ``shingle_hashes``.
    """
    if registers > 255:
        raise ValueError("at most 255 registers")
    table = np.full(texts * registers, np.iinfo(np.uint64).max, dtype=np.uint64)
    base = owner.astype(np.int64) * registers
    seeds = _mixed(hashes ^ np.uint64(seed))
    rows: np.ndarray | None = None
    for j in range(registers):
        draw = _mixed(seeds + np.uint64((j * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        # Step j of the shuffle: position j takes what stands at a position from j on.
        k = j + (((draw >> np.uint64(40)) * np.uint64(registers - j)) >> np.uint64(24)).astype(np.int64)
        value = (np.uint64(j) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
        if j == 0:
            register, first_k = k, k
        else:
            if rows is None:
                # The shuffles of the shingles still under way, from their first step.
                rows = np.tile(np.arange(registers, dtype=np.uint8), (len(seeds), 1))
                index = np.arange(len(seeds))
                rows[index, first_k] = 0
                rows[index, 0] = first_k
            index = np.arange(len(seeds))
            register = rows[index, k].astype(np.int64)
            rows[index, k] = rows[:, j]
        np.minimum.at(table, base + register, value)
        # A text is done when every register holds a value of this step or an earlier one.
        done = (table.reshape(texts, registers) < np.uint64((j + 1) << 32)).all(axis=1)
        live = ~done[owner]
        if not live.any():
            break
        if not live.all():
            owner, base, seeds = owner[live], base[live], seeds[live]
            first_k = first_k[live]
            rows = rows[live] if rows is not None else None
    return table.reshape(texts, registers)


def band_keys(table: np.ndarray, near: Near) -> np.ndarray:
    """One 64-bit hash for each band of each text; the band number is part of it."""
    bands = table.reshape(len(table), near.bands, near.rows)
    keys = np.broadcast_to(np.arange(1, near.bands + 1, dtype=np.uint64)[None, :], (len(table), near.bands))
    with np.errstate(over="ignore"):
        for r in range(near.rows):
            keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
    return keys.view(np.int64)


def sketches(table: np.ndarray) -> np.ndarray:
    """One bit of each register; bits of two texts are equal with (1 + similarity) / 2."""
    bits = (_mixed(table) >> np.uint64(63)).astype(np.uint8)
    packed = np.zeros((len(table), SKETCH_LONGS * 8), dtype=np.uint8)
    found = np.packbits(bits, axis=1)
    packed[:, : found.shape[1]] = found
    return packed.view(np.int64)


def _batches(texts: list[list[str]]) -> Iterator[tuple[int, int]]:
    first, words = 0, 0
    for k, text in enumerate(texts):
        if k > first and words + len(text) > BATCH_WORDS:
            yield first, k
            first, words = k, 0
        words += len(text)
    if first < len(texts):
        yield first, len(texts)


def _sign(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for part in slices(batches):
            texts = [words_of(t) for t in part.column(2).to_pylist()]
            for first, last in _batches(texts):
                here = texts[first:last]
                owner, x = shingle_hashes(here, near.n, hashes)
                table = signatures(owner, x, len(here), near.registers, near.seed)
                counts = np.bincount(owner, minlength=len(here))
                digests = [hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest() for w in here]
                classes = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                bits = sketches(table)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(table, near).ravel()), near.bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).slice(first, last - first), part.column(1).slice(first, last - first),
                        pa.array(classes[:, 0]), pa.array(classes[:, 1]), pa.array(counts, pa.int64()), keys,
                        *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(SKETCH_LONGS)],
                    ],
                    ["_id", "_th", "c1", "c2", "n_shingles", "bands", *[f"k{i}" for i in range(SKETCH_LONGS)]],
                )

    return run


def _verify(near: Near):
    """(a, b) of the pairs whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, set] | None = None
        for part in slices(batches, 32):
            keep = []
            for a, x, y in zip(part.column("a").to_pylist(), part.column("x").to_pylist(), part.column("y").to_pylist()):
                if last is None or last[0] != a:
                    last = (a, shingles_of(words_of(x), near.n))
                other = shingles_of(words_of(y), near.n)
                keep.append(near.linked(len(last[1] & other), len(last[1]), len(other)))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(keep)), part.column("b").filter(pa.array(keep))], ["a", "b"])

    return run


def _shingles(near: Near):
    """(rid, s): the distinct shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for part in slices(batches, 32):
            owner, x = shingle_hashes([words_of(t) for t in part.column(1).to_pylist()], near.n, hashes)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(x.view(np.int64))], ["rid", "s"])

    return run


def _equal_bits(near: Near, a: str, b: str) -> Column:
    return F.lit(near.registers) - sum(F.bit_count(F.col(f"{a}.k{i}").bitwiseXOR(F.col(f"{b}.k{i}"))) for i in range(SKETCH_LONGS))


def with_common(open_rows: DataFrame, shingles: DataFrame, near: Near) -> DataFrame:
    """The rows of (rid, component, n_shingles) with enough shingles that others of them hold.

    shingles: (rid, s). A set with c such shingles of n shares at most c with any
    other, whose union with it has at least n.
    """
    held = shingles.groupBy("s").agg(F.count("*").alias("df"), F.min("rid").alias("rid"))
    alone = held.where("df = 1").groupBy("rid").agg(F.count("*").alias("u"))
    common = F.col("n_shingles") - F.coalesce("u", F.lit(0))
    return open_rows.join(alone, "rid", "left").where(common * 100 >= F.col("n_shingles") * near.percent).drop("u")


def _differences(near: Near):
    """(lead, rid, size, removed, added): shingle hashes of one set that the other lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        last: tuple[int, np.ndarray] | None = None
        kind = pa.list_(pa.int64())
        for part in slices(batches, 32):
            sizes, removed, added = [], [], []
            for lead, x, y in zip(part.column("a").to_pylist(), part.column("x").to_pylist(), part.column("y").to_pylist()):
                if last is None or last[0] != lead:
                    last = (lead, shingle_hashes([words_of(x)], near.n, hashes)[1].view(np.int64))
                other = shingle_hashes([words_of(y)], near.n, hashes)[1].view(np.int64)
                sizes.append(len(last[1]))
                removed.append(np.setdiff1d(last[1], other, assume_unique=True))
                added.append(np.setdiff1d(other, last[1], assume_unique=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(added, kind)],
                ["lead", "rid", "size", "removed", "added"],
            )

    return run


def pairs_by_differences(differences: DataFrame, near: Near, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b) of different components with the same lead that can reach the threshold.

    differences: (lead, rid, component, size, removed, added), one row per set and
    lead, size being that of the lead's set. With r removed and
    p added shingles let f = 100 * r + percent * p and
    F = (100 - percent) * size. A set is linked to its lead if f <= F, and two sets
    with x differences in common are linked if
    (100 + percent) * x >= f1 + f2 - F. If one of them, say the first, is not linked to
    the lead, x is thus more than f2 / (100 + percent), and at least (f1 - F) / 100,
    because the second has x differences itself. That is what each row ``needs``.
    """
    whole = 100 + near.percent
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("long"))
    rows = differences.withColumns({"r": F.size("removed").cast("long"), "p": F.size("added").cast("long")})
    rows = rows.withColumns({"f": F.col("r") * 100 + F.col("p") * near.percent, "bound": F.col("size") * (100 - near.percent)})
    apart = F.col("f") > F.col("bound")
    rows = rows.withColumns({"apart": apart, "needs": F.when(apart, F.greatest(F.lit(1), div(F.col("f") - F.col("bound") + 99, 100))).otherwise(div(F.col("f"), whole) + 1)})
    rows = rows.where(F.col("needs") <= F.col("r") + F.col("p"))
    marked = lambda name, out: F.transform(name, lambda s: F.struct(F.lit(out).alias("out"), s.alias("s")))
    every = F.concat(marked("removed", True), marked("added", False))
    cells = rows.select("lead", "rid", F.explode(every).alias("d")).select("lead", "rid", "d.out", "d.s")
    held = cells.groupBy("lead", "out", "s").agg(F.count("*").alias("df"), F.min("rid").alias("rid"))
    alone = held.where("df = 1").groupBy("lead", "rid").agg(F.count("*").alias("u"))
    kept = rows.join(alone, ["lead", "rid"], "left").withColumn("common", F.col("r") + F.col("p") - F.coalesce("u", F.lit(0)))
    kept = materialize(kept.where("common >= needs").drop("u", "p", "r"), "open-sets")
    # No partner has less differences than the one with the least.
    least = kept.groupBy("lead").agg(F.min("f").alias("least"))
    kept = kept.join(least, "lead").where(F.col("common") * whole >= F.col("f") + F.col("least") - F.col("bound"))
    kept = kept.withColumn("looked", F.col("common") - F.col("needs") + 1).drop("least")
    kept = materialize(kept, "open-sets")
    # The rarest differences of each set first; a set keeps its figures beside them.
    figures = ["lead", "rid", "component", "f", "bound", "common", "apart"]
    spelled = kept.select(*figures, "looked", F.explode(every).alias("d")).select(*figures, "looked", "d.out", "d.s")
    ranked = spelled.join(held.where("df > 1").drop("rid"), ["lead", "out", "s"])
    firsts = ranked.groupBy(*figures, "looked").agg(F.array_sort(F.collect_list(F.struct("df", "out", "s"))).alias("all"))
    firsts = firsts.select(*figures, F.explode(F.slice("all", F.lit(1), F.col("looked").cast("int"))).alias("d"))
    postings = materialize(firsts.select(*figures, "d.out", "d.s"), "postings")
    key = ["lead", "out", "s"]
    sizes = postings.groupBy(*key).agg(F.count("*").alias("g"), F.min("component").alias("low"), F.max("component").alias("high"), F.max("apart").alias("any"))
    sizes = sizes.where("low != high and any").select(*key, F.ceil(F.col("g") / tile_rows).cast("long").alias("tiles"))
    dealt = postings.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("rid"), "tiles"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
    dealt = dealt.select(*key, F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "tile", "rid", "component", "f", "bound", "common", "apart")
    x, y = dealt.alias("x"), dealt.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*key, "t1", "t2")]
    met = x.join(
        y,
        same[0] & same[1] & same[2] & same[3] & same[4]
        & (F.col("x.rid") < F.col("y.rid")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.apart") | F.col("y.apart"))
        # Pairs inside a tile belong to the row (t, t) only.
        & ((F.col("x.t1") == F.col("x.t2")) | (F.col("x.tile") != F.col("y.tile")))
        & (F.least("x.common", "y.common") * whole >= F.col("x.f") + F.col("y.f") - F.col("x.bound")),
    )
    return met.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: Near = Near()) -> DataFrame:
    """(_id, _th, rid, n_shingles, component_id, kept), one row per row of ``df``.

    Words are the stretches without ASCII white space, A-Z in lower case. The set
    of a text is its distinct runs of n words, or the whole sequence if it has
    fewer; a text without words (null, empty) has an empty set and is linked with
    nothing. ``component_id`` is the smallest id that links reach from a row, its
    own included; ``kept`` marks one row of each component, that with this id. Null
    ids come after all others; a component of null ids only has a null id. Rows
    that repeat an id or a text are separate rows. An empty table gives an empty
    one. Other columns are not read. Long texts are batches of their own.

    A pair at the threshold that shares no band is missed with probability
    1 - recall; below the threshold nothing is linked.
    """
    schema = "_id long, _th long, c1 long, c2 long, n_shingles long, bands array<long>, " + ", ".join(f"k{i} long" for i in range(SKETCH_LONGS))
    signed = keyed(df, id_col, text_col).mapInArrow(_sign(near), schema)
    signed = materialize(signed.withColumn("rid", F.monotonically_increasing_id()), "superminhash")
    some = signed.where("n_shingles > 0")
    firsts = some.groupBy("c1", "c2").agg(F.min(F.expr("struct(_id is null as none, coalesce(_id, 0L) as id, rid)")).getField("rid").alias("node"))
    firsts = materialize(firsts, "classes")
    nodes = some.join(firsts.select(F.col("node").alias("rid")), "rid", "left_semi")
    sketched = materialize(nodes.select("rid", "_id", "_th", "n_shingles", "k0", "k1", "k2"), "sketches")

    rows = nodes.select("rid", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("g")).where("g > 1")
    buckets = materialize(rows.join(shared, "key"), "buckets")
    met = buckets.groupBy("rid").agg(F.sum("g").alias("met"))
    leads = buckets.join(met, "rid").groupBy("key").agg(F.max(F.struct("met", "rid")).getField("rid").alias("lead"))
    buckets = materialize(buckets.select("key", "rid").join(leads, "key"), "led-buckets")
    # The texts of classes that share a bucket, each fetched once.
    wanted = sketched.join(buckets.select("rid").distinct(), "rid", "left_semi").select("rid", F.col("_id").alias("_wid"), F.col("_th").alias("_wth"))
    texts = keyed(df, id_col, text_col).join(wanted, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_th") == F.col("_wth")))
    texts = materialize(texts.select("rid", "_text").dropDuplicates(["rid"]), "near-texts")

    def with_texts(pairs: DataFrame) -> DataFrame:
        x, y = (texts.select(F.col("rid").alias(r), F.col("_text").alias(t)) for r, t in (("a", "x"), ("b", "y")))
        return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")

    def verified(pairs: DataFrame) -> DataFrame:
        return materialize(with_texts(pairs).mapInArrow(_verify(near), "a long, b long"), "near-links")

    bits = sketched.select("rid", "k0", "k1", "k2")
    s, t = bits.alias("s"), bits.alias("t")
    tried = buckets.where("rid != lead").select(F.least("lead", "rid").alias("a"), F.greatest("lead", "rid").alias("b")).distinct()
    likely = tried.alias("p").join(s, F.col("p.a") == F.col("s.rid")).join(t, F.col("p.b") == F.col("t.rid"))
    links = verified(likely.where(_equal_bits(near, "s", "t") >= near.sketch_floor).select("p.a", "p.b"))

    found = materialize(connected_components(links, "a", "b").withColumnRenamed("node", "rid"), "first-components")
    placed = buckets.select("key", "rid").join(found, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
    open_rows = placed.join(mixed, "key", "left_semi").select("rid", "component").distinct()
    open_rows = materialize(open_rows.join(sketched.select("rid", "n_shingles"), "rid"), "open-rows")
    shingles = texts.join(open_rows.select("rid"), "rid", "left_semi").mapInArrow(_shingles(near), "rid long, s long")
    close = materialize(with_common(open_rows, materialize(shingles, "open-shingles"), near), "close-sets")
    pivots = buckets.join(mixed, "key", "left_semi").where("rid != lead").join(close.select("rid"), "rid", "left_semi").select(F.col("lead").alias("a"), F.col("rid").alias("b")).distinct()
    schema = "lead long, rid long, size long, removed array<long>, added array<long>"
    differences = with_texts(pivots).sortWithinPartitions("a").mapInArrow(_differences(near), schema)
    differences = materialize(differences.join(close.select("rid", "component"), "rid"), "differences")
    again = pairs_by_differences(differences, near)
    links = links.union(verified(again.join(tried, ["a", "b"], "left_anti")))

    found = connected_components(links, "a", "b").select(F.col("node").alias("_n"), "component")
    members = signed.select("_id", "_th", "rid", "n_shingles", "c1", "c2").join(firsts, ["c1", "c2"], "left")
    members = members.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.col("rid")))
    grouped = members.join(found, F.col("node") == F.col("_n"), "left").withColumn("component", F.coalesce("component", "node"))
    tops = grouped.groupBy("component").agg(F.min(F.expr("struct(_id is null as none, coalesce(_id, 0L) as id, rid)")).alias("top"))
    return grouped.join(tops, "component").select(
        "_id", "_th", "rid", "n_shingles", F.when(~F.col("top.none"), F.col("top.id")).alias("component_id"),
        (F.col("rid") == F.col("top.rid")).alias("kept"),
    )
