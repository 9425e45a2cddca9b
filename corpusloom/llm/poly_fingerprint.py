"""Exact duplicates by composable polynomial fingerprints, verified chunk by chunk.

A text is normalised (A-Z to a-z, nothing else), cut into byte chunks, and each
chunk is hashed as a polynomial modulo two primes. Hashes of neighbouring chunks
combine by a shift with the length of what follows,
``H(xy) = H(x) * B**len(y) + H(y)``, so chunks may be hashed anywhere and in any
order. Texts with equal (length, hash, hash) are compared chunk by chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import keyed, possible, slices
from corpusloom.session import materialize


@dataclass(frozen=True)
class Rolling:
    """Two polynomials. Chunks of at most 2**20 bytes keep sums below 2**63."""

    moduli: tuple[int, int] = (2147483647, 2147483629)
    bases: tuple[int, int] = (1000003, 16777619)
    chunk_bytes: int = 1 << 16

    def chunk(self, data: bytes) -> tuple[int, int]:
        values = np.frombuffer(data, dtype=np.uint8).astype(np.int64) + 1
        return tuple(int(np.dot(values, p[-len(values) :])) % m if len(values) else 0 for p, m in zip(_powers(self), self.moduli))  # type: ignore[return-value]

    def combine(self, left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
        """Hashes of the joined text from those of its parts."""
        return tuple((x * pow(b, right_len, m) + y) % m for x, y, b, m in zip(left, right, self.bases, self.moduli))  # type: ignore[return-value]

    def whole(self, data: bytes) -> tuple[int, int]:
        total = (0, 0)
        for start in range(0, len(data), self.chunk_bytes):
            part = data[start : start + self.chunk_bytes]
            total = self.combine(total, self.chunk(part), len(part))
        return total


@lru_cache(maxsize=4)
def _powers(rolling: Rolling) -> list[np.ndarray]:
    """base**(n-1) .. base**0 for each modulus."""
    out = []
    for base, modulus in zip(rolling.bases, rolling.moduli):
        powers = np.empty(rolling.chunk_bytes, dtype=np.int64)
        power = 1
        for i in range(rolling.chunk_bytes - 1, -1, -1):
            powers[i] = power
            power = power * base % modulus
        out.append(powers)
    return out


def _whole_hashes(rolling: Rolling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data = [text.encode().lower() for text in part.column(2).to_pylist()]
            hashes = [rolling.whole(x) for x in data]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array([len(x) for x in data], pa.int64()),
                    pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
                ],
                ["_id", "_th", "n_bytes", "h1", "h2", "text_sha256"],
            )

    return run


def _sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1):
        digest = [hashlib.sha256(text.encode().lower()).hexdigest() for text in part.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(digest)], ["_id", "_th", "text_sha256"])


def _chunk_terms(rolling: Rolling):
    """Each chunk's share of its text's hash: its own hash, shifted by the bytes after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 16):
            chunks, after = part.column(2).to_pylist(), part.column(3).to_pylist()
            terms = [rolling.combine(rolling.chunk(c.lower()), (0, 0), n) for c, n in zip(chunks, after)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(c) for c in chunks], pa.int64()),
                 pa.array([t[0] for t in terms], pa.int64()), pa.array([t[1] for t in terms], pa.int64())],
                ["_id", "_th", "len", "t1", "t2"],
            )

    return run


def _chunks(size: int) -> Column:
    """Array of (no, bytes) of the binary column ``_bytes``; one empty chunk for an empty text."""
    last = F.greatest(F.lit(0), (F.octet_length("_bytes") - 1)) / size
    return F.transform(
        F.sequence(F.lit(0), F.floor(last).cast("int")),
        lambda i: F.struct(i.alias("no"), F.substring(F.col("_bytes"), i * size + 1, F.lit(size)).alias("data")),
    )


def fingerprints(df: DataFrame, id_col: str, text_col: str, rolling: Rolling, huge_bytes: int) -> DataFrame:
    """(_id, _th, n_bytes, h1, h2, text_sha256), one row per row of ``df``.

    Texts of ``huge_bytes`` and more are dealt out as chunk rows, hashed in
    parallel and summed; the result is the same as for one pass over the text.
    """
    rows = keyed(df, id_col, text_col)
    huge = F.octet_length("_text") >= huge_bytes
    schema = "_id long, _th long, n_bytes long, h1 long, h2 long, text_sha256 string"
    usual = rows.where(~huge).mapInArrow(_whole_hashes(rolling), schema)
    large = rows.where(huge)
    parts = (
        large.select("_id", "_th", F.col("_text").cast("binary").alias("_bytes"))
        .distinct()
        .select("_id", "_th", F.octet_length("_bytes").alias("_n"), F.explode(_chunks(rolling.chunk_bytes)).alias("c"))
        .select("_id", "_th", "c.data", F.greatest(F.lit(0), F.col("_n") - (F.col("c.no") + 1) * rolling.chunk_bytes).cast("long").alias("after"), "c.no")
        .repartition("_id", "_th", "no")
        .mapInArrow(_chunk_terms(rolling), "_id long, _th long, len long, t1 long, t2 long")
        .groupBy("_id", "_th")
        .agg(F.sum("len").alias("n_bytes"), F.pmod(F.sum("t1"), F.lit(rolling.moduli[0])).alias("h1"), F.pmod(F.sum("t2"), F.lit(rolling.moduli[1])).alias("h2"))
    )
    sha = large.mapInArrow(_sha, "_id long, _th long, text_sha256 string").alias("s")
    p = parts.alias("p")
    joined = sha.join(p, F.col("s._id").eqNullSafe(F.col("p._id")) & (F.col("s._th") == F.col("p._th")))
    return usual.union(joined.select("s._id", "s._th", "n_bytes", "h1", "h2", "text_sha256"))


def _equal_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        same = [a.lower() == b.lower() for a, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(same, pa.bool_())], ["rid", "same"])


def _unequal(texts: DataFrame, members: DataFrame, rolling: Rolling, salt_rows: int) -> DataFrame:
    """rid of the members whose bytes differ from those of their representative.

    members: (rid, _id, _th, rep, rep_id, rep_th, n) with n members per
    representative. The representative's chunks are repeated once per
    ``salt_rows`` members, so a large group is spread over many tasks and its
    representative is copied far less often than there are members.
    """
    salts = F.ceil(F.col("n") / salt_rows).cast("long")
    # Only texts of members and representatives are cut into chunks and shuffled.
    held = members.select("_th").union(members.select("rep_th")).distinct()
    chunked = possible(texts, "_th", held).select("_id", "_th", F.col("_text").cast("binary").alias("_bytes")).select(
        "_id", "_th", F.explode(_chunks(rolling.chunk_bytes)).alias("c")
    )

    def with_chunks(keys: DataFrame) -> DataFrame:
        k, c = keys.alias("k"), chunked.alias("c")
        met = k.join(c, F.col("k._id").eqNullSafe(F.col("c._id")) & (F.col("k._th") == F.col("c._th")))
        return met.select("k.*", F.col("c.c.no").alias("no"), F.col("c.c.data").alias("data"))

    reps = members.select("rep", F.col("rep_id").alias("_id"), F.col("rep_th").alias("_th"), "n").distinct()
    wanted = members.select("rid", "_id", "_th", "rep", F.pmod(F.xxhash64("rid"), salts).alias("salt")).union(
        reps.select(F.lit(None).cast("long"), "_id", "_th", "rep", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    )
    rows = with_chunks(wanted)
    left = rows.where("rid is not null").select("rid", "rep", "salt", "no", "data")
    right = rows.where("rid is null").select("rep", "salt", "no", F.col("data").alias("rep_data")).dropDuplicates(["rep", "salt", "no"])
    compared = left.join(right, ["rep", "salt", "no"], "left").select("rid", "data", F.coalesce("rep_data", F.lit(b"")).alias("rep_data"))
    return compared.mapInArrow(_equal_bytes, "rid long, same boolean").where("not same").select("rid").distinct()


def exact_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rolling: Rolling = Rolling(),
    huge_bytes: int = 8 << 20,
    salt_rows: int = 64,
) -> DataFrame:
    """(_id, _th, keep_id, group_size, kept, text_sha256), one row per row of ``df``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the
    row with the largest id stays; a null id comes before all others, and of
    rows that repeat an id one stays. Null text counts as empty; empty texts are
    equal to each other. An empty table gives no rows. Other columns are not
    read. Fingerprints of different texts that meet are told apart by the
    comparison: texts unlike their representative form a group of their own.
    """
    prints = fingerprints(df, id_col, text_col, rolling, huge_bytes)
    prints = materialize(prints.withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    key = ["n_bytes", "h1", "h2"]
    # Null ids first; the row number settles repeated ids.
    order = "struct(_id is not null as has, coalesce(_id, 0L) as id, rid)"
    several = prints.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    open_rows = prints.join(several, key).select("rid", "_id", "_th", *key)
    texts = keyed(df, id_col, text_col)
    level, settled = 0, None
    while True:
        # Member by member against the largest row of the group.
        tops = open_rows.groupBy(*key).agg(F.max(F.expr("struct(_id is not null as has, coalesce(_id, 0L) as id, rid, _th)")).alias("top"), F.count("*").alias("n"))
        members = open_rows.join(tops, key).select(
            "rid", "_id", "_th", *key, F.col("top.rid").alias("rep"),
            F.when(F.col("top.has"), F.col("top.id")).alias("rep_id"), F.col("top._th").alias("rep_th"), "n",
        )
        members = materialize(members, "equal-fingerprints")
        compare = members.where("rid != rep and not (_id <=> rep_id and _th = rep_th)")
        wrong = materialize(_unequal(texts, compare, rolling, salt_rows), "unequal")
        apart = not wrong.isEmpty()
        right = members.join(wrong, "rid", "left_anti") if apart else members
        found = right.select("rid", F.lit(level).alias("level"))
        settled = found if settled is None else settled.union(found)
        if not apart:
            break
        open_rows = members.join(wrong, "rid", "left_semi").select("rid", "_id", "_th", *key)
        level += 1
    if level:
        rows = prints.join(settled.where("level > 0"), "rid", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    else:
        rows = prints.withColumn("level", F.lit(0))
    groups = rows.groupBy(*key, "level").agg(F.max(F.expr(order)).alias("top"), F.count("*").alias("group_size"))
    return rows.join(groups, [*key, "level"]).select(
        "_id", "_th", F.when(F.col("top.has"), F.col("top.id")).alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256",
    )
