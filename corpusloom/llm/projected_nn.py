"""Approximate nearest neighbours by a kd-tree over few stable projections.

Vectors are scaled to length 1, so the largest cosine is the smallest distance,
and projected on a few Gaussian directions. Given their true distance d, the
squared projected distance of two vectors over d*d follows a chi-square law with
as many degrees of freedom as there are directions. A query walks the leaves of
the tree in the order of their projected distance and verifies, on the original
components, the vectors whose projected distance a neighbour closer than the
current k-th best could have; it stops when no leaf holds such a distance.

The upper levels of the tree, fitted on a bounded sample, deal all vectors into
blocks, and each block has a tree of its own. A query first searches the block it
falls into, then only those blocks that its k-th best so far leaves possible.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import quoted
from corpusloom.session import collect_bounded, materialize


@dataclass(frozen=True)
class Search:
    k: int = 5
    #: Directions (even), share of true neighbours that may be missed, vectors of
    #: a leaf and of a block, queries that a block handles at a time, rows that the
    #: upper levels are fitted on, blocks at most.
    directions: int = 16
    miss: float = 0.07
    leaf: int = 64
    block: int = 8192
    queries: int = 2048
    sample: int = 20_000
    most_blocks: int = 200_000
    seed: int = 3


def chi_square_tail(x: float, degrees: int) -> float:
    """P(chi-square > x) for an even number of degrees."""
    term = total = math.exp(-x / 2)
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return total


def chi_square_bound(miss: float, degrees: int) -> float:
    """x with P(chi-square > x) = miss."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_tail(mid, degrees) > miss else (low, mid)
    return high


class Tree:
    """A kd-tree with leaves as runs of an index array and their bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        cuts: list[tuple[int, int]] = []
        todo = [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                if b > a:
                    cuts.append((a, b))
                continue
            part = points[self.order[a:b]]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        self.cuts = sorted(cuts)
        self.low = np.array([points[self.order[a:b]].min(0) for a, b in self.cuts]).reshape(len(self.cuts), points.shape[1])
        self.high = np.array([points[self.order[a:b]].max(0) for a, b in self.cuts]).reshape(len(self.cuts), points.shape[1])

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of a point to each leaf's box."""
        gap = np.maximum(self.low - q, 0) + np.maximum(q - self.high, 0)
        return (gap * gap).sum(1)



class Planes:
    """The upper levels: planes that deal points into blocks, the same on every executor."""

    def __init__(self, points: np.ndarray, blocks: int):
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, cut, node below, node above
        self.blocks = 0

        def grow(part: np.ndarray, wanted: int) -> int:
            """A node's number; blocks are numbered from -1 down."""
            spread = part.max(0) - part.min(0) if len(part) else np.zeros(1)
            if wanted <= 1 or spread.max() <= 0:
                self.blocks += 1
                return -self.blocks
            axis = int(spread.argmax())
            cut = float(np.median(part[:, axis]))
            low = part[:, axis] < cut
            if not low.any():
                cut = float(np.nextafter(cut, np.inf))
                low = part[:, axis] < cut
            node = len(self.nodes)
            self.nodes.append((axis, cut, 0, 0))
            below = grow(part[low], wanted // 2)
            above = grow(part[~low], wanted - wanted // 2)
            self.nodes[node] = (axis, cut, below, above)
            return node

        self.root = grow(points, blocks)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The block of each point, from 0."""
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                axis, cut, below, above = self.nodes[node]
                low = points[rows, axis] < cut
                todo += [(below, rows[low]), (above, rows[~low])]
        return out


def directions_for(dimension: int, how: Search) -> np.ndarray:
    return np.random.default_rng(how.seed).standard_normal((dimension, how.directions))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each, which rounds nothing, and their lengths.

    The largest component becomes about 1, so no square over- or underflows.
    """
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    vectors = np.ascontiguousarray(np.ldexp(vectors, -power[:, None]))
    return vectors, np.sqrt((vectors * vectors).sum(axis=1))


def search_block(
    rids: np.ndarray, ids: np.ndarray, vectors: np.ndarray, q_rids: np.ndarray, q_vectors: np.ndarray, worst: np.ndarray, how: Search
) -> tuple[list[tuple[int, int, float]], int]:
    """(query row, vec_id, cosine) of the best ``how.k`` found for each query, and how many vectors were verified.

    worst: squared distance that neighbours of each query must not exceed. The
    sums of a cosine run over the components of one row, so equal vectors
    get equal scores wherever they lie, and ties go to the smaller id.
    """
    vectors, norms = scaled(vectors)
    directions = directions_for(vectors.shape[1], how)
    points = (vectors / norms[:, None]) @ directions
    tree = Tree(points, how.leaf)
    rids, ids, vectors, norms, points = (np.ascontiguousarray(x[tree.order]) for x in (rids, ids, vectors, norms, points))
    bound = chi_square_bound(how.miss, how.directions)
    q_vectors, q_norms = scaled(q_vectors)
    out, verified = [], 0
    for rid, q, q_norm, least in zip(q_rids, q_vectors, q_norms, worst):
        p = (q / q_norm) @ directions
        reach = tree.leaf_distances(p)
        found_ids, found = np.zeros(0, dtype=np.int64), np.zeros(0)
        for leaf in np.argsort(reach, kind="stable"):
            if reach[leaf] > bound * least:
                break
            a, b = tree.cuts[leaf]
            near = np.flatnonzero((((points[a:b] - p) ** 2).sum(axis=1) <= bound * least) & (rids[a:b] != rid)) + a
            if not len(near):
                continue
            verified += len(near)
            here = (vectors[near] * q).sum(axis=1) / (norms[near] * q_norm)
            found_ids, found = np.concatenate([found_ids, ids[near]]), np.concatenate([found, here])
            best = np.lexsort((found_ids, -found))[: how.k]
            found_ids, found = found_ids[best], found[best]
            if len(found) == how.k:
                least = min(least, max(0.0, 2 - 2 * float(found[-1])) + 1e-12)  # squared distance of unit vectors
        out += [(int(rid), int(i), float(s)) for i, s in zip(found_ids, found)]
    return out, verified


def _rows_by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the vectors of a batch."""
    sizes = batch.column("d").to_numpy()
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, batch.column("v").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d)


def _points(matrix: np.ndarray, how: Search) -> np.ndarray:
    vectors, norms = scaled(matrix)
    return (vectors / norms[:, None]) @ directions_for(matrix.shape[1], how)


def _placed(planes: Planes, common: int, how: Search):
    """Append the block and the projections; vectors of uncommon length form one block each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.zeros(batch.num_rows, dtype=np.int64)
            p = np.zeros((batch.num_rows, how.directions))
            for d, rows, matrix in _rows_by_length(batch):
                p[rows] = _points(matrix, how)
                if d == common:
                    block[rows] = planes.place(p[rows])
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * how.directions)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))], [*batch.schema.names, "block", "p"])

    return run


def _reached(boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], how: Search):
    """(rid, other): the other blocks whose box a query's k-th best leaves possible."""
    bound = chi_square_bound(how.miss, how.directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, others = [], []
            columns = (batch.column(c).to_pylist() for c in ("rid", "d", "block", "p", "worst"))
            for rid, d, home, p, worst in zip(*columns):
                numbers, low, high = boxes[d]
                gap = np.maximum(low - p, 0) + np.maximum(np.array(p) - high, 0)
                hit = numbers[((gap * gap).sum(1) <= bound * worst) & (numbers != home)]
                rids += [rid] * len(hit)
                others += hit.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(others, pa.int64())], ["rid", "other"])

    return run


def nearest(df: DataFrame, is_query: str, id_col: str = "vec_id", vector_col: str = "embedding", how: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``how.k`` nearest found of each query.

    ``is_query`` is a condition on ``_id``. Candidates are all rows but the
    query's own. Score is the cosine in double precision of the original
    vectors; ties go to the smaller id. Rows with a null id, or with a null,
    empty, zero or non-finite vector, or of another length than the query's,
    take no part. Rows that repeat an id are separate queries and candidates, so a
    query may find its own id. Vectors of any magnitude count. An empty table
    gives no rows; other columns are not read.
    """
    v = quoted(vector_col).cast("array<double>")
    rows = df.where(quoted(id_col).isNotNull()).select(quoted(id_col).cast("long").alias("_id"), v.alias("v"))
    usable = rows.where(
        (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    usable = usable.withColumns({"d": F.size("v").cast("long"), "query": F.coalesce(F.expr(is_query), F.lit(False)), "rid": F.monotonically_increasing_id()})
    usable = materialize(usable, "vectors")
    lengths = {r["d"]: r["n"] for r in usable.groupBy("d").agg(F.count("*").alias("n")).collect()}
    common = max(lengths, key=lambda d: (lengths[d], d), default=0)
    n = lengths.get(common, 0)
    # The upper levels come from a sample of bounded size; every row is indexed.
    draw = F.pmod(F.xxhash64("rid", F.lit(how.seed)), F.lit(1 << 30)) < int(min(1.0, how.sample / max(1, n)) * (1 << 30))
    sample = usable.where((F.col("d") == common) & draw).select("rid", "v").limit(2 * how.sample).collect()
    matrix = np.array([r["v"] for r in sorted(sample, key=lambda r: r["rid"])]).reshape(len(sample), common)
    planes = Planes(_points(matrix, how) if len(matrix) else np.zeros((0, how.directions)), min(how.most_blocks, -(-n // how.block)))
    schema = "_id long, v array<double>, d long, query boolean, rid long, block long, p array<double>"
    placed = materialize(usable.select("_id", "v", "d", "query", "rid").mapInArrow(_placed(planes, common, how), schema), "placed")

    # Blocks with their boxes; large ones are dealt into parts, for vectors and for queries.
    ends = [f(F.col("p")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(how.directions)]
    stats = placed.groupBy("d", "block").agg(F.count("*").alias("n"), *ends)
    known = collect_bounded(stats, how.most_blocks + len(lengths), "blocks")
    boxes = {
        d: tuple(
            np.array([[r[f"{name}{i}"] for i in range(how.directions)] if name else r["block"] for r in known if r["d"] == d])
            for name in ("", "low", "high")
        )
        for d in lengths
    }
    parts = stats.select(F.col("d").alias("_d"), F.col("block").alias("_block"), F.ceil(F.col("n") / how.block).cast("long").alias("parts"))

    def search(asked: DataFrame) -> DataFrame:
        """(rid, vec_id, score) of the queries (rid, d, block, v, worst) in their blocks."""
        many = asked.groupBy("d", "block").agg(F.ceil(F.count("*") / how.queries).cast("long").alias("turns"))
        asked = asked.join(many, ["d", "block"]).join(parts, (F.col("d") == F.col("_d")) & (F.col("block") == F.col("_block")))
        asked = asked.select(
            "d", "block", F.lit(0).cast("long").alias("_id"), "rid", "v", "worst", F.pmod(F.xxhash64("rid"), "turns").alias("turn"),
            F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(True).alias("query"),
        )
        stored = placed.join(many, ["d", "block"]).join(parts, (F.col("d") == F.col("_d")) & (F.col("block") == F.col("_block")))
        stored = stored.select(
            "d", "block", "_id", "rid", "v", F.lit(0.0).alias("worst"), F.explode(F.expr("sequence(0L, turns - 1)")).alias("turn"),
            F.pmod(F.xxhash64("rid", F.lit(1)), "parts").alias("part"), F.lit(False).alias("query"),
        )

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            q = batch["query"].to_numpy()
            found: list[tuple[int, int, float]] = []
            if q.any() and not q.all():
                x, rids = np.stack(batch["v"].to_numpy()), batch["rid"].to_numpy()
                found, _ = search_block(rids[~q], batch["_id"].to_numpy()[~q], x[~q], rids[q], x[q], batch["worst"].to_numpy()[q], how)
            return pd.DataFrame(found, columns=["rid", "vec_id", "score"])

        return stored.union(asked).groupBy("d", "block", "turn", "part").applyInPandas(run, "rid long, vec_id long, score double")

    best = Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= how.k)

    queries = placed.where("query")
    home = materialize(top(search(queries.select("rid", "d", "block", "v", F.lit(4.0).alias("worst")))), "home")
    # Squared distances of unit vectors are at most 4.
    kth = home.where(F.col("rank") == how.k).select("rid", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("worst"))
    far = queries.select("rid", "d", "block", "p").join(kth, "rid", "left").withColumn("worst", F.coalesce("worst", F.lit(4.0)) + 1e-12)
    reached = materialize(far.mapInArrow(_reached(boxes, how), "rid long, other long").join(far.select("rid", "worst"), "rid"), "reached")
    again = queries.select("rid", "d", "v").join(reached, "rid").select("rid", "d", F.col("other").alias("block"), "v", "worst")
    found = home.select("rid", "vec_id", "score").union(search(again))
    names = queries.select("rid", F.col("_id").alias("query_id"))
    return top(found).join(names, "rid").select("query_id", "rank", "vec_id", "score")
