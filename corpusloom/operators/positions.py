"""Row numbers, running totals, next keys and k-th keys without a one-task window.

A window without a partition key would pull the whole table into one task. Here
the table is cut into sorted key ranges, each range is numbered on its own in one
pass, and starts from the total of the ranges before it. The k-th key is found
from counts of ever smaller key intervals, without sorting anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import collect_bounded, materialize

_RANGE, _LOCAL = "_range", "_local"
HASH_BUCKETS = 65_536
RANGE_ROWS = 1_000_000
FEW_ROWS = 4096


def _in_ranges(df: DataFrame, order_by: list[str]) -> DataFrame:
    """``df`` in sorted key ranges; their number follows from the number of rows."""
    ranges = max(1, -(-df.count() // RANGE_ROWS))
    return df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)


def _running(weight: str | None):
    """Append the range number, the total before each row in its range, and the row's own amount."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            amount = np.ones(batch.num_rows, np.int64) if weight is None else batch.column(weight).fill_null(0).cast("int64").to_numpy()
            after = np.cumsum(amount) + seen
            added = [np.full(len(after), number, np.int64), after - amount, after]
            seen = int(after[-1]) if len(after) else seen
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, added)], [*batch.schema.names, _RANGE, _LOCAL, "_after"])

    return run


def running_total(
    df: DataFrame, order_by: list[str], weight: str | None = None, name: str = "row_index"
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows; without a weight, the row number from 0.

    ``order_by`` must identify a row. Pass only the key and weight columns of a
    wide table and join the result back: this writes and shuffles what it gets,
    once. Rows are numbered inside their sorted range in the same pass; the
    starts of the ranges are one row per range.
    """
    schema = T.StructType([*df.schema.fields])
    for added in (_RANGE, _LOCAL, "_after"):
        schema = schema.add(added, "long")
    ranged = _in_ranges(df, order_by).mapInArrow(_running(weight), schema)
    # The range number depends on the physical layout, so it is written down
    # once; both uses below, and any retry, read the same numbers.
    ranged = materialize(ranged, "ranges")
    before_range = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(_RANGE).agg(F.max("_after").alias("_sum"))
    starts = starts.select(_RANGE, F.coalesce(F.sum("_sum").over(before_range), F.lit(0)).alias("_start"))
    numbered = ranged.join(F.broadcast(starts), _RANGE)
    return numbered.withColumn(name, F.col("_start") + F.col(_LOCAL)).drop(_RANGE, _LOCAL, "_after", "_start")


def _following(names: list[str]):
    """Append the next row of the same range to each row, and the range number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId(), None

        def joined(rows: pa.Table, after: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = [*rows.columns, *after.columns, pa.array(np.full(rows.num_rows, number, np.int64))]
            yield from pa.table(columns, names=[*names, *[f"_next_{n}" for n in names], _RANGE]).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch.select(names)])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            held = rows.slice(rows.num_rows - 1)
            yield from joined(rows.slice(0, rows.num_rows - 1), rows.slice(1))
        if held is not None:
            yield from joined(held, pa.table({n: pa.nulls(1, held.schema.field(n).type) for n in names}))

    return run


def with_next(df: DataFrame, order_by: list[str]) -> DataFrame:
    """(columns, _next_<column> of each): every row with the row after it, null after the last.

    ``order_by`` must identify a row. All columns are shuffled and written, so
    pass keys only. No key, however frequent, is gathered in one task.
    """
    names = df.columns
    schema = T.StructType([*df.schema.fields])
    for field in df.schema.fields:
        schema = schema.add(f"_next_{field.name}", field.dataType)
    ranged = materialize(_in_ranges(df, order_by).mapInArrow(_following(names), schema.add(_RANGE, "long")), "next-rows")
    # The last row of a range is followed by the first of the next range with rows.
    first = F.min(F.struct(*order_by, *[n for n in names if n not in order_by]))
    last = F.max(F.struct(*order_by, *[n for n in names if n not in order_by]))
    ends = ranged.groupBy(_RANGE).agg(first.alias("_first"), last.alias("_last"))
    ends = ends.select(_RANGE, "_last", F.lead("_first").over(Window.orderBy(_RANGE)).alias("_first"))
    here = F.struct(*order_by, *[n for n in names if n not in order_by])
    found = ranged.join(F.broadcast(ends), _RANGE).withColumn("_at_end", here == F.col("_last"))
    return found.select(*names, *[F.when(F.col("_at_end"), F.col(f"_first.{n}")).otherwise(F.col(f"_next_{n}")).alias(f"_next_{n}") for n in names])


def whole_div(column: Column, size: int) -> Column:
    """Integer quotient, exact for every long (``/`` would go through a double)."""
    return F.call_function("div", column, F.lit(size).cast("long"))


def repeatable_hash(seed: int | str, *parts: Column | str) -> Column:
    """32 hex digits that depend only on the seed and the key, in any engine."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def unit_number(digest: Column) -> Column:
    """A number in [0, 1) from a digest: its first 52 bits."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def hash_integer(digest: Column) -> Column:
    """A non-negative integer below 2**60 from a digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Cut:
    """A row of a total order: everything before it is on one side."""

    order: tuple[str, ...]
    values: tuple | None

    def before(self, columns: dict[str, Column] | None = None) -> Column:
        """Row-local test: does a row come before the cut? All rows do if there is none."""
        if self.values is None:
            return F.lit(True)
        columns = columns or {name: F.col(name) for name in self.order}
        test: Column = F.lit(False)
        for name, value in reversed(list(zip(self.order, self.values))):
            column, bound = columns[name], F.lit(value)
            test = (column < bound) | ((column == bound) & test)
        return test


def _counted(keys: DataFrame, bucket: Column) -> list[Row]:
    """Rows of each bucket, by bucket; at most 65,537 buckets, null first."""
    counts = keys.groupBy(bucket.alias("bucket")).count().orderBy(F.col("bucket").asc_nulls_first())
    return collect_bounded(counts, HASH_BUCKETS + 1, "key buckets")


def _narrowed(keys: DataFrame, bucket: Column, rank: int) -> tuple[DataFrame, int, Row] | None:
    """The rows of the bucket that holds the rank, the rank inside it, and the bucket."""
    for row in _counted(keys, bucket):
        if rank < row["count"]:
            return keys.where(bucket.eqNullSafe(F.lit(row["bucket"]))), rank, row
        rank -= row["count"]
    return None


def key_at(df: DataFrame, order_by: list[str], rank: int, digits: int = 0) -> tuple | None:
    """The key with ``rank`` rows before it in key order, none if there are not so many.

    Whole numbers, dates, times and strings. Each step counts the rows of at most 65,536 intervals
    of a key column (whole numbers: equal widths; strings: the next two bytes)
    and goes on in the one that holds the rank, until few rows or one value are
    left, then with the next column. Scans of the keys; no sort, no offset. With
    ``digits`` the first column is a hex digest whose first digits all rows share.
    """
    keys = df.select(*order_by)
    for name in order_by:
        column, kind = F.col(name), keys.schema[name].dataType
        if isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.DateType):
            column = F.unix_date(column)
        hexed = column if digits and name == order_by[0] else F.hex(column)
        prefix = digits if name == order_by[0] else 0
        while True:
            if isinstance(kind, (T.StringType, T.BinaryType)):
                prefix += 4
                bucket = F.substring(hexed, 1, prefix)
            elif isinstance(kind, (T.IntegralType, T.TimestampType, T.DateType)):
                ends = keys.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
                if ends["low"] is None:
                    break  # no row, or only nulls in this column
                width = -(-(ends["high"] - ends["low"] + 1) // HASH_BUCKETS)
                bucket = F.call_function("div", column.cast("decimal(20,0)") - F.lit(ends["low"]).cast("decimal(20,0)"), F.lit(width).cast("decimal(20,0)"))
            else:
                raise TypeError(f"no k-th key of a column of type {kind.simpleString()}")
            found = _narrowed(keys, bucket, rank)
            if found is None:
                return None
            keys, rank, row = found
            if row["count"] <= FEW_ROWS:
                rows = collect_bounded(keys, FEW_ROWS, "rows of one interval")
                rows.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in order_by))
                return tuple(rows[rank])
            if row["bucket"] is None or (len(row["bucket"]) < prefix if prefix else width == 1):
                break  # one value is left
    # Rows that share the whole key.
    row = keys.first()
    return None if row is None else tuple(row)


def hash_cut(df: DataFrame, key: list[str], seed: int | str, rank: int) -> Cut:
    """The row with ``rank`` rows before it, in the order of (hash of key, key).

    Counts of hash prefixes (at most 65,536 groups, pre-aggregated on the map
    side) lead to the row; the table is not sorted.
    """
    hashed = df.select(repeatable_hash(seed, *key).alias("_hash"), *key)
    order = ("_hash", *key)
    prefix = F.substring("_hash", 1, 4)
    found = _narrowed(hashed, prefix, rank)
    return Cut(order, None if found is None else key_at(found[0], list(order), found[1], digits=4))


def key_cut(df: DataFrame, order_by: list[str], rank: int) -> Cut:
    """The row with ``rank`` rows before it in key order."""
    return Cut(tuple(order_by), key_at(df, order_by, rank))


def before_hash_cut(cut: Cut, key: list[str], seed: int | str) -> Column:
    """Row-local membership test for a cut made by ``hash_cut``."""
    columns = {name: F.col(name) for name in key}
    columns["_hash"] = repeatable_hash(seed, *key)
    return cut.before(columns)
