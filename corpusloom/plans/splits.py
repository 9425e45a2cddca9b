"""Queries on splits, batches and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators.splits import (
    ordered_split,
    random_split,
    sample_k,
    seq_batches,
    shuffled_batches,
)
from corpusloom.plans.common import documents, sql_digest
from corpusloom.plans.registry import query

SEED = 42
SQL_HASH = sql_digest(f"'{SEED}'", "doc_id")


@query(
    "doc_split",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <=
  (SELECT floor(0.9 * count(*)) FROM documents) THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def doc_split(spark, root):
    return ordered_split(documents(spark, root, "doc_id"), ["doc_id"])


@query(
    "random_split",
    f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {SQL_HASH}, doc_id) <=
  (SELECT ceil(0.1 * count(*)) FROM documents) THEN 'test' ELSE 'train' END AS split FROM documents""",
)
def split_members(spark, root):
    return random_split(documents(spark, root, "doc_id"), ["doc_id"], 0.1, SEED)


@query(
    "random_split_counts",
    """SELECT 'test' AS split, ceil(0.1 * count(*))::BIGINT AS n FROM documents
UNION ALL SELECT 'train', count(*) - ceil(0.1 * count(*))::BIGINT FROM documents""",
)
def split_counts(spark, root):
    marked = random_split(documents(spark, root, "doc_id"), ["doc_id"], 0.1, SEED)
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "seq_batches",
    """SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS batch_id,
  (row_number() OVER (ORDER BY doc_id) - 1) % 1000 AS row_in_batch FROM documents""",
)
def sequential(spark, root):
    rows = seq_batches(documents(spark, root, "doc_id"), ["doc_id"], 1000)
    return rows.select("doc_id", "batch_id", F.col("row_in_batch").cast("long").alias("row_in_batch"))


@query(
    "shuffled_batches",
    " UNION ALL ".join(
        f"""SELECT {epoch} AS epoch, doc_id,
  (row_number() OVER (ORDER BY {sql_digest(f"'{SEED}:{epoch}'", "doc_id")}, doc_id) - 1) // 32 AS batch_id,
  (row_number() OVER (ORDER BY {sql_digest(f"'{SEED}:{epoch}'", "doc_id")}, doc_id) - 1) % 32 AS row_in_batch
FROM documents"""
        for epoch in (0, 1)
    ),
)
def shuffled(spark, root):
    keys = documents(spark, root, "doc_id")
    parts = [
        shuffled_batches(keys, ["doc_id"], 32, SEED, epoch).select(
            F.lit(epoch).alias("epoch"),
            "doc_id",
            "batch_id",
            F.col("row_in_batch").cast("long").alias("row_in_batch"),
        )
        for epoch in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


@query("sample_k", f"SELECT doc_id, text FROM documents ORDER BY {SQL_HASH}, doc_id LIMIT 20")
def sampled(spark, root):
    return sample_k(documents(spark, root), ["doc_id"], 20, SEED)
