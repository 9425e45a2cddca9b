"""Queries on vector sequences and score vectors."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from corpusloom.functions.arrays import argmax, cross_entropy, softmax
from corpusloom.operators.metrics import loss_by_split, loss_history
from corpusloom.operators.positions import running_total, whole_div
from corpusloom.operators.vectors import causal_mean, last_vector, similar_history, sliding_history
from corpusloom.plans.common import BLOCK, VECTOR_DIM, joined_doubles, vectors
from corpusloom.plans.registry import query

SQL_VECTORS = f"""v AS (SELECT vec_id, vec_id // {BLOCK} AS seq, vec_id % {BLOCK} AS pos, label,
  list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"""
SQL_EXPS = """m AS (SELECT *, list_max(e) AS top FROM v),
x AS (SELECT *, list_transform(e, lambda s: exp(s - top)) AS exps FROM m)"""
SQL_LOSS = "(top + ln(list_sum(exps)) - e[label + 1])"


def sql_joined(values: str, digits: int = 5) -> str:
    return f"array_to_string(list_transform({values}, lambda z: round(z * {10**digits})::BIGINT), ' ')"


@query(
    "causal_mean",
    f"""WITH {SQL_VECTORS}, d AS (SELECT seq, pos, unnest(e) AS val, generate_subscripts(e, 1) AS dim FROM v),
r AS (SELECT seq, pos, dim, avg(val) OVER (PARTITION BY seq, dim ORDER BY pos) AS mean FROM d)
SELECT seq, pos, string_agg((round(mean * 100000)::BIGINT)::VARCHAR, ' ' ORDER BY dim) AS mean FROM r GROUP BY seq, pos""",
)
def running_mean(spark, root):
    rows = causal_mean(vectors(spark, root), "seq", "pos", "embedding", VECTOR_DIM)
    return rows.select("seq", "pos", joined_doubles(F.col("mean")).alias("mean"))


@query(
    "similar_history",
    f"""WITH {SQL_VECTORS},
s AS (SELECT i.seq, i.pos, j.e AS val,
    list_sum(list_transform(i.e, lambda a, k: a * j.e[k])) * {VECTOR_DIM}::DOUBLE ** -0.5 AS score
  FROM v i JOIN v j ON i.seq = j.seq AND j.pos <= i.pos),
w AS (SELECT *, exp(score - max(score) OVER p) AS num FROM s WINDOW p AS (PARTITION BY seq, pos)),
n AS (SELECT *, num / sum(num) OVER (PARTITION BY seq, pos) AS weight FROM w),
d AS (SELECT seq, pos, weight, unnest(val) AS x, generate_subscripts(val, 1) AS dim FROM n),
o AS (SELECT seq, pos, dim, sum(weight * x) AS output FROM d GROUP BY seq, pos, dim)
SELECT seq, pos, string_agg((round(output * 100000)::BIGINT)::VARCHAR, ' ' ORDER BY dim) AS output FROM o GROUP BY seq, pos""",
)
def history(spark, root):
    rows = similar_history(
        vectors(spark, root), "seq", "pos", "embedding", "embedding", "embedding", VECTOR_DIM, BLOCK
    )
    return rows.select("seq", "pos", joined_doubles(F.col("output")).alias("output"))


LONG = 64


@query(
    "sliding_history",
    f"""WITH v AS (SELECT vec_id // {LONG} AS seq, vec_id % {LONG} AS pos, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
s AS (SELECT i.seq, i.pos, j.e AS val,
    list_sum(list_transform(i.e, lambda a, k: a * j.e[k])) * {VECTOR_DIM}::DOUBLE ** -0.5 AS score
  FROM v i JOIN v j ON i.seq = j.seq AND j.pos <= i.pos AND j.pos > i.pos - {BLOCK}),
w AS (SELECT *, exp(score - max(score) OVER p) AS num FROM s WINDOW p AS (PARTITION BY seq, pos)),
n AS (SELECT *, num / sum(num) OVER (PARTITION BY seq, pos) AS weight FROM w),
d AS (SELECT seq, pos, weight, unnest(val) AS x, generate_subscripts(val, 1) AS dim FROM n),
o AS (SELECT seq, pos, dim, sum(weight * x) AS output FROM d GROUP BY seq, pos, dim)
SELECT seq, pos, string_agg((round(output * 100000)::BIGINT)::VARCHAR, ' ' ORDER BY dim) AS output FROM o GROUP BY seq, pos""",
)
def sliding(spark, root):
    """Sequences longer than the context: each position sees its last rows only."""
    rows = vectors(spark, root).select("embedding", whole_div(F.col("vec_id"), LONG).alias("seq"), F.pmod("vec_id", F.lit(LONG)).alias("pos"))
    found = sliding_history(rows, "seq", "pos", "embedding", "embedding", "embedding", VECTOR_DIM, BLOCK)
    return found.select("seq", "pos", joined_doubles(F.col("output")).alias("output"))


@query(
    "softmax_rows",
    f"""WITH {SQL_VECTORS}, {SQL_EXPS} SELECT vec_id,
  {sql_joined("list_transform(exps, lambda q: q / list_sum(exps))", 6)} AS weights FROM x""",
)
def softmax_rows(spark, root):
    return vectors(spark, root).select("vec_id", joined_doubles(softmax(F.col("embedding")), 6).alias("weights"))


@query(
    "last_vector",
    f"""WITH {SQL_VECTORS} SELECT seq, {sql_joined("arg_max(e, pos)")} AS last_vector FROM v GROUP BY seq""",
)
def last(spark, root):
    rows = last_vector(vectors(spark, root), "seq", "pos", "embedding")
    return rows.select("seq", joined_doubles(F.transform("last", lambda x: x.cast("double"))).alias("last_vector"))


@query(
    "argmax_pred",
    f"WITH {SQL_VECTORS} SELECT vec_id, list_position(e, list_max(e)) - 1 AS predicted FROM v",
)
def predicted(spark, root):
    return vectors(spark, root).select("vec_id", argmax(F.col("embedding")).alias("predicted"))


@query(
    "cross_entropy",
    f"WITH {SQL_VECTORS}, {SQL_EXPS} SELECT count(*) AS n, round(avg({SQL_LOSS}), 6) AS loss FROM x",
)
def mean_loss(spark, root):
    losses = vectors(spark, root).select(cross_entropy(F.col("embedding"), F.col("label")).alias("loss"))
    return losses.agg(F.count("loss").alias("n"), F.round(F.avg("loss"), 6).alias("loss"))


SQL_BATCH_LOSS = f"""l AS (SELECT vec_id, {SQL_LOSS} AS loss,
    row_number() OVER (ORDER BY vec_id) - 1 AS i FROM x),
parts AS (SELECT *, CASE WHEN i < (SELECT floor(0.9 * count(*)) FROM l) THEN 'train' ELSE 'test' END AS split FROM l),
b AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY vec_id) - 1) // 32 AS batch_id FROM parts)"""


def batch_losses(spark, root):
    """(vec_id, loss, split, batch_id): rows are numbered once, batches begin anew in the second part."""
    rows = vectors(spark, root)
    losses = rows.select("vec_id", cross_entropy(F.col("embedding"), F.col("label")).alias("loss"))
    index, n_train = F.col("row_index"), math.floor(0.9 * rows.count())
    return running_total(losses, ["vec_id"]).select(
        "vec_id",
        "loss",
        F.when(index < n_train, "train").otherwise("test").alias("split"),
        whole_div(F.when(index < n_train, index).otherwise(index - n_train), 32).alias("batch_id"),
    )


@query(
    "loss_by_split",
    f"""WITH {SQL_VECTORS}, {SQL_EXPS}, {SQL_BATCH_LOSS},
p AS (SELECT split, batch_id, avg(loss) AS m FROM b GROUP BY split, batch_id)
SELECT split, count(*) AS n_batches, round(avg(m), 6) AS loss FROM p GROUP BY split""",
)
def split_losses(spark, root):
    rows = loss_by_split(batch_losses(spark, root), "split", "batch_id", "loss")
    return rows.withColumn("loss", F.round("loss", 6))


@query(
    "loss_history",
    f"""WITH {SQL_VECTORS}, {SQL_EXPS}, {SQL_BATCH_LOSS}
SELECT split, batch_id AS step, round(avg(loss), 6) AS loss FROM b WHERE batch_id % 10 = 0 GROUP BY split, batch_id""",
)
def reported(spark, root):
    per_step = (
        batch_losses(spark, root)
        .groupBy("split", F.col("batch_id").alias("step"))
        .agg(F.round(F.avg("loss"), 6).alias("loss"))
    )
    return loss_history(per_step, "step", 10)
