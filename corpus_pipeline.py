"""Documents to token ids: drop toxic ones, copies and near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. All but the last return the columns of ``documents``. ``run`` writes every
stage to the shared folder and reads it again, so a lost executor costs at most
the stage in hand.

Every stage takes tables with nulls in any column, empty and very long texts, and
further columns of any name, which stay. A null text counts as empty, a null id as an
id of its own that comes before all others. Rows that repeat an id and a text share
a decision; of such rows the stages that drop copies keep one, by a hash of the
row. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import merge_automaton, minhash_join, pareto_mix, poly_fingerprint, toxic_crf
from corpusloom.llm.common import keep_rows, packed, table, unpacked
from corpusloom.llm.queries import TOXIC_AT, query, vocabulary_path
from corpusloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below the limit; the model learns from ``labels``."""
    model = toxic_crf.train(docs, table(spark, sf_dir, "labels"))
    bad = toxic_crf.score(docs, model).where(F.col("score") >= TOXIC_AT).select(F.col("_id").alias("_kid"), F.col("_th").alias("_kth")).distinct()
    rows = packed(docs, "doc_id", "text")
    kept = rows.join(bad, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left_anti")
    return unpacked(kept, docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest id."""
    found = poly_fingerprint.exact_duplicates(docs)
    return keep_rows(docs, "doc_id", "text", found.where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that similar texts connect, that with the largest id."""
    found = minhash_join.near_groups(docs)
    return keep_rows(docs, "doc_id", "text", found.where("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return pareto_mix.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of every row of the mix."""
    encoded = merge_automaton.ByteTokenizer(spark, vocabulary_path()).encode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode_texts),
]

#: A trained model and MinHash candidates have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
