"""Saved tokenizers: a table of tokens, one of merges, and a manifest that commits them.

The manifest is written last. It holds the roles of the special tokens, the sizes
of both tables and a digest of the rows the tokenizer was trained on, so a reader
sees a whole tokenizer or none, and a changed training table is noticed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.bpe import BpeTokenizer
from corpusloom.session import collect_bounded

# Unicode plus merges: far above any vocabulary in use.
MAX_TOKENS = 5_000_000
MANIFEST = "unknown string, pad string, end string, specials array<string>, n_tokens long, n_merges long, trained_on string, tables string"


def save_tokenizer(spark: SparkSession, tokenizer: BpeTokenizer, folder: str, trained_on: str = "") -> None:
    """Write both tables, then the manifest. A saved tokenizer is replaced as a whole."""
    tables = f"{folder}/{uuid.uuid4().hex}"
    tokenizer.vocab_table(spark).write.parquet(f"{tables}/vocab")
    tokenizer.merge_table(spark).write.parquet(f"{tables}/merges")
    row = (
        tokenizer.unknown, tokenizer.pad, tokenizer.end, list(tokenizer.specials),
        len(tokenizer.tokens), len(tokenizer.merges), trained_on, tables,
    )
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> Row | None:
    """The manifest of a saved tokenizer, none if no save was completed."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _committed(spark: SparkSession, folder: str) -> Row:
    manifest = read_manifest(spark, folder)
    if manifest is None:
        raise ValueError(f"no complete tokenizer in {folder}")
    return manifest


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(vocab, merges) of a saved tokenizer."""
    tables = _committed(spark, folder)["tables"]
    return spark.read.parquet(f"{tables}/vocab"), spark.read.parquet(f"{tables}/merges")


def load_tokenizer(spark: SparkSession, folder: str) -> BpeTokenizer:
    """Read a tokenizer back, roles included; it must define a padding or an end token."""
    manifest = _committed(spark, folder)
    vocab, merges = read_tables(spark, folder)
    tokens = tuple(row["token"] for row in collect_bounded(vocab.orderBy("id"), MAX_TOKENS, "vocabulary"))
    codes = {token: i for i, token in enumerate(tokens)}
    steps = collect_bounded(merges.orderBy("rank"), MAX_TOKENS, "merges")
    if (len(tokens), len(steps)) != (manifest["n_tokens"], manifest["n_merges"]):
        raise ValueError(f"the tables in {folder} do not match their manifest")
    tokenizer = BpeTokenizer(
        tokens,
        tuple((codes[m["left"]], codes[m["right"]], codes[m["merged"]]) for m in steps),
        unknown=manifest["unknown"],
        pad=manifest["pad"],
        end=manifest["end"],
        specials=tuple(manifest["specials"]),
    )
    tokenizer.pad_id  # raises if neither token is defined
    return tokenizer


def table_digest(df: DataFrame) -> str:
    """A digest of all rows that does not depend on their order: sums of two row hashes."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.xxhash64(F.lit(seed), *df.columns).cast("decimal(38,0)")).alias(f"s{seed}") for seed in (0, 1)],
    ).first()
    return hashlib.sha256(f"{sorted(df.columns)}:{row['n']}:{row['s0']}:{row['s1']}".encode()).hexdigest()


def stored_tokenizer(spark: SparkSession, folder: str, source: DataFrame, train: Callable[[DataFrame], BpeTokenizer], settings: str = "") -> BpeTokenizer:
    """The tokenizer of a table: read back if it was saved for the same rows, else trained and saved.

    ``settings`` names what else the training depends on.
    """
    digest = table_digest(source)
    at = f"{folder}/{hashlib.sha256(f'{settings}:{digest}'.encode()).hexdigest()[:32]}"
    manifest = read_manifest(spark, at)
    if manifest is None or manifest["trained_on"] != digest:
        save_tokenizer(spark, train(source), at, digest)
    return load_tokenizer(spark, at)
