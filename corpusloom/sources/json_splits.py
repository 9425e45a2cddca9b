"""JSON-lines splits: checked read, UTF-8 write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MESSAGE_TYPE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
CHAT_SCHEMA = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE_TYPE))])


def _exists(spark: SparkSession, path: str) -> bool:
    # Goes through the cluster's own file system, so object stores work too.
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Read JSON lines, or one JSON array per file with ``multi_line``.

    Give the schema: inference costs one more pass over the data and orders
    struct fields by name.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def load_splits(
    spark: SparkSession,
    folder: str,
    train_name: str = "train_dataset.json",
    eval_name: str = "test_dataset.json",
    need_eval: bool = True,
    schema: T.StructType | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Train and evaluation frames; the evaluation part is None if not needed."""
    if not _exists(spark, folder):
        raise FileNotFoundError(f"dataset folder does not exist: {folder}")
    wanted = [("training", train_name)] + ([("evaluation", eval_name)] if need_eval else [])
    frames: list[DataFrame] = []
    for kind, name in wanted:
        path = f"{folder.rstrip('/')}/{name}"
        if not _exists(spark, path):
            raise FileNotFoundError(f"{kind} split not found: {path}")
        frames.append(read_json(spark, path, schema))
    return frames[0], frames[1] if need_eval else None


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, non-ASCII text kept as it is, one file per partition."""
    df.write.mode(mode).json(path)
