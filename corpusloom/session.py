"""Session settings and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Setting that names the number of partitions for ``spread``; unset on a cluster.
PARTITIONS = "spark.corpusloom.partitions"


def local_session(cores: str = "*", app: str = "corpusloom", **extra: str) -> SparkSession:
    """Session for tests and the bench; on a cluster use the session you are given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Small test tables: let a stage keep all cores although its data is small.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A small test file has one row group, which one task would read and work on.
        PARTITIONS: cores if cores.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    It must be reachable from every executor. Only a local master, where driver
    and executors are one process, gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives the loss of any executor, freezes values that depend
    on the physical partitioning, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in as many partitions as the session's setting says, or as it is without one.

    For narrow input of work inside Python or long expressions, where files have
    fewer row groups than there are cores. The caller decides, not the data.
    """
    wanted = df.sparkSession.conf.get(PARTITIONS, None)
    return df.repartition(int(wanted), *keys) if wanted else df


def collect_bounded(df: DataFrame, bound: int, what: str) -> list:
    """Rows of a table whose size has a known bound; an error if it is larger."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows")
    return rows
