"""Session settings and the few helpers that need the session."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Only settings the semantics or skew handling depend on. Sizing (shuffle partitions, memory,
# broadcast threshold, split size) belongs to the cluster and is left alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("powerflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def config_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """Small driver-side rows as a DataFrame whose size the optimizer knows.

    Going through Arrow gives a local relation, so Catalyst broadcasts it on its measured size and
    not on a hint.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    struct = T.StructType.fromDDL(schema)
    columns = [{name: row.get(name) for name in struct.fieldNames()} for row in rows]
    table = pa.Table.from_pylist(columns, schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, schema=struct)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a session running on one machine may fall back to a local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/powerflow/{purpose}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return os.path.join(tempfile.mkdtemp(prefix="powerflow-"), purpose)


@contextmanager
def shared_table(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame as a table in the shared folder for the time of a block, computed once.

    The table's files are removed at the end of the block, also after an error.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, computed once.

    For small results that several later passes need. The table survives a lost executor, the
    passes that made it are not repeated, and Catalyst plans with its real size: it is broadcast
    below the session's threshold and shuffled above it.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
