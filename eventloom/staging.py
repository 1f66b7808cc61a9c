"""Tables written between stages.

A staged table cuts the lineage, survives the loss of executors and gives the
optimizer real file sizes, so that it broadcasts a side only when the side is
small. It lies in the shared folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="eventloom-")
    context.setCheckpointDir(path)
    return path


def staged_dir(spark: SparkSession) -> str:
    """The folder of the session's staged tables."""
    return f"{shared_dir(spark)}/eventloom/{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete all staged tables of the session; nothing that was read from them can be used any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(staged_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{staged_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, buckets: int, by: str, dealt: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder in ``buckets`` by the hash of ``by`` and read it back.

    A join or an aggregation by ``by`` then needs no exchange of this side. If the rows are
    ``dealt`` out by that column already, they are written as they lie. The
    table is known to the session's catalog under a name of its own.
    """
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = (df if dealt else df.repartition(buckets, by)).write.bucketBy(buckets, by).sortBy(by).format("parquet")
    writer.option("path", f"{staged_dir(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for what runs within; ``conf`` uses ``__`` for dots."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
