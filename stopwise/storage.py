"""Where derived tables live: the shared folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, read from ``spark.checkpoint.dir``.

    A session without that setting uses a folder of its warehouse, which is shared as well.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_derived"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path on it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder for derived tables; it is deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    files, at = file_system(spark, path)
    files.mkdirs(at)
    files.deleteOnExit(at)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def gathered(df: DataFrame, column: str) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    For rows that an earlier shuffle has scattered: without it every task would
    write a file per value. Adaptive execution splits a large value over several
    tasks and merges small ones.
    """
    return df.hint("rebalance", column)


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A reader over a table written from ``like``, which may hold no row and so no file."""
    return spark.read.schema(like.schema).parquet(path)


def save(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Write ``df`` as the whole table at ``path`` (or append to it) and return a reader over it."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return stored(df.sparkSession, path, df)


def replace_partitions(
    df: DataFrame, path: str, partition_by: str, values: list[object]
) -> DataFrame:
    """Replace exactly the partitions of ``values`` (ING-6); other partitions stay untouched.

    Partitions that ``df`` has no row for are removed, so nothing of a replaced one is left.
    """
    spark = df.sparkSession
    rows = df.filter(df[partition_by].isin(*values))
    rows.write.mode("overwrite").partitionBy(partition_by).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    after = stored(spark, path, df)
    kept = rows.select(partition_by).distinct().collect()  # at most one row per value
    for value in set(values) - {r[partition_by] for r in kept}:
        files, at = file_system(spark, f"{path}/{partition_by}={value}")
        files.delete(at, True)
    return stored(spark, path, after)
