"""Small helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.storage import ensure_checkpoint_dir, file_system

#: A-Z is lowered by code point, other letters stay.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows whose checksum remainder is this are held out of every training set.
HELD_OUT = 2

#: Rows that go to a Python task at once. Whole texts and shingle sets come in rows: by Spark's 10,000, batches
#: and their copies take hundreds of MB beside an executor's heap.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of its id as text leaves 2 modulo 4 (a null id: not)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == HELD_OUT, F.lit(False))


def same(left: str, right: str, *names: str) -> Column:
    """Join condition: equal in all names, nulls equal to nulls."""
    return reduce(
        Column.__and__, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    )


def kept(df: DataFrame) -> DataFrame:
    """A reliable copy in the shared checkpoint folder; cuts the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing will read again."""
    files, at = file_system(spark, path)
    files.delete(at, True)


def in_small_batches(spark: SparkSession) -> None:
    """From here on, the session hands at most BATCH_ROWS rows to Python at once; fewer stay fewer."""
    now = int(spark.conf.get(_BATCH))
    if now <= 0 or now > BATCH_ROWS:  # none is no limit
        spark.conf.set(_BATCH, str(BATCH_ROWS))


@contextmanager
def restored_batches(spark: SparkSession) -> Iterator[None]:
    """The session's batches are as before at the end."""
    before = spark.conf.get(_BATCH)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their query ends, not when the driver collects garbage.

    For work whose steps are each stored once and read from there.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def smallest(df: DataFrame, n: int, total: int, *by: str) -> DataFrame:
    """The n rows with the smallest hashes of ``by``, of ``total``: a repeatable sample.

    Rows far from the smallest hashes are dropped first, so that tasks hand few rows on. With
    fewer than n rows about, all are taken.
    """
    hashed = F.xxhash64(F.lit(1), *by)
    point = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    near = df.filter(point < min(1.0, 4.0 * n / max(total, 1)))
    return near.orderBy(point, hashed).limit(n)


def frame(rows: list[tuple], names: list[str], whole: tuple[str, ...] = ()) -> pd.DataFrame:
    """Rows as a frame whose ``whole`` columns are nullable longs; plain pandas would make floats of
    whole numbers beside a null and round them."""
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pd.DataFrame(
        {n: pd.array(c, "Int64") if n in whole else pd.Series(c, dtype=object) for n, c in zip(names, columns)}
    )
