"""ING-10. Stage newly landed documents with a file stream, both grains from one parse.

The stream remembers the files it has read, so each run stages only new ones and then stops. Every
batch is parsed once, into a table of its documents; events and causes are both written from that.
All three are kept by batch, and a batch that runs again after a failure replaces what it had
written, so the grains cannot drift apart. A body that has been staged before, re-delivered under
another name or time, is left out. A day that is fetched again with other content goes through the
batch replacement in ``stopwise.plans.refresh`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.operators import ingest, staging
from stopwise.settings import Settings
from stopwise.storage import exists, file_system

BATCH = "batch"
DOCUMENTS, EVENTS, CAUSES = "documents", "events", "causes"


def read_new_documents(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int = 1000,
) -> DataFrame:
    """A streaming scan of landed documents; ``schema`` includes ``date``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if file_format == "json":
        reader = reader.option("multiLine", True)
    return reader.format(file_format).load(root)


def read_new_bodies(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """A streaming scan of landed files, a row of text per file; ``stage_new_batches`` parses it."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("date", T.DateType())])
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("wholetext", True).format("text").load(root).select("*", "_metadata")


def stage_new_batches(bodies: DataFrame, out: str, checkpoint: str, settings: Settings = Settings()) -> None:
    """Stage the documents, events and causes of all files not seen before, then stop.

    Bodies that are malformed, empty or no array, and those whose checksum an earlier batch or
    another file of this one has, stage nothing.
    """
    _run(bodies, checkpoint, lambda batch, number: _stage(batch, number, out, settings))


def _stage(bodies: DataFrame, number: int, out: str, settings: Settings) -> None:
    """Write one batch; running it again writes the same."""
    spark = bodies.sparkSession
    scanned = ingest.parsed_bodies(bodies).filter("has_doc AND is_array AND NOT is_corrupt")
    if exists(spark, f"{out}/{DOCUMENTS}"):
        before = spark.read.parquet(f"{out}/{DOCUMENTS}").filter(F.col(BATCH) < number)
        scanned = scanned.join(before.select("date", "body_hash").distinct(), ["date", "body_hash"], "left_anti")
    _replace_batch(scanned, number, f"{out}/{DOCUMENTS}", "date")
    own = f"{out}/{DOCUMENTS}/{BATCH}={number}"
    if not exists(spark, own):
        for grain in (EVENTS, CAUSES):
            _drop_batch(spark, number, f"{out}/{grain}")
        return
    documents = spark.read.schema(scanned.schema).parquet(own)
    # Of files with the same body, the first by name.
    first = documents.groupBy("date", "body_hash").agg(F.min("file").alias("file"))
    documents = documents.join(first, ["date", "body_hash", "file"], "left_semi")
    _replace_batch(staging.timetable_events(documents, settings), number, f"{out}/{EVENTS}", "source_ingest_date")
    _replace_batch(staging.delay_causes(documents), number, f"{out}/{CAUSES}", "source_ingest_date")


def _replace_batch(rows: DataFrame, number: int, path: str, by: str) -> None:
    """Write a batch's own folder anew; other batches stay untouched."""
    rows.write.mode("overwrite").partitionBy(by).parquet(f"{path}/{BATCH}={number}")


def _drop_batch(spark: SparkSession, number: int, path: str) -> None:
    files, at = file_system(spark, f"{path}/{BATCH}={number}")
    files.delete(at, True)


def staged(spark: SparkSession, out: str, grain: str) -> DataFrame:
    """What all batches have staged at one grain."""
    return spark.read.parquet(f"{out}/{grain}").drop(BATCH)


def stage_new_days(
    documents: DataFrame, out: str, checkpoint: str, settings: Settings = Settings()
) -> None:
    """Append the staged events of all documents not seen before, then stop."""
    _append(staging.timetable_events(documents, settings), out, checkpoint)


def stage_new_causes(documents: DataFrame, out: str, checkpoint: str) -> None:
    """The same at the grain of delay causes."""
    _append(staging.delay_causes(documents), out, checkpoint)


def _run(source: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        source.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _append(staged: DataFrame, out: str, checkpoint: str) -> None:
    """Flattening, keys and flags are row-wise, so the stream keeps no state. The file sink commits
    each batch once, also after a lost executor."""
    query = (
        staged.writeStream.format("parquet")
        .partitionBy("source_ingest_date")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
