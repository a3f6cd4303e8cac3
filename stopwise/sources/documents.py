"""Train documents: scans, SQL views over them, and the landing writer (SRC-*, SNK-3).

A landed day is a folder ``date=YYYY-MM-DD`` of gzipped JSON arrays. Spark reads
each such file in one task, since neither gzip nor a JSON array can be split, so
the landing writer bounds the number of documents per file; a day is as many
files as it needs. A landing of our own is better written as lines, in bins of
a good file size that Spark splits as it likes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise import schemas
from stopwise.functions import running_total

# Fixed value: how a service date is spelled in a landed path.
PATH_DATE = r"date=([0-9-]+)"

#: Decoded bytes of a landed file of lines, about.
LANDED_BYTES = 128 << 20


def read_documents(
    spark: SparkSession, root: str, schema: T.StructType = schemas.TRAINS
) -> DataFrame:
    """SRC-1, SRC-5. Scan landed JSON arrays; ``date`` comes from the folder name.

    A filter on ``date`` prunes folders. Pass a narrower ``schema`` to skip
    parsing nested fields that are not needed.
    """
    return spark.read.schema(schema).option("multiLine", True).json(root)


def read_metadata(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-2..4. Scan a metadata document under its declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def path_date(path: Column) -> Column:
    """STG-4. Service date spelled in a file path; NULL where there is none."""
    return F.regexp_extract(path, PATH_DATE, 1).try_cast("date")


def ingest_date(documents: DataFrame) -> Column:
    """The discovered ``date`` partition, else the date in the file path."""
    if "date" in documents.columns:
        return F.col("date").cast("date")
    return path_date(F.col("_metadata.file_path"))


def with_ingest_date(documents: DataFrame) -> DataFrame:
    """SRC-7. Documents as landed plus ``ingest_date``."""
    return documents.withColumn("ingest_date", ingest_date(documents)).drop("date")


def raw_event_rows(documents: DataFrame) -> DataFrame:
    """SRC-8. One row per timetable row, 16 columns, causes still nested."""
    doc = with_ingest_date(documents)
    return doc.select(
        "ingest_date",
        "departureDate",
        "trainNumber",
        "trainType",
        "trainCategory",
        "commuterLineID",
        F.col("cancelled").alias("train_cancelled"),
        F.explode("timeTableRows").alias("r"),
    ).select(
        "ingest_date",
        "departureDate",
        "trainNumber",
        "trainType",
        "trainCategory",
        "commuterLineID",
        "train_cancelled",
        "r.stationShortCode",
        F.col("r.type").alias("event_type"),
        "r.scheduledTime",
        "r.actualTime",
        "r.differenceInMinutes",
        "r.trainStopping",
        "r.commercialStop",
        F.col("r.cancelled").alias("row_cancelled"),
        "r.causes",
    )


def register_views(
    documents: DataFrame, trains: str = "trains", events: str = "events"
) -> None:
    """SRC-7, SRC-8. Temp views over documents and their rows, for ad-hoc SQL (SRC-9)."""
    with_ingest_date(documents).createOrReplaceTempView(trains)
    raw_event_rows(documents).createOrReplaceTempView(events)


def first_trains(documents: DataFrame, n: int = 3) -> DataFrame:
    """SRC-10. The first trains by date and number, without the nested column."""
    doc = with_ingest_date(documents).drop("timeTableRows")
    return doc.orderBy(*_order(doc)).limit(n)


def first_full_record(documents: DataFrame) -> DataFrame:
    """SRC-11. One whole document with its nested rows."""
    doc = with_ingest_date(documents)
    return doc.orderBy(*_order(doc)).limit(1)


def _order(doc: DataFrame) -> list[Column]:
    """By date and train, documents of both alike by their remaining columns; unknown dates last."""
    first = ["ingest_date", "trainNumber"]
    return [F.col(c).asc_nulls_last() for c in first + [c for c in doc.columns if c not in first]]


def write_landing(arrays: DataFrame, root: str) -> None:
    """SNK-3. Write (``date``, ``body``) rows, one gzipped file per row.

    A date that is written again replaces its earlier folder.
    """
    (
        arrays.select("date", "body")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 1)
        .partitionBy("date")
        .text(root)
    )


def in_bins(documents: DataFrame, target_bytes: int = LANDED_BYTES) -> DataFrame:
    """(``date``, ``doc``, ``bytes``, ``start``, ``overall``, ``bin``): JSON text in bins of some ``target_bytes``.

    A date's documents are laid end to end, in the order of their checksums, and cut every
    ``target_bytes``, so a bin holds at most that and one document more. Prefix sums over ranges find
    the cuts; no date or bin is collected. Bins are numbered within their date; ``start`` is where a
    document begins in its date, ``overall`` where it begins in all dates laid end to end.
    """
    fields = [c for c in documents.columns if c != "date"]
    text = documents.select("date", F.to_json(F.struct(*fields)).alias("doc"))
    rows = text.withColumn("bytes", F.octet_length("doc") + 1).withColumn("mark", F.xxhash64("doc"))
    placed = running_total(rows, "start", "bytes", ["date", "mark", "doc"], ["date"], "overall")
    return placed.drop("mark").withColumn("bin", F.floor(F.col("start") / target_bytes))


def write_landing_lines(documents: DataFrame, root: str, target_bytes: int = LANDED_BYTES) -> None:
    """SNK-3. Land documents as lines of JSON, a file per bin; readers may split any file.

    A date that is written again replaces its earlier folder. A task writes a stretch of bins, one
    after the other. The writer begins a new file after so many records, so bins are made of equally
    many: a bin is cut into strips no narrower than the longest document, and a strip is one record
    of several lines. Then no strip is empty, save at the end of a date, and none is longer than
    three of the longest documents.
    """
    binned = in_bins(documents, target_bytes)
    total, longest = (n or 1 for n in binned.agg(F.sum("bytes"), F.max("bytes")).first())
    strips = max(target_bytes // longest, 1)
    shuffled = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-total // LANDED_BYTES), shuffled)
    first = F.col("overall") - F.col("start") + F.col("bin") * target_bytes  # of all dates' bytes, where the bin begins
    dealt = binned.select(
        "date", "doc", "bin",
        F.floor(F.col("start") % target_bytes * strips / target_bytes).alias("strip"),
        F.floor(first / -(-total // tasks)).cast("int").alias("task"),
    )
    packed = (
        dealt.repartitionById(tasks, F.col("task"))
        .groupBy("task", "date", "bin", "strip")
        .agg(F.array_join(F.collect_list("doc"), "\n").alias("value"))
    )
    (
        packed.sortWithinPartitions("date", "bin", "strip")
        .select("date", "value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", strips)
        .partitionBy("date")
        .text(root)
    )


def read_document_lines(
    spark: SparkSession, root: str, schema: T.StructType = schemas.TRAINS
) -> DataFrame:
    """SRC-1. Scan documents landed as lines: files are split, and no body is held as a whole."""
    return spark.read.schema(schema).json(root)


def json_arrays(documents: DataFrame, bounded_by: list[str]) -> DataFrame:
    """Pack documents into JSON arrays, one per ``date`` and ``bounded_by`` group.

    The grouping columns must bound the size of an array: it is built in memory
    here and parsed in one task later. Documents become text before they are
    grouped, which takes far less memory than nested rows.
    """
    fields = [c for c in documents.columns if c not in ("date", *bounded_by)]
    text = documents.select("date", *bounded_by, F.to_json(F.struct(*fields)).alias("doc"))
    packed = text.groupBy("date", *bounded_by).agg(
        F.array_join(F.sort_array(F.collect_list("doc")), ",").alias("docs")
    )
    return packed.select(
        "date", *bounded_by, F.concat(F.lit("["), "docs", F.lit("]")).alias("body")
    )


def land_metadata(records: DataFrame, root: str, slice_of: Column) -> None:
    """Write metadata records as JSON arrays, one file per value of ``slice_of``.

    ``slice_of`` must bound the number of records per file.
    """
    fields = records.columns
    packed = (
        records.withColumn("slice", slice_of)
        .groupBy("slice")
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("records"))
    )
    packed.select(F.to_json("records").alias("value")).write.mode("overwrite").option(
        "maxRecordsPerFile", 1
    ).text(root)


def infer_metadata(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6. Scan a metadata document under an inferred schema."""
    return spark.read.option("multiLine", True).json(path)
