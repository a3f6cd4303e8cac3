"""Validation of landed days, ingestion state and catch-up windows (ING-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise import schemas
from stopwise.operators.quality import row_counts
from stopwise.sources.documents import path_date
from stopwise.storage import save

ACCEPTED = "accepted"
_CORRUPT = "_corrupt_record"

#: What a scan of the landing says about the file a document comes from.
FILE_COLUMNS = ["file", "gz_bytes", "modified_at", "response_bytes", "body_hash", "is_array", "is_corrupt"]


def _on_days(scan: DataFrame, days: list[dt.date] | None) -> DataFrame:
    """Only the folders of some dates; all of them without ``days``."""
    return scan if days is None else scan.filter(F.col("date").isin(*days))


def landed_files(spark: SparkSession, root: str, days: list[dt.date] | None = None) -> DataFrame:
    """Landed files, their sizes and when they were written; file contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            path_date(F.col("path")).alias("date"),
            _local_name(F.col("path")).alias("file"),
            F.col("length").alias("gz_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )
    return _on_days(listed, days)


def landed_dates(spark: SparkSession, root: str) -> DataFrame:
    """Dates that have a landed file; file contents are not read."""
    return landed_files(spark, root).select("date").distinct()


def _local_name(path: Column) -> Column:
    """Listing and scan spell the scheme of a path differently; compare without it."""
    return F.regexp_replace(path, r"^[a-z0-9]+:/*", "/")


def changed_dates(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Dates with a file that ``seen`` lacks or knows with another size or time, or without one it had.

    A date all of whose files are gone has been cleared from the landing, not changed.
    """
    known = seen.select("date", "file", "gz_bytes", "modified_at")
    there = listed.select(known.columns)
    new = there.join(known, known.columns, "left_anti")
    lost = known.join(there, ["date", "file"], "left_anti").join(there.select("date"), "date", "left_semi")
    return new.select("date").unionByName(lost.select("date")).distinct()


def scan_landing(spark: SparkSession, root: str, days: list[dt.date] | None = None) -> DataFrame:
    """Documents of the landing with what their file says, from one read of every body.

    A row per document; one without any for a body that has none. A body is one row of text, so
    its length, its checksum, how it begins and the documents it holds come from the same scan. A
    body that is no array is read as the only element of one: whether it parses and whether it is
    an array are different questions.
    """
    bodies = _on_days(spark.read.text(root, wholetext=True), days)
    return parsed_bodies(bodies.select("*", "_metadata"))


def parsed_bodies(bodies: DataFrame) -> DataFrame:
    """The same from bodies read already: (date, value, _metadata), a row per file."""
    documents = T.StructField("docs", T.ArrayType(schemas.TRAINS))
    schema = T.StructType([documents, T.StructField(_CORRUPT, T.StringType())])
    body = F.col("value")
    is_array = body.rlike(r"^\s*\[")
    whole = F.when(is_array, body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    parsed = F.from_json(
        F.concat(F.lit('{"docs":'), whole, F.lit("}")), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    files = bodies.select(
        "date",
        _local_name(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_size").alias("gz_bytes"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.octet_length(body).cast("bigint").alias("response_bytes"),
        F.md5(body.cast("binary")).alias("body_hash"),
        is_array.alias("is_array"),
        parsed.alias("parsed"),
    )
    blank = F.col("parsed.docs").isNull() & (F.col("response_bytes") == 0)
    return files.select(
        *[c for c in files.columns if c != "parsed"],
        (F.col(f"parsed.{_CORRUPT}").isNotNull() & ~blank).alias("is_corrupt"),
        F.explode_outer("parsed.docs").alias("doc"),
    ).select(*[c for c in files.columns if c != "parsed"], "is_corrupt", F.col("doc").isNotNull().alias("has_doc"), "doc.*")


def file_outcomes(scanned: DataFrame) -> DataFrame:
    """A row per scanned file: what ``scan_landing`` says of it, its documents and its status."""
    per_file = scanned.groupBy("date", *FILE_COLUMNS).agg(F.count_if("has_doc").alias("documents"))
    reason = (
        F.when(F.col("is_corrupt"), "malformed")
        .when(F.col("documents") == 0, "empty")
        .when(~F.col("is_array"), "not_an_array")
        .otherwise(ACCEPTED)
    )
    return per_file.withColumn("reason", reason)


def date_outcomes(files: DataFrame) -> DataFrame:
    """ING-2. Outcome per date: accepted when every one of its files is."""
    ok = F.col("reason") == ACCEPTED
    per_date = files.groupBy("date").agg(
        F.count("*").alias("files"),
        F.count_if(~ok).alias("bad_files"),
        F.max(F.when(~ok, F.col("reason"))).alias("bad"),
        F.sum("response_bytes").alias("response_bytes"),
        F.sum("gz_bytes").alias("gz_bytes"),
        F.sum(F.when(ok, F.col("documents")).otherwise(0)).alias("num_trains"),
    )
    return per_date.select(
        "date",
        "files",
        "bad_files",
        F.coalesce("bad", F.lit(ACCEPTED)).alias("status"),
        "response_bytes",
        "gz_bytes",
        "num_trains",
    )


def validate_landing(
    spark: SparkSession, root: str, days: list[dt.date] | None = None
) -> DataFrame:
    """ING-2. Outcome per landed date, or per one of ``days`` that is landed.

    A date is accepted when every one of its files parses, is an array and is not empty.
    """
    return date_outcomes(file_outcomes(scan_landing(spark, root, days)))


def wall_clock(at: dt.datetime) -> Column:
    """A zone-free time literal; a plain literal would pass through the session zone."""
    return F.lit(at.isoformat()).cast("timestamp_ntz")


def accepted_state(outcomes: DataFrame, fetched_at: Column) -> DataFrame:
    """State rows of the accepted dates; a rejected date does not advance anything."""
    return outcomes.filter(F.col("status") == ACCEPTED).select(
        "date", fetched_at.alias("fetched_at"), "response_bytes", "gz_bytes", "num_trains"
    )


def record_state(rows: DataFrame, path: str) -> DataFrame:
    """ING-1. Append state rows; ``current_state`` picks the latest per date."""
    return save(rows, path, mode="append")


def current_state(log: DataFrame) -> DataFrame:
    """ING-1. The latest fetch per date wins; of fetches at one time the one with larger values."""
    rest = [c for c in log.columns if c != "date"]
    ordered = ["fetched_at", *[c for c in rest if c != "fetched_at"]]
    return log.groupBy("date").agg(F.max(F.struct(*ordered)).alias("latest")).select(
        "date", *[f"latest.{c}" for c in rest]
    )


def accepted_documents(documents: DataFrame, state: DataFrame) -> DataFrame:
    """Documents of accepted dates only: a bad body stays out of staging.

    ``state`` is a stored table of a row per date; it is broadcast, and its dates
    prune the folders of the scan.
    """
    return documents.join(state.select("date"), "date", "left_semi")


def _days(first: Column, last: Column) -> Column:
    """Every day from first to last; none when first is later (never backwards)."""
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """ING-5. Both ends included."""
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return bounds.select(F.explode(_days(F.col("a"), F.col("b"))).alias("date"))


def watermark(state: DataFrame) -> DataFrame:
    """ING-3. The last loaded date."""
    return state.agg(F.max("date").alias("watermark"))


def catch_up_window(state: DataFrame, as_of: dt.date) -> DataFrame:
    """ING-3. First and last date to fetch, and how many; 0 when up to date."""
    first = F.date_add("watermark", 1)
    last = F.date_sub(F.lit(as_of), 1)
    return watermark(state).select(
        "watermark",
        first.alias("first_date"),
        last.alias("last_date"),
        F.greatest(F.datediff(last, first) + 1, F.lit(0)).cast("bigint").alias("dates"),
    )


def catch_up_dates(state: DataFrame, as_of: dt.date) -> DataFrame:
    """ING-3. The dates after the watermark, up to the day before ``as_of``."""
    window = catch_up_window(state, as_of)
    return window.select(
        F.explode(_days(F.col("first_date"), F.col("last_date"))).alias("date")
    )


def missing_dates(state: DataFrame, as_of: dt.date) -> DataFrame:
    """ING-4. Every date not loaded since the first one, holes included."""
    first = state.agg(F.min("date").alias("first_date"))
    spine = first.select(
        F.explode(_days(F.col("first_date"), F.date_sub(F.lit(as_of), 1))).alias("date")
    )
    return spine.join(state.select("date"), "date", "left_anti")


def stale(fetched: DataFrame, as_of: dt.datetime, max_age_days: int = 7) -> DataFrame:
    """ING-7. (file, fetched_at) plus whether a file has reached the allowed age."""
    limit = wall_clock(as_of) - F.make_dt_interval(F.lit(max_age_days))
    return fetched.withColumn("is_stale", F.col("fetched_at") <= limit)


def stale_metadata(
    spark: SparkSession, path: str, as_of: dt.datetime, max_age_days: int = 7
) -> DataFrame:
    """ING-7. Metadata files and whether they are older than the allowed age."""
    changed = F.col("modificationTime")
    limit = F.lit(as_of.astimezone(dt.timezone.utc)) - F.make_dt_interval(F.lit(max_age_days))
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file"),
            (changed <= limit).alias("is_stale"),
        )
    )


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """ING-8. Dates and documents per outcome; one bad date does not stop the others."""
    return outcomes.groupBy("status").agg(
        F.count("*").alias("dates"), F.sum("num_trains").alias("num_trains")
    )


def run_log_row(
    state: DataFrame,
    events: DataFrame,
    causes: DataFrame,
    dates: int,
    status: str,
    at: dt.datetime,
) -> DataFrame:
    """ING-9. One line about a run, to be appended to the run log."""
    counted = row_counts({"event_rows": events, "cause_rows": causes})
    return (
        watermark(state)
        .unionByName(counted, allowMissingColumns=True)
        .agg(
            F.max("watermark").alias("watermark"),
            F.max("event_rows").alias("event_rows"),
            F.max("cause_rows").alias("cause_rows"),
        )
        .select(
            wall_clock(at).alias("run_at"),
            F.lit(dates).cast("bigint").alias("dates"),
            "watermark",
            "event_rows",
            "cause_rows",
            F.lit(status).alias("status"),
        )
    )
