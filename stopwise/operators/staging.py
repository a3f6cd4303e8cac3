"""Staging views over raw documents and metadata (STG-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import event_key
from stopwise.settings import Settings
from stopwise.sources.documents import ingest_date

EVENT_COLUMNS = [
    "event_key",
    "departure_date",
    "train_number",
    "operator_short_code",
    "train_type",
    "train_category",
    "commuter_line_id",
    "station_short_code",
    "event_type",
    "scheduled_time",
    "actual_time",
    "delay_minutes",
    "timetable_type",
    "commercial_track",
    "cause_count",
    "source_ingest_date",
    "is_cancelled",
    "is_stopping",
    "is_commercial_stop",
    "has_actual_time",
    "is_plausible_delay",
]

CAUSE_COLUMNS = [
    "event_key",
    "cause_seq",
    "cause_category_code",
    "detailed_cause_category_code",
    "third_cause_category_code",
]


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def plausible_delay(delay: Column, settings: Settings) -> Column:
    """A missing delay counts as plausible; both ends of the band are inside."""
    return delay.isNull() | delay.between(
        settings.min_plausible_minutes, settings.max_plausible_minutes
    )


def flatten_rows(documents: DataFrame) -> DataFrame:
    """STG-2..5. One typed row per timetable row; a document without rows drops out."""
    exploded = documents.select(
        F.col("departureDate").cast("date").alias("departure_date"),
        F.col("trainNumber").alias("train_number"),
        F.col("operatorShortCode").alias("operator_short_code"),
        F.col("trainType").alias("train_type"),
        F.col("trainCategory").alias("train_category"),
        _blank_to_null(F.col("commuterLineID")).alias("commuter_line_id"),
        _false_if_null(F.col("cancelled")).alias("train_cancelled"),
        F.col("timetableType").alias("timetable_type"),
        ingest_date(documents).alias("source_ingest_date"),
        F.explode("timeTableRows").alias("r"),
    )
    return exploded.select(
        "departure_date",
        "train_number",
        "operator_short_code",
        "train_type",
        "train_category",
        "commuter_line_id",
        "train_cancelled",
        "timetable_type",
        "source_ingest_date",
        F.col("r.stationShortCode").alias("station_short_code"),
        F.col("r.type").alias("event_type"),
        F.col("r.scheduledTime").cast("timestamp_ntz").alias("scheduled_time"),
        F.col("r.actualTime").cast("timestamp_ntz").alias("actual_time"),
        F.col("r.differenceInMinutes").cast("bigint").alias("delay_minutes"),
        _false_if_null(F.col("r.trainStopping")).alias("is_stopping"),
        _false_if_null(F.col("r.commercialStop")).alias("is_commercial_stop"),
        _false_if_null(F.col("r.cancelled")).alias("row_cancelled"),
        _blank_to_null(F.col("r.commercialTrack")).alias("commercial_track"),
        array_length(F.col("r.causes")).alias("cause_count"),
    )


def array_length(array: Column) -> Column:
    """Length of an array, 0 for NULL, under ANSI and legacy settings alike."""
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array)).cast("bigint")


def add_flags(rows: DataFrame, settings: Settings) -> DataFrame:
    """STG-6. Keep every row and flag it."""
    return rows.withColumns(
        {
            "is_cancelled": F.col("train_cancelled") | F.col("row_cancelled"),
            "has_actual_time": F.col("actual_time").isNotNull(),
            "is_plausible_delay": plausible_delay(F.col("delay_minutes"), settings),
        }
    )


def with_event_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "event_key",
        event_key(
            F.col("departure_date"),
            F.col("train_number"),
            F.col("station_short_code"),
            F.col("event_type"),
            F.col("scheduled_time"),
        ),
    )


def timetable_events(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """STG-7. One row per train, station, event type and scheduled time."""
    return with_event_key(add_flags(flatten_rows(documents), settings)).select(EVENT_COLUMNS)


def narrow_rows(documents: DataFrame, *fields: str) -> DataFrame:
    """Train identity plus some fields of each timetable row, as a struct ``r``.

    Exploding whole structs makes a columnar scan read every nested field;
    zipping the wanted ones lets it read only those.
    """
    return documents.select(
        F.col("departureDate").cast("date").alias("departure_date"),
        F.col("trainNumber").alias("train_number"),
        ingest_date(documents).alias("source_ingest_date"),
        F.explode(F.arrays_zip(*[F.col(f"timeTableRows.{f}") for f in fields])).alias("r"),
    )


def event_keys(documents: DataFrame) -> DataFrame:
    """The key and its parts for every staged event: what the staging checks need."""
    rows = narrow_rows(documents, "stationShortCode", "type", "scheduledTime").select(
        "departure_date",
        "train_number",
        F.col("r.stationShortCode").alias("station_short_code"),
        F.col("r.type").alias("event_type"),
        F.col("r.scheduledTime").cast("timestamp_ntz").alias("scheduled_time"),
    )
    return with_event_key(rows)


def event_headers(documents: DataFrame) -> DataFrame:
    """Document-level columns of all staged events, one row per document.

    Enough for whatever only needs the distinct values or the range of those
    columns; reads one nested field to leave out documents without rows.
    """
    return documents.filter(F.size("timeTableRows.type") > 0).select(
        F.col("departureDate").cast("date").alias("departure_date"),
        F.col("trainNumber").alias("train_number"),
        F.col("trainType").alias("train_type"),
        F.col("trainCategory").alias("train_category"),
    )


def delay_causes(documents: DataFrame) -> DataFrame:
    """STG-8..10. One row per event and cause, numbered in array order.

    The position in the array equals a row number per event as long as event
    keys are unique, and needs no shuffle.
    """
    with_cause = documents.filter(
        F.exists(F.col("timeTableRows.causes"), lambda causes: F.size(causes) > 0)
    )
    exploded = narrow_rows(
        with_cause, "stationShortCode", "type", "scheduledTime", "causes"
    ).filter(F.size("r.causes") > 0)
    keyed = exploded.select(
        event_key(
            F.col("departure_date"),
            F.col("train_number"),
            F.col("r.stationShortCode"),
            F.col("r.type"),
            F.col("r.scheduledTime").cast("timestamp_ntz"),
        ).alias("event_key"),
        "source_ingest_date",
        F.col("r.causes").alias("causes"),
    )
    return keyed.select(
        "event_key", "source_ingest_date", F.posexplode("causes").alias("position", "c")
    ).select(
        "event_key",
        (F.col("position") + 1).cast("bigint").alias("cause_seq"),
        F.col("c.categoryCode").alias("cause_category_code"),
        F.col("c.detailedCategoryCode").alias("detailed_cause_category_code"),
        F.col("c.thirdCategoryCode").alias("third_cause_category_code"),
        "source_ingest_date",
    )


def stations(raw: DataFrame) -> DataFrame:
    """STG-11."""
    return raw.select(
        F.col("stationShortCode").alias("station_short_code"),
        F.col("stationName").alias("station_name"),
        F.col("stationUICCode").alias("station_uic_code"),
        F.col("countryCode").alias("country_code"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        _false_if_null(F.col("passengerTraffic")).alias("passenger_traffic"),
        F.col("type").alias("station_type"),
    )


def cause_codes(raw: DataFrame) -> DataFrame:
    """STG-12."""
    return raw.select(
        F.col("categoryCode").alias("cause_category_code"),
        F.col("categoryName").alias("cause_category_name"),
        F.col("validFrom").cast("date").alias("valid_from"),
    )


def detailed_cause_codes(raw: DataFrame) -> DataFrame:
    """STG-13."""
    return raw.select(
        F.col("detailedCategoryCode").alias("detailed_cause_category_code"),
        F.col("detailedCategoryName").alias("detailed_cause_category_name"),
        F.col("validFrom").cast("date").alias("valid_from"),
    )
