"""Fact tables (FCT-*).

Dimensions are read from written tables, so Catalyst knows their real size and
broadcasts them while they stay under ``spark.sql.autoBroadcastJoinThreshold``;
a dimension beyond that is joined by shuffle, where adaptive execution splits
hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators.dimensions import UNKNOWN_KEY

EVENT_COLUMNS = [
    "event_key",
    "station_key",
    "date_key",
    "train_type_key",
    "train_number",
    "event_type",
    "station_short_code",
    "operator_short_code",
    "commuter_line_id",
    "scheduled_time",
    "actual_time",
    "delay_minutes",
    "cause_count",
    "is_cancelled",
    "is_stopping",
    "is_commercial_stop",
    "has_actual_time",
    "is_plausible_delay",
    "source_ingest_date",
]

CAUSE_COLUMNS = [
    "event_key",
    "cause_seq",
    "cause_key",
    "cause_category_code",
    "detailed_cause_category_code",
    "third_cause_category_code",
]


def lookup_station(events: DataFrame, station: DataFrame) -> DataFrame:
    """FCT-1. Station key by code, the unknown member where the code has none."""
    keys = station.select("station_short_code", F.col("station_key").alias("found"))
    return (
        events.join(keys, "station_short_code", "left")
        .withColumn("station_key", F.coalesce("found", F.lit(UNKNOWN_KEY)))
        .drop("found")
    )


def lookup_train_type(events: DataFrame, train_type: DataFrame) -> DataFrame:
    """FCT-2. Train type key; a missing category matches a missing category."""
    keys = train_type.select("train_type_key", "train_type", "train_category").alias("t")
    e = events.alias("e")
    same = (F.col("t.train_type") == F.col("e.train_type")) & F.col(
        "t.train_category"
    ).eqNullSafe(F.col("e.train_category"))
    return e.join(keys, same, "left").select("e.*", "t.train_type_key")


def lookup_date(events: DataFrame, date: DataFrame) -> DataFrame:
    """FCT-3. Date key of the service day, not of the event's wall-clock day."""
    keys = date.select("date_key", F.col("date").alias("departure_date"))
    return events.join(keys, "departure_date", "left")


def timetable_events(
    events: DataFrame, station: DataFrame, train_type: DataFrame, date: DataFrame
) -> DataFrame:
    """FCT-4. Every staged event with its dimension keys; nothing is filtered."""
    keyed = lookup_date(lookup_train_type(lookup_station(events, station), train_type), date)
    return keyed.select(EVENT_COLUMNS)


def with_causes_only(events: DataFrame) -> DataFrame:
    """Events that carry a cause: all a cause row can ever join to.

    Holds whenever event keys are unique, which the build checks first. The
    filter reaches the scan and keeps the other 99 % out of the shuffle.
    """
    return events.filter(F.col("cause_count") > 0)


def known_causes(causes: DataFrame, events: DataFrame) -> DataFrame:
    """FCT-5. Cause rows whose event exists.

    The same as an inner join while event keys are unique; a semi join cannot
    multiply rows where they are not, and ``distinct`` shares the join's shuffle
    while leaving one row of each repeated key.
    """
    keys = with_causes_only(events).select("event_key").distinct()
    return causes.join(keys, "event_key", "left_semi")


def delay_causes(causes: DataFrame, events: DataFrame, cause: DataFrame) -> DataFrame:
    """FCT-5..7. Cause rows of known events with their cause key.

    ``source_ingest_date``, when staged, is carried along for partitioning.
    """
    known = known_causes(causes, events)
    keys = cause.select("cause_category_code", F.col("cause_key").alias("found"))
    extra = [c for c in ("source_ingest_date",) if c in causes.columns]
    return (
        known.join(keys, "cause_category_code", "left")
        .withColumn("cause_key", F.coalesce("found", F.lit(UNKNOWN_KEY)))
        .select(*CAUSE_COLUMNS, *extra)
    )
