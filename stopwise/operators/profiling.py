"""Profile of the raw layer (PRF-*): measure and document, clean nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import round_half_away
from stopwise.operators.staging import array_length
from stopwise.settings import Settings
from stopwise.sources.documents import with_ingest_date

# The quantiles reported for the delay distribution.
QUANTILES = {
    "p01": 0.01,
    "p05": 0.05,
    "p25": 0.25,
    "median": 0.5,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
}


def raw_trains(documents: DataFrame) -> DataFrame:
    """PRF-1. One row per document, the fields the profile needs, rows still nested."""
    return with_ingest_date(documents).select(
        "ingest_date",
        F.col("departureDate").cast("date").alias("departure_date"),
        F.col("trainNumber").alias("train_number"),
        F.col("trainType").alias("train_type"),
        F.col("trainCategory").alias("train_category"),
        F.col("commuterLineID").alias("commuter_line_id"),
        F.col("cancelled").alias("train_cancelled"),
        F.col("timeTableRows").alias("timetable_rows"),
    )


def raw_events(trains: DataFrame) -> DataFrame:
    """PRF-2. One row per timetable row, raw flags with their NULLs, 16 columns."""
    header = [c for c in trains.columns if c != "timetable_rows"]
    return trains.select(*header, F.explode("timetable_rows").alias("r")).select(
        *header,
        F.col("r.stationShortCode").alias("station_short_code"),
        F.col("r.type").alias("event_type"),
        F.col("r.trainStopping").alias("train_stopping"),
        F.col("r.commercialStop").alias("commercial_stop"),
        F.col("r.cancelled").alias("row_cancelled"),
        F.col("r.scheduledTime").cast("timestamp_ntz").alias("scheduled_time"),
        F.col("r.actualTime").cast("timestamp_ntz").alias("actual_time"),
        F.col("r.differenceInMinutes").alias("difference_in_minutes"),
        array_length(F.col("r.causes")).alias("n_causes"),
    )


def row_count(trains: DataFrame) -> Column:
    """Length of the nested array, NULL for none, read from a single nested field."""
    rows = F.col("timetable_rows.type")
    return F.when(rows.isNotNull(), F.size(rows)).cast("bigint")


def scope(trains: DataFrame) -> DataFrame:
    """PRF-3. Documents, events, days and the first and last day.

    Events are counted from the array lengths, without flattening, and per day
    first, so the distinct count runs over one row per day.
    """
    per_day = trains.groupBy("ingest_date").agg(
        F.count("*").alias("trains"),
        F.sum(row_count(trains)).alias("events"),
    )
    return per_day.agg(
        F.sum("trains").alias("trains"),
        F.sum("events").alias("events"),
        F.count("ingest_date").alias("days"),
        F.min("ingest_date").alias("first_day"),
        F.max("ingest_date").alias("last_day"),
    )


def _is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def trains_per_day(trains: DataFrame) -> DataFrame:
    """PRF-4. Documents, events and cancellations per service date."""
    return (
        trains.groupBy("ingest_date")
        .agg(
            F.count("*").alias("trains"),
            F.sum(row_count(trains)).alias("events"),
            F.sum(F.col("train_cancelled").cast("int")).alias("cancelled"),
        )
        .select(
            "ingest_date",
            F.date_format("ingest_date", "EEEE").alias("day_name"),
            _is_weekend(F.col("ingest_date")).alias("is_weekend"),
            "trains",
            "events",
            "cancelled",
        )
        .orderBy("ingest_date")
    )


def mean_trains_by_day_kind(trains: DataFrame) -> DataFrame:
    """PRF-5. Mean number of documents on weekdays and on weekend days."""
    per_day = trains.groupBy("ingest_date").agg(F.count("*").alias("c"))
    return per_day.groupBy(_is_weekend(F.col("ingest_date")).alias("is_weekend")).agg(
        round_half_away(F.avg("c"), 0).alias("mean_trains")
    )


def _duplicate_trains(trains: DataFrame) -> DataFrame:
    return (
        trains.groupBy("departure_date", "train_number")
        .agg(F.count("*").alias("documents"))
        .filter(F.col("documents") > 1)
    )


def duplicate_train_count(trains: DataFrame) -> DataFrame:
    """PRF-6. How many (date, train) pairs have more than one document."""
    return _duplicate_trains(trains).agg(F.count("*").alias("duplicate_pairs"))


def duplicate_train_samples(trains: DataFrame, count: int = 5) -> DataFrame:
    """PRF-7. The pairs with most documents."""
    return (
        _duplicate_trains(trains)
        .orderBy(F.col("documents").desc(), "departure_date", "train_number")
        .limit(count)
    )


def missing_actual_count(events: DataFrame) -> DataFrame:
    """PRF-8."""
    return events.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("actual_time").isNull()).alias("no_actual_time"),
    )


def last_day(documents: DataFrame) -> dt.date:
    """The last landed date; one value, read from the folder names."""
    return documents.agg(F.max("date")).first()[0]


def missing_actual_breakdown(events: DataFrame, last_day: dt.date) -> DataFrame:
    """PRF-9. Events without actual time by cancellation and by being after ``last_day``.

    Times after midnight at the start of ``last_day`` count as after.
    """
    midnight = F.lit(last_day).cast("timestamp_ntz")
    return (
        events.filter(F.col("actual_time").isNull())
        .groupBy(
            "train_cancelled",
            "row_cancelled",
            (F.col("scheduled_time") > midnight).alias("after_last_day"),
        )
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "train_cancelled", "row_cancelled", "after_last_day")
    )


def delay_distribution(events: DataFrame) -> DataFrame:
    """PRF-10. Minimum, quantiles and maximum of the delay as one struct.

    Counting per distinct delay first lets any number of rows share the work.
    """
    counts = (
        events.filter(F.col("difference_in_minutes").isNotNull())
        .groupBy("difference_in_minutes")
        .agg(F.count("*").alias("rows"))
    )
    delay = F.col("difference_in_minutes")
    levels = F.array(*[F.lit(p) for p in QUANTILES.values()])
    summary = counts.agg(
        F.min(delay).alias("min"),
        F.percentile(delay, levels, F.col("rows")).alias("p"),
        F.max(delay).alias("max"),
    )
    quantiles = [F.col("p")[i].alias(name) for i, name in enumerate(QUANTILES)]
    return summary.select(F.struct("min", *quantiles, "max").alias("stats"))


def missing_delay_count(events: DataFrame) -> DataFrame:
    """PRF-11."""
    return events.agg(
        F.count_if(F.col("difference_in_minutes").isNull()).alias("no_difference")
    )


def extreme_delays(events: DataFrame, count: int = 5) -> DataFrame:
    """PRF-12. The most delayed and the earliest events."""
    columns = [
        "departure_date",
        "train_number",
        "train_type",
        "station_short_code",
        "event_type",
        "difference_in_minutes",
    ]
    tie = ["departure_date", "train_number", "station_short_code", "event_type", "scheduled_time"]
    d = F.col("difference_in_minutes")
    late = events.orderBy(d.desc_nulls_last(), *tie).limit(count).select(*columns)
    early = events.orderBy(d.asc_nulls_last(), *tie).limit(count).select(*columns)
    return late.withColumn("side", F.lit("late")).unionByName(
        early.withColumn("side", F.lit("early"))
    )


def cancelled_trains(trains: DataFrame) -> DataFrame:
    """PRF-13. Cancelled documents, their events, and those that still ran.

    All three come from the nested rows of one scan, without flattening.
    """
    ran = F.size(F.array_compact(F.col("timetable_rows.actualTime")))
    return trains.filter("train_cancelled").agg(
        F.count("*").alias("cancelled_trains"),
        F.coalesce(F.sum(row_count(trains)), F.lit(0)).alias("events"),
        F.coalesce(F.sum(F.greatest(ran.cast("bigint"), F.lit(0))), F.lit(0)).alias(
            "events_with_actual"
        ),
    )


def cause_count_distribution(events: DataFrame) -> DataFrame:
    """PRF-14. Events per number of causes, one or more."""
    return (
        events.filter(F.col("n_causes") > 0)
        .groupBy("n_causes")
        .agg(F.count("*").alias("n"))
        .orderBy("n_causes")
    )


def frequency(trains: DataFrame, column: str) -> DataFrame:
    """PRF-15. Documents per value of a header column, most frequent first."""
    return (
        trains.groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col(column).asc_nulls_last())
    )


def unmatched_stations(events: DataFrame, stations: DataFrame) -> DataFrame:
    """PRF-16. Station codes in the events that the metadata lacks, with event counts.

    Codes are counted first; the anti join then sees one row per code. A missing
    code matches nothing and is listed too.
    """
    counts = events.groupBy("station_short_code").agg(F.count("*").alias("n"))
    known = stations.select(F.col("stationShortCode").alias("station_short_code"))
    return counts.join(known, "station_short_code", "left_anti").orderBy(
        F.col("n").desc(), F.col("station_short_code").asc_nulls_last()
    )


def midnight_trains(events: DataFrame) -> DataFrame:
    """PRF-17. Trains on more than one calendar date; events off their service date.

    Two distinct dates exist exactly when the first and the last differ, which
    needs no distinct count.
    """
    day = F.to_date("scheduled_time")
    per_train = (
        events.filter(F.col("scheduled_time").isNotNull())
        .groupBy("train_number", "departure_date")
        .agg(
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.count_if(day != F.col("departure_date")).alias("off_date"),
        )
    )
    return per_train.agg(
        F.count_if(F.col("first_day") != F.col("last_day")).alias("spanning_trains"),
        F.coalesce(F.sum("off_date"), F.lit(0)).alias("off_date_events"),
    )


def unexplained_missing_actual(staged: DataFrame, last_day: dt.date) -> DataFrame:
    """PRF-18. Uncancelled events of completed days without actual time, by stopping."""
    return (
        staged.filter(
            ~F.col("is_cancelled")
            & ~F.col("has_actual_time")
            & (F.col("departure_date") < F.lit(last_day))
        )
        .groupBy("is_stopping")
        .agg(F.count("*").alias("n"))
    )


def delay_without_actual(events: DataFrame) -> DataFrame:
    """PRF-19. Missing actual time with a delay, and the reverse."""
    actual, delay = F.col("actual_time"), F.col("difference_in_minutes")
    return events.agg(
        F.count_if(actual.isNull() & delay.isNotNull()).alias("delay_without_actual"),
        F.count_if(actual.isNotNull() & delay.isNull()).alias("actual_without_delay"),
    )


def cause_code_frequency(causes: DataFrame) -> DataFrame:
    """PRF-20. Cause rows per category code."""
    return (
        causes.groupBy("cause_category_code")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("cause_category_code").asc_nulls_last())
    )


def late_events_with_cause(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """PRF-20. Raw events at or above the on-time threshold, and those with a cause."""
    return events.filter(F.col("difference_in_minutes") >= settings.on_time_minutes).agg(
        F.count("*").alias("late_events"),
        F.count_if(F.col("n_causes") > 0).alias("with_cause"),
    )


def relation_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """PRF-21. Rows per built relation."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
        for name, df in relations.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def unknown_member_rows(events: DataFrame, causes: DataFrame) -> DataFrame:
    """PRF-21. Fact rows that fell back to an unknown member."""
    return (
        events.agg(F.count_if(F.col("station_key") == -1).alias("n"))
        .withColumn("member", F.lit("station"))
        .unionByName(
            causes.agg(F.count_if(F.col("cause_key") == -1).alias("n")).withColumn(
                "member", F.lit("cause")
            )
        )
    )
