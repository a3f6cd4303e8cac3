"""The punctuality aggregate and its pooling rule (AGG-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import round_half_away
from stopwise.settings import Settings


def commercial_arrivals(events: DataFrame) -> DataFrame:
    return events.filter((F.col("event_type") == "ARRIVAL") & F.col("is_commercial_stop"))


COUNTED = [
    "station_key", "date_key", "train_type_key", "is_cancelled", "has_actual_time", "is_plausible_delay", "delay_minutes",
]


def delay_counts(events: DataFrame) -> DataFrame:
    """Commercial arrivals counted by station, date, train type, flags and whole minute of delay.

    An exact histogram: every percentile, tail and on-time rate of these arrivals, at any
    threshold, comes from its ``rows``, and those of a coarser group from sums of them.
    """
    return commercial_arrivals(events).groupBy(*COUNTED).agg(F.count("*").alias("rows"))


def station_punctuality(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """AGG-1. Arrivals at commercial stops by station and date.

    Rows are first counted per (station, date, delay, flags) with map-side
    combining. The second step then sees at most one row per distinct delay, so
    the exact median is cheap and a hub station cannot swamp one task.
    """
    return punctuality_of_counts(delay_counts(events), settings)


def punctuality_of_counts(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """AGG-1 from the stored counts, without the fact."""
    measured = (
        F.col("has_actual_time") & F.col("is_plausible_delay") & ~F.col("is_cancelled")
    )
    counts = rows.groupBy(
        "station_key",
        "date_key",
        "is_cancelled",
        measured.alias("measured"),
        F.when(measured, F.col("delay_minutes")).alias("delay"),
    ).agg(F.sum("rows").alias("n"))
    n, delay = F.col("n"), F.col("delay")
    known = delay.isNotNull()
    on_time = delay < settings.on_time_minutes
    sums = counts.groupBy("station_key", "date_key").agg(
        F.sum("n").alias("scheduled_arrivals"),
        F.sum(F.when(F.col("is_cancelled"), n).otherwise(0)).alias("cancelled_arrivals"),
        F.sum(F.when(F.col("measured"), n).otherwise(0)).alias("measured_arrivals"),
        F.sum(F.when(on_time, n).otherwise(0)).alias("on_time_events"),
        F.sum(delay * n).alias("delay_sum"),
        F.sum(F.when(known, n)).alias("delay_n"),
        F.percentile(delay, 0.5, F.when(known, n).otherwise(0)).alias("median_delay_minutes"),
        F.max("delay").alias("worst_delay_minutes"),
    )
    rate = F.col("on_time_events") / F.nullif(F.col("measured_arrivals"), F.lit(0))
    return sums.select(
        "station_key",
        "date_key",
        "scheduled_arrivals",
        "cancelled_arrivals",
        "measured_arrivals",
        "on_time_events",
        round_half_away(rate, 4).alias("on_time_rate"),
        round_half_away(F.col("delay_sum") / F.col("delay_n"), 2).alias("avg_delay_minutes"),
        "median_delay_minutes",
        "worst_delay_minutes",
    )


def pooled_punctuality(punctuality: DataFrame, *by: str) -> DataFrame:
    """AGG-2. Pool the aggregate to a coarser level: sums over sums, max of max.

    Rates, averages and medians are not additive and are never averaged.
    """
    sums = punctuality.groupBy(*by).agg(
        F.sum("scheduled_arrivals").alias("scheduled_arrivals"),
        F.sum("cancelled_arrivals").alias("cancelled_arrivals"),
        F.sum("measured_arrivals").alias("measured_arrivals"),
        F.sum("on_time_events").alias("on_time_events"),
        F.max("worst_delay_minutes").alias("worst_delay_minutes"),
    )
    rate = F.col("on_time_events") / F.nullif(F.col("measured_arrivals"), F.lit(0))
    return sums.withColumn("on_time_rate", round_half_away(rate, 4))


def service_days(events: DataFrame) -> DataFrame:
    """Service days that occur in each landed day: one row for most days."""
    return events.select("date_key", "source_ingest_date").distinct()
