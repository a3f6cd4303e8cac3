"""Data-quality checks (DQ-*): each yields the violating rows; NULLs only fail ``not_null``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.settings import Settings

ERROR = "error"
WARN = "warn"


def unique(rel: DataFrame, column: str) -> DataFrame:
    """DQ-1. Values that occur more than once, with their row count."""
    return (
        rel.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def not_null(rel: DataFrame, column: str) -> DataFrame:
    """DQ-2. Rows without a value."""
    return rel.filter(F.col(column).isNull())


def accepted_values(rel: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """DQ-3. Distinct values outside the list, with their row count."""
    return (
        rel.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    )


def relationships(rel: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """DQ-4. Rows whose value does not occur in ``to.field``."""
    parent = to.select(F.col(field).alias("__parent"))
    return rel.filter(F.col(column).isNotNull()).join(
        parent, F.col(column) == F.col("__parent"), "left_anti"
    )


def orphan_values(rel: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """DQ-4. Distinct values that do not occur in ``to.field``, with their row count.

    Counting comes before the join, so a value shared by most rows joins once.
    """
    counts = (
        rel.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    return relationships(counts, column, to, field)


def is_implausibly_early(settings: Settings) -> Column:
    return (
        F.col("has_actual_time")
        & ~F.col("is_cancelled")
        & F.col("is_commercial_stop")
        & (F.col("delay_minutes") < -settings.early_tolerance_minutes)
    )


def is_implausible(settings: Settings) -> Column:
    return ~F.col("delay_minutes").between(
        settings.min_plausible_minutes, settings.max_plausible_minutes
    )


def implausibly_early(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """DQ-5. Realised commercial stops far ahead of schedule."""
    return (
        events.filter(is_implausibly_early(settings))
        .select(
            "event_key",
            "train_number",
            "station_key",
            "event_type",
            "scheduled_time",
            "actual_time",
            "delay_minutes",
        )
        .orderBy("delay_minutes")
    )


def implausible_delay(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """DQ-6. Events whose delay lies outside the plausible band."""
    return (
        events.filter(is_implausible(settings))
        .select("event_key", "train_number", "station_key", "event_type", "delay_minutes")
        .orderBy("delay_minutes")
    )


def row_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each relation, a column per relation."""
    single = [
        rel.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
        for name, rel in relations.items()
    ]
    return reduce(DataFrame.unionByName, single).agg(
        *[F.max(F.when(F.col("relation") == name, F.col("n"))).alias(name) for name in relations]
    )


def count_comparison(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of staging and fact side by side, and their difference."""
    counts = row_counts({"staging_rows": staged, "fact_rows": fact})
    return counts.withColumn("difference", F.col("fact_rows") - F.col("staging_rows"))


def count_mismatch(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """DQ-7. One row if the fact lost or gained rows against staging, else none."""
    return count_comparison(staged, fact).filter(F.col("difference") != 0)


def orphan_stations(staged: DataFrame, station: DataFrame) -> DataFrame:
    """DQ-8. Station codes without a dimension row, with event counts.

    Codes are counted before the anti join, which then sees one row per code.
    """
    counts = staged.groupBy("station_short_code").agg(F.count("*").alias("event_count"))
    return counts.join(
        station.select("station_short_code"), "station_short_code", "left_anti"
    ).orderBy(F.col("event_count").desc(), "station_short_code")
