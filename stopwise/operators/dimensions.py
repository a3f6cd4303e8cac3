"""Dimension tables (DIM-*). Each is small next to the facts, but none is assumed to be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.functions import calendar_columns, number_rows

UNKNOWN_KEY = -1

#: Natural keys, in the order that dense keys follow.
STATION = ["station_short_code"]
TRAIN_TYPE = ["train_category", "train_type"]
CAUSE = ["cause_category_code"]


def with_unknown_member(keyed: DataFrame, member: dict[str, object]) -> DataFrame:
    """DIM-2. Append the row that catches codes missing from the metadata.

    Columns not named in ``member`` are NULL in that row.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keyed.schema])
    row = [tuple(member.get(f.name) for f in schema)]
    return keyed.unionByName(keyed.sparkSession.createDataFrame(row, schema))


def extended_keys(known: DataFrame | None, rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """A key map: ``key`` and the natural key ``by``. Keys once given never change or go.

    Natural keys that ``known`` lacks get the keys after its last one, in their own order; nulls
    are values like others.
    """
    wanted = rows.select(*by).distinct()
    if known is None:
        return number_rows(wanted, key, by).select(key, *by)
    new = lacking(known, wanted, by)
    last = known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    numbered = number_rows(new, key, by).withColumn(key, F.col(key) + last)
    return known.unionByName(numbered.select(key, *by))


def lacking(known: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose natural key ``known`` does not have."""
    return rows.alias("r").join(known.alias("k"), _same("r", "k", by), "left_anti")


def _same(left: str, right: str, by: list[str]) -> Column:
    """Equal in all columns, nulls equal to nulls."""
    return reduce(Column.__and__, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in by])


def merged(known: DataFrame, fresh: DataFrame, by: list[str]) -> DataFrame:
    """Rows as they are now: fresh ones replace known ones of their natural key, others stay."""
    return fresh.unionByName(lacking(fresh, known, by).select(fresh.columns))


def _with_keys(rows: DataFrame, key: str, by: list[str], keys: DataFrame | None) -> DataFrame:
    if keys is None:
        return number_rows(rows, key, by)
    return rows.alias("r").join(keys.alias("k"), _same("r", "k", by)).select(f"k.{key}", "r.*")


def station(stations: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """DIM-3. One row per station code, plus the unknown member; keyed by ``keys``, else in code order."""
    keyed = _with_keys(stations, "station_key", STATION, keys).select(
        "station_key",
        "station_short_code",
        "station_name",
        "country_code",
        "latitude",
        "longitude",
        "passenger_traffic",
        "station_type",
    )
    # The unknown member.
    return with_unknown_member(
        keyed,
        {
            "station_key": UNKNOWN_KEY,
            "station_short_code": "UNKNOWN",
            "station_name": "Unknown station",
            "passenger_traffic": False,
        },
    )


def date(events: DataFrame) -> DataFrame:
    """DIM-4. Every day between the first and the last departure date."""
    bounds = events.agg(
        F.min("departure_date").alias("first"), F.max("departure_date").alias("last")
    )
    days = bounds.select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return days.select(*[c.alias(n) for n, c in calendar_columns(F.col("day")).items()])


def train_type(events: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """DIM-5. One row per observed pair of train type and category."""
    pairs = train_type_flags(events.select("train_type", "train_category").distinct())
    return _with_keys(pairs, "train_type_key", TRAIN_TYPE, keys).select("train_type_key", *pairs.columns)


def train_type_flags(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "train_type",
        "train_category",
        (F.col("train_category") == "Long-distance").alias("is_long_distance"),
        (F.col("train_category") == "Commuter").alias("is_commuter"),
    )


def cause(cause_codes: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """DIM-6. One row per cause category, plus the unknown member; keyed as stations are."""
    keyed = _with_keys(cause_codes, "cause_key", CAUSE, keys).select(
        "cause_key", "cause_category_code", "cause_category_name", "valid_from"
    )
    # The unknown member.
    return with_unknown_member(
        keyed,
        {
            "cause_key": UNKNOWN_KEY,
            "cause_category_code": "UNKNOWN",
            "cause_category_name": "Unknown / unmapped cause",
        },
    )
