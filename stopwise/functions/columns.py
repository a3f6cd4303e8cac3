"""Pure column expressions: everything here stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_key(
    departure_date: Column,
    train_number: Column,
    station_short_code: Column,
    event_type: Column,
    scheduled_time: Column,
) -> Column:
    """STG-1. Stable digest of one timetable event.

    ``concat_ws`` skips NULL arguments, so a missing part is spelled out to keep
    two different events apart. Times count to the whole second.
    """
    # Separator, stand-in for a missing part, yyyy-MM-ddTHH:mm:ss.
    missing = F.lit("NULL")
    parts = [
        F.coalesce(c.cast("string"), missing)
        for c in (departure_date, train_number, station_short_code, event_type)
    ]
    # The text of a TIMESTAMP_NTZ never depends on the session zone; date_format
    # converts to an instant first and moves times inside a daylight-saving gap.
    text = scheduled_time.cast("timestamp_ntz").cast("string")
    when = F.coalesce(F.translate(F.substring(text, 1, 19), " ", "T"), missing)
    return F.md5(F.concat_ws("|", *parts, when))


def round_half_away(value: Column, places: int) -> Column:
    """Round a double half away from zero, on the binary value.

    Spark's own ``round`` goes through the decimal text of the double and lands
    one step off for values such as 1.005.
    """
    scale = 10.0**places
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale)


def on_time_flag(delay: Column, minutes: int) -> Column:
    """1 for a delay strictly below the threshold, 0 otherwise, NULL for no delay."""
    return (delay < minutes).cast("int")


def shifted_hour(utc_time: Column, offset_hours: int) -> Column:
    """ANA-9. Hour of day under a constant offset from UTC."""
    return ((F.hour(utc_time) + offset_hours) % 24).cast("bigint")


def local_hour(utc_time: Column, zone: str) -> Column:
    """ANA-10. Hour of day in a real time zone, whatever the session zone is."""
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_time)).cast("bigint")


def calendar_columns(date: Column) -> dict[str, Column]:
    """Calendar attributes of a date; Sunday is day 0 and weeks are ISO weeks."""
    weekday = F.dayofweek(date) - 1
    return {
        "date_key": F.date_format(date, "yyyyMMdd").cast("int"),
        "date": date,
        "day_of_week": weekday.cast("bigint"),
        "day_name": F.date_format(date, "EEEE"),
        "is_weekend": weekday.isin(0, 6),
        "month": F.month(date).cast("bigint"),
        "year": F.year(date).cast("bigint"),
        "week_of_year": F.weekofyear(date).cast("bigint"),
    }
