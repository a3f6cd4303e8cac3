"""Declared schemas of the landed documents and their metadata.

Times stay strings here: a JSON scan declared as TIMESTAMP_NTZ yields NULL for
text ending in "Z", while a later cast reads it and ignores the session zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

CAUSE = T.StructType(
    [
        T.StructField("categoryCode", T.StringType()),
        T.StructField("detailedCategoryCode", T.StringType()),
        T.StructField("thirdCategoryCode", T.StringType()),
    ]
)

TIMETABLE_ROW = T.StructType(
    [
        T.StructField("stationShortCode", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("trainStopping", T.BooleanType()),
        T.StructField("commercialStop", T.BooleanType()),
        T.StructField("cancelled", T.BooleanType()),
        T.StructField("scheduledTime", T.StringType()),
        T.StructField("actualTime", T.StringType()),
        T.StructField("differenceInMinutes", T.LongType()),
        T.StructField("commercialTrack", T.StringType()),
        T.StructField("causes", T.ArrayType(CAUSE)),
    ]
)

TRAINS = T.StructType(
    [
        T.StructField("departureDate", T.StringType()),
        T.StructField("trainNumber", T.LongType()),
        T.StructField("operatorShortCode", T.StringType()),
        T.StructField("trainType", T.StringType()),
        T.StructField("trainCategory", T.StringType()),
        T.StructField("commuterLineID", T.StringType()),
        T.StructField("cancelled", T.BooleanType()),
        T.StructField("timetableType", T.StringType()),
        T.StructField("timeTableRows", T.ArrayType(TIMETABLE_ROW)),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("stationShortCode", T.StringType()),
        T.StructField("stationName", T.StringType()),
        T.StructField("stationUICCode", T.LongType()),
        T.StructField("countryCode", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("passengerTraffic", T.BooleanType()),
        T.StructField("type", T.StringType()),
    ]
)

CAUSE_CODES = T.StructType(
    [
        T.StructField("categoryCode", T.StringType()),
        T.StructField("categoryName", T.StringType()),
        T.StructField("validFrom", T.StringType()),
    ]
)

DETAILED_CAUSE_CODES = T.StructType(
    [
        T.StructField("detailedCategoryCode", T.StringType()),
        T.StructField("detailedCategoryName", T.StringType()),
        T.StructField("validFrom", T.StringType()),
    ]
)

INGESTION_STATE = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("fetched_at", T.TimestampNTZType(), False),
        T.StructField("response_bytes", T.LongType(), False),
        T.StructField("gz_bytes", T.LongType(), False),
        T.StructField("num_trains", T.LongType(), False),
    ]
)


def subset(schema: T.StructType, keep: dict[str, list[str] | None]) -> T.StructType:
    """Narrow ``schema`` to some top-level fields and, per array field, some nested ones.

    A JSON scan prunes unused top-level columns by itself but parses every
    declared nested field, so a narrow declaration is what saves the work.
    """
    fields = []
    for name, nested in keep.items():
        f = schema[name]
        if nested is not None:
            element = f.dataType.elementType
            f = T.StructField(name, T.ArrayType(T.StructType([element[n] for n in nested])))
        fields.append(f)
    return T.StructType(fields)


# Fields the raw profile looks at (no operator, timetable type or track).
PROFILE_TRAINS = subset(
    TRAINS,
    {
        "departureDate": None,
        "trainNumber": None,
        "trainType": None,
        "trainCategory": None,
        "commuterLineID": None,
        "cancelled": None,
        "timeTableRows": [
            "stationShortCode",
            "type",
            "trainStopping",
            "commercialStop",
            "cancelled",
            "scheduledTime",
            "actualTime",
            "differenceInMinutes",
            "causes",
        ],
    },
)
