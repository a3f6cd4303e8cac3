"""The given relational tables, bound to the raw document shape.

``FIXTURES.md`` defines the binding. Documents are cut by event id so that no
array can outgrow ``EVENTS_PER_DOCUMENT`` rows, however busy one train is; a
train may therefore have several documents on one date, as the raw feed allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise import schemas

EVENTS_PER_DOCUMENT = 2048


def _cause(category: Column, detailed: Column, third: Column) -> Column:
    return F.struct(
        category.alias("categoryCode"),
        detailed.alias("detailedCategoryCode"),
        third.alias("thirdCategoryCode"),
    )


def _true_false_null(is_true: Column, is_null: Column) -> Column:
    """A flag whose false rows are partly missing, as in the raw feed."""
    return F.when(is_true, F.lit(True)).when(~is_null, F.lit(False))


def documents_from_events(events: DataFrame) -> DataFrame:
    """Binding E: one document per (train, service date, slice of event ids)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("u"),
        F.col("event_type").alias("kind"),
        "value",
        k.alias("k"),
        F.to_date(F.col("ts") - F.expr("INTERVAL 3 HOURS")).alias("date"),
        F.floor(F.col("event_id") / EVENTS_PER_DOCUMENT).alias("slice"),
    )
    kind, value, kk = F.col("kind"), F.col("value"), F.col("k")
    no_cause = F.array().cast(schemas.TIMETABLE_ROW["causes"].dataType)
    null = F.lit(None).cast("string")
    causes = (
        F.when(kind == "error", F.array(_cause(F.lit("E"), F.lit("E1"), null)))
        .when(
            (kind == "signup") & (value > 50),
            F.array(
                _cause(F.lit("L"), F.lit("L2"), F.lit("L21")),
                _cause(F.lit("T"), F.lit("T1"), null),
            ),
        )
        .otherwise(no_cause)
    )
    delay = (
        F.when((kk % 30 == 0) | (kk % 33 == 5), F.lit(None))
        .when(kk % 17 == 0, F.floor(value / 5) - 70)
        .otherwise(F.floor(value / 10) - 4)
    )
    row = F.struct(
        F.concat(F.lit("S"), kk.cast("string")).alias("stationShortCode"),
        F.when(kind.isin("click", "view", "purchase"), "ARRIVAL")
        .otherwise("DEPARTURE")
        .alias("type"),
        _true_false_null(kk % 5 != 0, kk % 10 == 0).alias("trainStopping"),
        _true_false_null(kk % 4 != 0, kk % 8 == 0).alias("commercialStop"),
        _true_false_null(kk % 25 == 1, kk % 2 == 0).alias("cancelled"),
        F.col("ts").alias("scheduledTime"),
        F.when(kk % 15 != 0, F.col("ts")).alias("actualTime"),
        delay.cast("bigint").alias("differenceInMinutes"),
        F.when(kk % 7 == 0, "").otherwise((kk % 7).cast("string")).alias("commercialTrack"),
        causes.alias("causes"),
    )
    u = F.col("u")
    # Ranging on (date, slice) keeps each output file within few dates, splits a
    # busy date over tasks, and already clusters the grouping below: one shuffle.
    packed = (
        rows.repartitionByRange("date", "slice")
        .groupBy("date", "slice", "u")
        .agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", row.alias("row")))).alias("rs"))
    )
    return packed.select(
        F.col("date").alias("departureDate"),
        u.alias("trainNumber"),
        F.concat(F.lit("OP"), (u % 4).cast("string")).alias("operatorShortCode"),
        F.concat(F.lit("T"), (u % 7).cast("string")).alias("trainType"),
        F.when(u % 3 == 0, "Commuter")
        .when(u % 3 == 1, "Long-distance")
        .otherwise("Cargo")
        .alias("trainCategory"),
        F.when(u % 3 == 0, F.concat(F.lit("R"), (u % 5).cast("string")))
        .otherwise("")
        .alias("commuterLineID"),
        _true_false_null(u % 20 == 0, u % 2 == 0).alias("cancelled"),
        F.when(u % 11 == 0, "ADHOC").otherwise("REGULAR").alias("timetableType"),
        F.col("rs.row").alias("timeTableRows"),
        "date",
        "slice",
    )


def documents_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Binding L: a document per order and slice of part numbers, its line items as an array.

    Line items are packed before they meet their order, so the join sees few rows per order, and
    an order without any keeps an empty array. The slice bounds the array of an order that holds
    most line items.
    """
    no_cause = F.array().cast(schemas.TIMETABLE_ROW["causes"].dataType)
    row = F.struct(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("stationShortCode"),
        F.when(F.col("l_linestatus") == "O", "ARRIVAL").otherwise("DEPARTURE").alias("type"),
        (F.col("l_linenumber") % 5 != 0).alias("trainStopping"),
        (F.col("l_linenumber") % 4 != 0).alias("commercialStop"),
        (F.col("l_returnflag") == "R").alias("cancelled"),
        F.col("l_shipdate").alias("scheduledTime"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("actualTime"),
        (F.col("l_quantity").cast("bigint") - 20).alias("differenceInMinutes"),
        F.col("l_partkey").cast("string").alias("commercialTrack"),
        no_cause.alias("causes"),
    )
    packed = lineitem.groupBy(
        "l_orderkey", F.floor(F.col("l_partkey") / EVENTS_PER_DOCUMENT).alias("slice")
    ).agg(F.collect_list(row).alias("rows"))
    joined = orders.join(packed, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    rows = F.coalesce("rows", F.array().cast(packed.schema["rows"].dataType))
    return joined.select(
        F.to_date("o_orderdate").alias("departureDate"),
        F.col("o_orderkey").alias("trainNumber"),
        F.lit("OP").alias("operatorShortCode"),
        F.col("o_orderpriority").alias("trainType"),
        F.col("o_orderstatus").alias("trainCategory"),
        F.lit("").alias("commuterLineID"),
        F.lit(False).alias("cancelled"),
        F.lit("REGULAR").alias("timetableType"),
        rows.alias("timeTableRows"),
        F.to_date("o_orderdate").alias("date"),
    )


def stations_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Station metadata; every tenth supplier is left out, so its code is an orphan."""
    n = F.col("s_suppkey")
    return supplier.filter(n % 10 != 7).select(
        F.concat(F.lit("S"), n.cast("string")).alias("stationShortCode"),
        F.col("s_name").alias("stationName"),
        (n + 1000).alias("stationUICCode"),
        F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("countryCode"),
        (F.col("s_acctbal") / 200).alias("latitude"),
        (n * F.lit(0.25)).alias("longitude"),
        _true_false_null(n % 3 == 0, n % 3 == 2).alias("passengerTraffic"),
        F.when(n % 3 == 0, "STATION").otherwise("STOPPING_POINT").alias("type"),
    )


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", r"([0-9]+)", 1).cast("int")


def cause_codes_from_parts(part: DataFrame) -> DataFrame:
    """Cause categories: a letter per part brand; some brands are left out."""
    brands = part.groupBy(_brand_number().alias("n")).agg(F.min("p_size").alias("days"))
    return brands.filter(F.col("n") % 10 != 2).select(
        F.char(F.col("n") + 64).alias("categoryCode"),
        F.concat(F.lit("Brand "), F.col("n").cast("string")).alias("categoryName"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("days")).alias("validFrom"),
    )


def detailed_cause_codes_from_parts(part: DataFrame) -> DataFrame:
    """Detailed cause codes: the brand's letter followed by the part number."""
    return part.select(
        F.concat(F.char(_brand_number() + 64), F.col("p_partkey").cast("string")).alias(
            "detailedCategoryCode"
        ),
        F.col("p_name").alias("detailedCategoryName"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).alias("validFrom"),
    )


def as_landed(documents: DataFrame) -> DataFrame:
    """Documents with dates and times spelled as in the feed (UTC, trailing Z)."""

    def utc_text(time: Column) -> Column:
        return F.concat(F.translate(time.cast("string"), " ", "T"), F.lit("Z"))

    rows = F.transform(
        "timeTableRows",
        lambda r: r.withField("scheduledTime", utc_text(r["scheduledTime"])).withField(
            "actualTime", utc_text(r["actualTime"])
        ),
    )
    return documents.withColumn("timeTableRows", rows).withColumn(
        "departureDate", F.col("departureDate").cast("string")
    )


def with_faults(arrays: DataFrame) -> DataFrame:
    """Spoil the bodies of some dates: cut short, emptied, or not an array.

    A bare object is the first document of the array.
    """
    day = F.dayofmonth("date")
    body = (
        F.when(day % 10 == 3, F.expr("left(body, length(body) - 20)"))
        .when(day % 10 == 5, F.lit("[]"))
        .when(day % 10 == 7, F.get_json_object("body", "$[0]"))
        .otherwise(F.col("body"))
    )
    return arrays.withColumn("body", body)


def fetches_from_events(events: DataFrame) -> DataFrame:
    """A fetch log: each kind of event is one fetch of its service date."""
    return (
        events.select(
            F.to_date(F.col("ts") - F.expr("INTERVAL 3 HOURS")).alias("date"),
            "event_type",
            "ts",
            F.length("props").cast("bigint").alias("bytes"),
        )
        .groupBy("date", "event_type")
        .agg(
            F.max("ts").alias("fetched_at"),
            F.sum("bytes").alias("response_bytes"),
            F.count("*").alias("num_trains"),
        )
        .select(
            "date",
            "fetched_at",
            "response_bytes",
            (F.col("num_trains") * 3).alias("gz_bytes"),
            "num_trains",
        )
    )
