"""The same operators over orders and line items, and the scalar functions on their dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import calendar_columns, round_half_away
from stopwise.operators import quality
from stopwise.operators.staging import add_flags, flatten_rows
from stopwise.registry.sample import Sample


def _empty_documents(s: Sample) -> DataFrame:
    return s.volume_documents.groupBy(
        F.size("timeTableRows.type").cast("bigint").alias("n_rows")
    ).agg(F.count("*").alias("documents"))


def _flatten(s: Sample) -> DataFrame:
    rows = add_flags(flatten_rows(s.volume_documents), s.settings)
    return rows.groupBy("station_short_code", "event_type", "is_plausible_delay").agg(
        F.count("*").alias("n"), F.sum("delay_minutes").alias("minutes")
    )


def _key_counts(s: Sample) -> DataFrame:
    duplicates = quality.unique(s.volume_events, "event_key")
    return duplicates.agg(
        F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    )


def _calendar(s: Sample) -> DataFrame:
    columns = calendar_columns(F.to_date("o_orderdate"))
    return s.given("orders").select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


def _rounding(s: Sample) -> DataFrame:
    ratio = F.col("l_tax") * F.col("l_quantity") - F.col("l_discount") * F.col("l_linenumber")
    return s.given("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        round_half_away(ratio, 2).alias("rounded_2"),
        round_half_away(ratio, 4).alias("rounded_4"),
    )


QUERIES = {
    "vol_stg_2_documents_by_rows": _empty_documents,
    "vol_stg_7_flatten": _flatten,
    "vol_dq_1_duplicate_event_keys": _key_counts,
    "fn_calendar": _calendar,
    "fn_round_half_away": _rounding,
}

ORACLES = {
    "vol_stg_2_documents_by_rows": """
        SELECT coalesce(n, 0) AS n_rows, count(*) AS documents
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem
                               GROUP BY l_orderkey, l_partkey // 2048) ON l_orderkey = o_orderkey
        GROUP BY 1
    """,
    "vol_stg_7_flatten": """
        SELECT 'S' || l_suppkey AS station_short_code,
               CASE l_linestatus WHEN 'O' THEN 'ARRIVAL' ELSE 'DEPARTURE' END AS event_type,
               true AS is_plausible_delay, count(*) AS n,
               CAST(sum(CAST(l_quantity AS BIGINT) - 20) AS BIGINT) AS minutes
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2
    """,
    "vol_dq_1_duplicate_event_keys": """
        SELECT count(*) AS keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
        FROM (SELECT count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
              GROUP BY o_orderkey, l_suppkey, l_linestatus, l_shipdate HAVING count(*) > 1)
    """,
    "fn_calendar": """
        SELECT o_orderkey, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
               CAST(dayofweek(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend, CAST(month(d) AS BIGINT) AS month,
               CAST(year(d) AS BIGINT) AS year, CAST(week(d) AS BIGINT) AS week_of_year
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
    "fn_round_half_away": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               round(l_tax * l_quantity - l_discount * l_linenumber, 2) AS rounded_2,
               round(l_tax * l_quantity - l_discount * l_linenumber, 4) AS rounded_4
        FROM lineitem
    """,
}
