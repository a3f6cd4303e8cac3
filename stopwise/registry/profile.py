"""The raw-layer profile: PRF-*."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import round_half_away
from stopwise.operators import profiling as prf
from stopwise.registry.sample import Sample
from stopwise.registry.sql import over


def _distribution(s: Sample) -> DataFrame:
    stats = prf.delay_distribution(s.raw_events).select("stats.*")
    return stats.withColumns({c: round_half_away(F.col(c), 6) for c in prf.QUANTILES})


def _missing_breakdown(s: Sample) -> DataFrame:
    return prf.missing_actual_breakdown(s.raw_events, prf.last_day(s.documents))


def _unexplained(s: Sample) -> DataFrame:
    staged = s.warehouse.stg_timetable_events
    return prf.unexplained_missing_actual(staged, prf.last_day(s.documents))


def _relation_counts(s: Sample) -> DataFrame:
    w = s.warehouse
    names = (
        "dim_station",
        "dim_date",
        "dim_train_type",
        "dim_cause",
        "fct_timetable_events",
        "fct_delay_causes",
        "agg_station_punctuality",
    )
    return prf.relation_counts({n: getattr(w, n) for n in names})


def _unknown_members(s: Sample) -> DataFrame:
    return prf.unknown_member_rows(
        s.warehouse.fct_timetable_events, s.warehouse.fct_delay_causes
    )


QUERIES = {
    "prf_1_raw_trains": lambda s: s.raw_trains.withColumn(
        "n_rows", prf.row_count(s.raw_trains)
    ).drop("timetable_rows"),
    "prf_2_raw_events": lambda s: s.raw_events,
    "prf_3_scope": lambda s: prf.scope(s.raw_trains),
    "prf_4_trains_per_day": lambda s: prf.trains_per_day(s.raw_trains),
    "prf_5_mean_trains": lambda s: prf.mean_trains_by_day_kind(s.raw_trains),
    "prf_6_duplicate_trains": lambda s: prf.duplicate_train_count(s.raw_trains),
    "prf_7_duplicate_samples": lambda s: prf.duplicate_train_samples(s.raw_trains),
    "prf_8_missing_actual": lambda s: prf.missing_actual_count(s.raw_events),
    "prf_9_missing_breakdown": _missing_breakdown,
    "prf_10_delay_distribution": _distribution,
    "prf_11_missing_delay": lambda s: prf.missing_delay_count(s.raw_events),
    "prf_12_extreme_delays": lambda s: prf.extreme_delays(s.raw_events),
    "prf_13_cancelled_trains": lambda s: prf.cancelled_trains(s.raw_trains),
    "prf_14_cause_counts": lambda s: prf.cause_count_distribution(s.raw_events),
    "prf_15_train_types": lambda s: prf.frequency(s.raw_trains, "train_type"),
    "prf_15_train_categories": lambda s: prf.frequency(s.raw_trains, "train_category"),
    "prf_16_unmatched_stations": lambda s: prf.unmatched_stations(
        s.raw_events, s.warehouse.sources.stations
    ),
    "prf_17_midnight_trains": lambda s: prf.midnight_trains(s.raw_events),
    "prf_18_unexplained_missing": _unexplained,
    "prf_19_delay_without_actual": lambda s: prf.delay_without_actual(s.raw_events),
    "prf_20_cause_codes": lambda s: prf.cause_code_frequency(s.warehouse.stg_delay_causes),
    "prf_20_late_with_cause": lambda s: prf.late_events_with_cause(s.raw_events, s.settings),
    "prf_21_relation_counts": _relation_counts,
    "prf_21_unknown_members": _unknown_members,
}

_DOCS = """
docs AS (
  SELECT ingest_date, departure_date, train_number, train_type, train_category,
         commuter_line_id, train_cancelled, slice, count(*) AS n_rows,
         count(actual_time) AS n_actual
  FROM raw GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
)
"""

_DUPLICATES = """
dup AS (
  SELECT departure_date, train_number, count(*) AS documents
  FROM docs GROUP BY 1, 2 HAVING count(*) > 1
)
"""

_QUANTILES = ", ".join(
    f"round(quantile_cont(difference_in_minutes, {p}), 6) AS {name}"
    for name, p in {
        "p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5,
        "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99,
    }.items()
)

_EXTREME = """departure_date, train_number, train_type, station_short_code, event_type,
       difference_in_minutes"""

_TIE = "departure_date, train_number, station_short_code, event_type, scheduled_time"

ORACLES = {
    "prf_1_raw_trains": over(
        """
        SELECT ingest_date, departure_date, train_number, train_type, train_category,
               commuter_line_id, train_cancelled, n_rows
        FROM docs
        """,
        _DOCS,
    ),
    "prf_2_raw_events": over(
        """
        SELECT ingest_date, departure_date, train_number, train_type, train_category,
               commuter_line_id, train_cancelled, station_short_code, event_type,
               train_stopping, commercial_stop, row_cancelled, scheduled_time, actual_time,
               difference_in_minutes, n_causes
        FROM raw
        """
    ),
    "prf_3_scope": over(
        """
        SELECT count(*) AS trains, CAST(sum(n_rows) AS BIGINT) AS events,
               count(DISTINCT ingest_date) AS days, min(ingest_date) AS first_day,
               max(ingest_date) AS last_day
        FROM docs
        """,
        _DOCS,
    ),
    "prf_4_trains_per_day": over(
        """
        SELECT ingest_date, dayname(ingest_date) AS day_name,
               dayofweek(ingest_date) IN (0, 6) AS is_weekend, count(*) AS trains,
               CAST(sum(n_rows) AS BIGINT) AS events,
               CAST(sum(CAST(train_cancelled AS INTEGER)) AS BIGINT) AS cancelled
        FROM docs GROUP BY 1, 2, 3
        """,
        _DOCS,
    ),
    "prf_5_mean_trains": over(
        """
        SELECT dayofweek(ingest_date) IN (0, 6) AS is_weekend, round(avg(c), 0) AS mean_trains
        FROM (SELECT ingest_date, count(*) AS c FROM docs GROUP BY 1) GROUP BY 1
        """,
        _DOCS,
    ),
    "prf_6_duplicate_trains": over(
        "SELECT count(*) AS duplicate_pairs FROM dup", _DOCS, _DUPLICATES
    ),
    "prf_7_duplicate_samples": over(
        "SELECT * FROM dup ORDER BY documents DESC, departure_date, train_number LIMIT 5",
        _DOCS,
        _DUPLICATES,
    ),
    "prf_8_missing_actual": over(
        """
        SELECT count(*) AS events, count(*) FILTER (WHERE actual_time IS NULL) AS no_actual_time
        FROM raw
        """
    ),
    "prf_9_missing_breakdown": over(
        """
        SELECT train_cancelled, row_cancelled,
               scheduled_time > (SELECT max(ingest_date) FROM raw) AS after_last_day,
               count(*) AS n
        FROM raw WHERE actual_time IS NULL GROUP BY 1, 2, 3
        """
    ),
    "prf_10_delay_distribution": over(
        f"""
        SELECT min(difference_in_minutes) AS min, {_QUANTILES},
               max(difference_in_minutes) AS max
        FROM raw
        """
    ),
    "prf_11_missing_delay": over(
        "SELECT count(*) AS no_difference FROM raw WHERE difference_in_minutes IS NULL"
    ),
    "prf_12_extreme_delays": over(
        f"""
        SELECT {_EXTREME}, 'late' AS side FROM (
          SELECT * FROM raw ORDER BY difference_in_minutes DESC NULLS LAST, {_TIE} LIMIT 5)
        UNION ALL
        SELECT {_EXTREME}, 'early' FROM (
          SELECT * FROM raw ORDER BY difference_in_minutes ASC NULLS LAST, {_TIE} LIMIT 5)
        """
    ),
    "prf_13_cancelled_trains": over(
        """
        SELECT count(*) AS cancelled_trains,
               CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS events,
               CAST(coalesce(sum(n_actual), 0) AS BIGINT) AS events_with_actual
        FROM docs WHERE train_cancelled
        """,
        _DOCS,
    ),
    "prf_14_cause_counts": over(
        "SELECT n_causes, count(*) AS n FROM raw WHERE n_causes > 0 GROUP BY 1"
    ),
    "prf_15_train_types": over("SELECT train_type, count(*) AS n FROM docs GROUP BY 1", _DOCS),
    "prf_15_train_categories": over(
        "SELECT train_category, count(*) AS n FROM docs GROUP BY 1", _DOCS
    ),
    "prf_16_unmatched_stations": over(
        """
        SELECT r.station_short_code, count(*) AS n
        FROM raw r LEFT JOIN stations s ON s.station_short_code = r.station_short_code
        WHERE s.station_short_code IS NULL GROUP BY 1
        """
    ),
    "prf_17_midnight_trains": over(
        """
        SELECT (SELECT count(*) FROM (
                  SELECT train_number, departure_date FROM raw GROUP BY 1, 2
                  HAVING count(DISTINCT CAST(scheduled_time AS DATE)) > 1)) AS spanning_trains,
               (SELECT count(*) FROM raw
                WHERE CAST(scheduled_time AS DATE) <> departure_date) AS off_date_events
        """
    ),
    "prf_18_unexplained_missing": over(
        """
        SELECT is_stopping, count(*) AS n FROM stg
        WHERE NOT is_cancelled AND NOT has_actual_time
          AND departure_date < (SELECT max(source_ingest_date) FROM stg)
        GROUP BY 1
        """
    ),
    "prf_19_delay_without_actual": over(
        """
        SELECT count(*) FILTER (WHERE actual_time IS NULL AND difference_in_minutes IS NOT NULL)
                 AS delay_without_actual,
               count(*) FILTER (WHERE actual_time IS NOT NULL AND difference_in_minutes IS NULL)
                 AS actual_without_delay
        FROM raw
        """
    ),
    "prf_20_cause_codes": over(
        "SELECT cause_category_code, count(*) AS n FROM cause_rows GROUP BY 1"
    ),
    "prf_20_late_with_cause": over(
        """
        SELECT count(*) AS late_events, count(*) FILTER (WHERE n_causes > 0) AS with_cause
        FROM raw WHERE difference_in_minutes >= 5
        """
    ),
    "prf_21_relation_counts": over(
        """
        SELECT 'dim_station' AS relation, count(*) AS n FROM dim_station
        UNION ALL SELECT 'dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'dim_train_type', count(*) FROM dim_train_type
        UNION ALL SELECT 'dim_cause', count(*) FROM dim_cause
        UNION ALL SELECT 'fct_timetable_events', count(*) FROM fct
        UNION ALL SELECT 'fct_delay_causes', count(*) FROM fct_causes
        UNION ALL SELECT 'agg_station_punctuality', count(*) FROM punctuality
        """
    ),
    "prf_21_unknown_members": over(
        """
        SELECT 'station' AS member, count(*) AS n FROM fct WHERE station_key = -1
        UNION ALL SELECT 'cause', count(*) FROM fct_causes WHERE cause_key = -1
        """
    ),
}
