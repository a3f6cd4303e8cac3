"""Facts, the punctuality aggregate and the checks: FCT-*, AGG-*, DQ-*."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators import facts, punctuality, quality
from stopwise.plans.checks import EVENT_TYPES, check_results, declared_checks
from stopwise.registry.sample import Sample
from stopwise.registry.sql import over

OTHER_THRESHOLD = 3


def _station_lookup(s: Sample) -> DataFrame:
    found = facts.lookup_station(s.warehouse.stg_timetable_events, s.warehouse.dim_station)
    return found.select("event_key", "station_short_code", "station_key")


def _train_type_lookup(s: Sample) -> DataFrame:
    found = facts.lookup_train_type(
        s.warehouse.stg_timetable_events, s.warehouse.dim_train_type
    )
    return found.select("event_key", "train_type", "train_category", "train_type_key")


def _date_lookup(s: Sample) -> DataFrame:
    found = facts.lookup_date(s.warehouse.stg_timetable_events, s.warehouse.dim_date)
    return found.select("event_key", "departure_date", "date_key")


def _fact_events(s: Sample) -> DataFrame:
    w = s.warehouse
    return facts.timetable_events(
        w.stg_timetable_events, w.dim_station, w.dim_train_type, w.dim_date
    )


def _fact_causes(s: Sample) -> DataFrame:
    w = s.warehouse
    return facts.delay_causes(w.stg_delay_causes, w.fct_timetable_events, w.dim_cause).select(
        facts.CAUSE_COLUMNS
    )


def _known_causes(s: Sample) -> DataFrame:
    known = facts.known_causes(s.warehouse.stg_delay_causes, s.warehouse.fct_timetable_events)
    return known.select("event_key", "cause_seq", "cause_category_code")


def _cause_lookup(s: Sample) -> DataFrame:
    return (
        s.warehouse.fct_delay_causes.groupBy("cause_key", "cause_category_code")
        .agg(F.count("*").alias("n"))
    )


def _pooled_by_station(s: Sample) -> DataFrame:
    return punctuality.pooled_punctuality(s.warehouse.agg_station_punctuality, "station_key")


def _pooled_network(s: Sample) -> DataFrame:
    return punctuality.pooled_punctuality(s.warehouse.agg_station_punctuality)


def _duplicate_line_items(s: Sample) -> DataFrame:
    return quality.unique(s.given("lineitem"), "l_orderkey")


def _missing_tracks(s: Sample) -> DataFrame:
    return quality.not_null(s.warehouse.stg_timetable_events, "commercial_track").select(
        "event_key", "station_short_code"
    )


def _other_categories(s: Sample) -> DataFrame:
    return quality.accepted_values(
        s.warehouse.stg_timetable_events, "train_category", ("Commuter", "Long-distance")
    )


def _unmapped_causes(s: Sample) -> DataFrame:
    w = s.warehouse
    return quality.relationships(
        w.fct_delay_causes, "cause_category_code", w.dim_cause, "cause_category_code"
    ).select("event_key", "cause_seq", "cause_category_code")


def _early(s: Sample) -> DataFrame:
    return quality.implausibly_early(s.warehouse.fct_timetable_events, s.settings)


def _implausible(s: Sample) -> DataFrame:
    return quality.implausible_delay(s.warehouse.fct_timetable_events, s.settings)


def _counts(s: Sample) -> DataFrame:
    w = s.warehouse
    return quality.count_comparison(w.stg_timetable_events, w.fct_timetable_events)


def _mismatch_against_arrivals(s: Sample) -> DataFrame:
    arrivals = s.warehouse.fct_timetable_events.filter(F.col("event_type") == EVENT_TYPES[0])
    return quality.count_mismatch(s.warehouse.stg_timetable_events, arrivals)


def _orphans(s: Sample) -> DataFrame:
    return quality.orphan_stations(s.warehouse.stg_timetable_events, s.warehouse.dim_station)


def _all_checks(s: Sample) -> DataFrame:
    checks = [c for stage in declared_checks().values() for c in stage]
    return check_results(checks, s.warehouse)


def _other_threshold(s: Sample) -> DataFrame:
    """Punctuality at another threshold, from the stored counts."""
    settings = replace(s.settings, on_time_minutes=OTHER_THRESHOLD)
    return punctuality.punctuality_of_counts(s.warehouse.delay_counts, settings).select(
        "station_key", "date_key", "scheduled_arrivals", "on_time_events", "on_time_rate", "median_delay_minutes"
    )


QUERIES = {
    "fct_1_station_lookup": _station_lookup,
    "fct_2_train_type_lookup": _train_type_lookup,
    "fct_3_date_lookup": _date_lookup,
    "fct_4_timetable_events": _fact_events,
    "fct_5_known_causes": _known_causes,
    "fct_6_cause_lookup": _cause_lookup,
    "fct_7_delay_causes": _fact_causes,
    "agg_1_station_punctuality": lambda s: punctuality.station_punctuality(
        s.warehouse.fct_timetable_events, s.settings
    ),
    "agg_1_from_counts": _other_threshold,
    "agg_2_pooled_by_station": _pooled_by_station,
    "agg_2_pooled_network": _pooled_network,
    "dq_1_unique": _duplicate_line_items,
    "dq_2_not_null": _missing_tracks,
    "dq_3_accepted_values": _other_categories,
    "dq_4_relationships": _unmapped_causes,
    "dq_5_implausibly_early": _early,
    "dq_6_implausible_delay": _implausible,
    "dq_7_count_comparison": _counts,
    "dq_7_count_mismatch": _mismatch_against_arrivals,
    "dq_8_orphan_stations": _orphans,
    "dq_9_all_checks": _all_checks,
}

_POOLED = """
SELECT {keys} CAST(sum(scheduled_arrivals) AS BIGINT) AS scheduled_arrivals,
       CAST(sum(cancelled_arrivals) AS BIGINT) AS cancelled_arrivals,
       CAST(sum(measured_arrivals) AS BIGINT) AS measured_arrivals,
       CAST(sum(on_time_events) AS BIGINT) AS on_time_events,
       max(worst_delay_minutes) AS worst_delay_minutes,
       round(sum(on_time_events) / nullif(sum(measured_arrivals), 0), 4) AS on_time_rate
FROM punctuality {tail}
"""

# Violations found in the given tables; every other declared check finds none.
_VIOLATIONS = {
    "orphan_stations_stg_timetable_events": """
        (SELECT count(DISTINCT station_short_code) FROM stg
         WHERE station_short_code NOT IN (SELECT station_short_code FROM dim_station))
    """,
    "relationships_fct_delay_causes_cause_category_code": """
        (SELECT count(*) FROM fct_causes
         WHERE cause_category_code NOT IN (SELECT cause_category_code FROM dim_cause))
    """,
    "implausibly_early_fct_timetable_events": """
        (SELECT count(*) FROM fct WHERE has_actual_time AND NOT is_cancelled
         AND is_commercial_stop AND delay_minutes < -60)
    """,
    "implausible_delay_fct_timetable_events": """
        (SELECT count(*) FROM fct WHERE delay_minutes < -60 OR delay_minutes > 1440)
    """,
}


def _unique_sql(relation: str, column: str) -> str:
    return f"""
        (SELECT count(*) FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL
                               GROUP BY 1 HAVING count(*) > 1))
    """


def _not_null_sql(relation: str, column: str) -> str:
    return f"(SELECT count(*) FROM {relation} WHERE {column} IS NULL)"


def _accepted_sql(relation: str, column: str) -> str:
    return f"""
        (SELECT count(DISTINCT {column}) FROM {relation}
         WHERE {column} NOT IN ('ARRIVAL', 'DEPARTURE'))
    """


def _relationship_sql(relation: str, column: str, parent: str, field: str) -> str:
    return f"""
        (SELECT count(*) FROM {relation} c LEFT JOIN (SELECT DISTINCT {field} AS f FROM {parent}) p
           ON p.f = c.{column} WHERE c.{column} IS NOT NULL AND p.f IS NULL)
    """


# Names of the oracle's relations for the built ones.
_SQL_NAME = {
    "stg_timetable_events": "stg",
    "stg_delay_causes": "cause_rows",
    "stg_stations": "stations",
    "stg_cause_codes": "cause_codes",
    "stg_cause_codes_detailed": "detailed_codes",
    "fct_timetable_events": "fct",
    "fct_delay_causes": "fct_causes",
    "agg_station_punctuality": "punctuality",
}


# Every check that must be run, spelled out: one dropped from the code is missed here.
_CHECKS = """
    unique stg_timetable_events.event_key
    not_null stg_timetable_events.event_key
    accepted_values stg_timetable_events.event_type
    not_null stg_timetable_events.departure_date
    not_null stg_timetable_events.station_short_code
    not_null stg_delay_causes.event_key
    not_null stg_delay_causes.cause_category_code
    not_null stg_delay_causes.cause_seq
    unique stg_stations.station_short_code
    not_null stg_stations.station_short_code
    unique stg_cause_codes.cause_category_code
    not_null stg_cause_codes.cause_category_code
    unique stg_cause_codes_detailed.detailed_cause_category_code
    not_null stg_cause_codes_detailed.detailed_cause_category_code
    unique dim_station.station_key
    not_null dim_station.station_key
    unique dim_station.station_short_code
    not_null dim_station.station_short_code
    unique dim_date.date_key
    not_null dim_date.date_key
    unique dim_date.date
    not_null dim_date.date
    unique dim_train_type.train_type_key
    not_null dim_train_type.train_type_key
    unique dim_cause.cause_key
    not_null dim_cause.cause_key
    unique dim_cause.cause_category_code
    not_null dim_cause.cause_category_code
    orphan_stations stg_timetable_events
    unique fct_timetable_events.event_key
    not_null fct_timetable_events.event_key
    not_null fct_timetable_events.station_key
    relationships fct_timetable_events.station_key -> dim_station.station_key
    not_null fct_timetable_events.date_key
    relationships fct_timetable_events.date_key -> dim_date.date_key
    relationships fct_timetable_events.train_type_key -> dim_train_type.train_type_key
    accepted_values fct_timetable_events.event_type
    not_null fct_delay_causes.event_key
    relationships fct_delay_causes.event_key -> fct_timetable_events.event_key
    not_null fct_delay_causes.cause_category_code
    relationships fct_delay_causes.cause_category_code -> dim_cause.cause_category_code
    not_null fct_delay_causes.cause_key
    relationships fct_delay_causes.cause_key -> dim_cause.cause_key
    count_mismatch fct_timetable_events
    implausibly_early fct_timetable_events
    implausible_delay fct_timetable_events
    not_null agg_station_punctuality.station_key
    relationships agg_station_punctuality.station_key -> dim_station.station_key
"""


def _check_sql(kind: str, name: str, relation: str, column: str, to: str) -> str:
    if name in _VIOLATIONS:
        return _VIOLATIONS[name]
    relation = _SQL_NAME.get(relation, relation)
    if kind == "unique":
        return _unique_sql(relation, column)
    if kind == "not_null":
        return _not_null_sql(relation, column)
    if kind == "accepted_values":
        return _accepted_sql(relation, column)
    if kind == "relationships":
        parent, field = to.split(".")
        return _relationship_sql(relation, column, _SQL_NAME.get(parent, parent), field)
    return "(SELECT count(*) FROM stg HAVING count(*) <> (SELECT count(*) FROM fct))"


def _all_checks_sql() -> str:
    rows = []
    for line in _CHECKS.strip().splitlines():
        kind, subject, *to = line.replace("->", " ").split()
        relation, _, column = subject.partition(".")
        name = "_".join(p for p in (kind, relation, column) if p)
        severity = "warn" if name in _VIOLATIONS else "error"
        violations = _check_sql(kind, name, relation, column, "".join(to))
        rows.append(
            f"SELECT '{name}' AS check_name, '{severity}' AS severity, "
            f"coalesce({violations}, 0) AS violations"
        )
    return f"""
        SELECT check_name AS "check", severity, violations,
               CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn'
                    ELSE 'fail' END AS status
        FROM ({" UNION ALL ".join(rows)})
    """


ORACLES = {
    "fct_1_station_lookup": over("SELECT event_key, station_short_code, station_key FROM fct"),
    "fct_2_train_type_lookup": over(
        """
        SELECT s.event_key, s.train_type, s.train_category, t.train_type_key
        FROM stg s LEFT JOIN dim_train_type t ON t.train_type = s.train_type
             AND t.train_category IS NOT DISTINCT FROM s.train_category
        """
    ),
    "fct_3_date_lookup": over(
        """
        SELECT s.event_key, s.departure_date, d.date_key
        FROM stg s LEFT JOIN dim_date d ON d.date = s.departure_date
        """
    ),
    "fct_4_timetable_events": over("SELECT * FROM fct"),
    "fct_5_known_causes": over(
        """
        SELECT c.event_key, c.cause_seq, c.cause_category_code
        FROM cause_rows c JOIN stg s ON s.event_key = c.event_key
        """
    ),
    "fct_6_cause_lookup": over(
        "SELECT cause_key, cause_category_code, count(*) AS n FROM fct_causes GROUP BY 1, 2"
    ),
    "fct_7_delay_causes": over("SELECT * EXCLUDE (source_ingest_date) FROM fct_causes"),
    "agg_1_station_punctuality": over("SELECT * FROM punctuality"),
    "agg_1_from_counts": over(
        f"""
        SELECT station_key, date_key, count(*) AS scheduled_arrivals,
               count(*) FILTER (WHERE ok AND delay_minutes < {OTHER_THRESHOLD}) AS on_time_events,
               round(count(*) FILTER (WHERE ok AND delay_minutes < {OTHER_THRESHOLD})
                     / nullif(count(*) FILTER (WHERE ok), 0), 4) AS on_time_rate,
               median(delay_minutes) FILTER (WHERE ok) AS median_delay_minutes
        FROM (SELECT *, has_actual_time AND is_plausible_delay AND NOT is_cancelled AS ok FROM fct
              WHERE event_type = 'ARRIVAL' AND is_commercial_stop)
        GROUP BY 1, 2
        """
    ),
    "agg_2_pooled_by_station": over(_POOLED.format(keys="station_key,", tail="GROUP BY 1")),
    "agg_2_pooled_network": over(_POOLED.format(keys="", tail="")),
    "dq_1_unique": """
        SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1
    """,
    "dq_2_not_null": over(
        "SELECT event_key, station_short_code FROM stg WHERE commercial_track IS NULL"
    ),
    "dq_3_accepted_values": over(
        """
        SELECT train_category, count(*) AS n FROM stg
        WHERE train_category NOT IN ('Commuter', 'Long-distance') GROUP BY 1
        """
    ),
    "dq_4_relationships": over(
        """
        SELECT event_key, cause_seq, cause_category_code FROM fct_causes
        WHERE cause_category_code NOT IN (SELECT cause_category_code FROM dim_cause)
        """
    ),
    "dq_5_implausibly_early": over(
        """
        SELECT event_key, train_number, station_key, event_type, scheduled_time, actual_time,
               delay_minutes
        FROM fct
        WHERE has_actual_time AND NOT is_cancelled AND is_commercial_stop
          AND delay_minutes < -60
        """
    ),
    "dq_6_implausible_delay": over(
        """
        SELECT event_key, train_number, station_key, event_type, delay_minutes
        FROM fct WHERE delay_minutes < -60 OR delay_minutes > 1440
        """
    ),
    "dq_7_count_comparison": over(
        """
        SELECT (SELECT count(*) FROM stg) AS staging_rows,
               (SELECT count(*) FROM fct) AS fact_rows,
               (SELECT count(*) FROM fct) - (SELECT count(*) FROM stg) AS difference
        """
    ),
    "dq_7_count_mismatch": over(
        """
        SELECT count(*) AS staging_rows,
               count(*) FILTER (WHERE event_type = 'ARRIVAL') AS fact_rows,
               -count(*) FILTER (WHERE event_type <> 'ARRIVAL') AS difference
        FROM stg HAVING count(*) FILTER (WHERE event_type <> 'ARRIVAL') <> 0
        """
    ),
    "dq_8_orphan_stations": over(
        """
        SELECT station_short_code, count(*) AS event_count FROM stg
        WHERE station_short_code NOT IN (SELECT station_short_code FROM dim_station)
        GROUP BY 1
        """
    ),
    "dq_9_all_checks": over(_all_checks_sql()),
}
