"""SNK-5. Every question and profile answer as a written result table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from stopwise.operators import analysis as ana
from stopwise.operators import profiling as prf
from stopwise.operators.analysis import CARGO, PASSENGER, Star
from stopwise.plans.warehouse import Warehouse
from stopwise.storage import fresh_dir, save


def findings(warehouse: Warehouse, stop: str = "") -> dict[str, DataFrame]:
    """Answers to the analysis questions, by name.

    Most of them share one population, which is written once. ``stop`` is the station whose
    size the progression extremes report.
    """
    settings = warehouse.settings
    star = Star.of(warehouse).with_stored_base(fresh_dir(warehouse.spark, "arrivals"))
    return {
        "network_totals": ana.network_totals(star, settings),
        "network_totals_without_cancelled": ana.network_totals(
            star, settings, exclude_cancelled=True
        ),
        "station_ranking": ana.station_ranking(star, settings),
        "ranking_extremes": ana.ranking_extremes(star, settings),
        "stations_below_floor": ana.stations_below_floor(star, settings),
        "delay_by_hour": ana.by_fixed_offset_hour(star, settings),
        "distinct_stations": ana.distinct_stations(star),
        "hour_extremes": ana.hour_extremes(star, settings),
        "causes": ana.causes(star),
        "causes_equal_split": ana.causes_equal_split(star),
        "top_causes": ana.top_causes(star),
        "coded_events": ana.coded_events(star),
        "delay_by_local_hour": ana.by_zone_hour(star, settings),
        "train_categories": ana.by_category(star, settings),
        "all_train_categories": ana.by_category(star, settings, floor=-1),
        "delay_progression": ana.delay_progression(star),
        "progression_extremes": ana.progression_extremes(ana.delay_progression(star), stop),
        "station_progression": ana.station_progression(star),
        "daily_trend": ana.daily_trend(star, settings),
        "weekday_weekend": ana.weekday_weekend(star, settings),
        "day_extremes": ana.day_extremes(star, settings),
        "delay_histogram": ana.delay_histogram(star, settings),
        "delay_tails": ana.delay_tails(star, settings),
        "delay_quantiles": ana.delay_quantiles(star),
        "busiest_passenger_events": ana.busiest_by_events(star, PASSENGER),
        "busiest_cargo_events": ana.busiest_by_events(star, CARGO),
        "busiest_passenger_visits": ana.busiest_by_visits(star, PASSENGER),
        "busiest_cargo_visits": ana.busiest_by_visits(star, CARGO),
        "delayed_with_cause": ana.delayed_with_cause(star, settings),
    }


def profile(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The raw-layer profile, by name."""
    trains = prf.raw_trains(warehouse.sources.documents)
    events = prf.raw_events(trains)
    settings, last = warehouse.settings, prf.last_day(warehouse.sources.documents)
    return {
        "scope": prf.scope(trains),
        "trains_per_day": prf.trains_per_day(trains),
        "mean_trains_by_day_kind": prf.mean_trains_by_day_kind(trains),
        "duplicate_trains": prf.duplicate_train_count(trains),
        "duplicate_train_samples": prf.duplicate_train_samples(trains),
        "missing_actual": prf.missing_actual_count(events),
        "missing_actual_breakdown": prf.missing_actual_breakdown(events, last),
        "unexplained_missing_actual": prf.unexplained_missing_actual(
            warehouse.stg_timetable_events, last
        ),
        "delay_without_actual": prf.delay_without_actual(events),
        "cause_codes": prf.cause_code_frequency(warehouse.stg_delay_causes),
        "late_events_with_cause": prf.late_events_with_cause(events, settings),
        "relation_counts": prf.relation_counts(
            {name: getattr(warehouse, name) for name in warehouse.STAR}
        ),
        "unknown_members": prf.unknown_member_rows(
            warehouse.fct_timetable_events, warehouse.fct_delay_causes
        ),
        "delay_distribution": prf.delay_distribution(events).select("stats.*"),
        "missing_delay": prf.missing_delay_count(events),
        "extreme_delays": prf.extreme_delays(events),
        "cancelled_trains": prf.cancelled_trains(trains),
        "cause_count_distribution": prf.cause_count_distribution(events),
        "train_types": prf.frequency(trains, "train_type"),
        "train_categories": prf.frequency(trains, "train_category"),
        "unmatched_stations": prf.unmatched_stations(events, warehouse.sources.stations),
        "midnight_trains": prf.midnight_trains(events),
    }


def write_report(
    warehouse: Warehouse,
    report: Callable[[Warehouse], dict[str, DataFrame]],
    root: str,
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """Write each answer of a report to its own table under ``root``.

    Answers are small and independent, so a few jobs share the cluster at a time.
    """
    answers = report(warehouse)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        tables = pool.map(lambda name: save(answers[name], f"{root}/{name}"), answers)
        return dict(zip(answers, tables))


