"""Analysis and profile answers against brute force in plain Python."""

import datetime as dt
import statistics

import pytest
from conftest import days
from pyspark.sql import functions as F
from stopwise import Settings
from stopwise.operators import analysis as ana
from stopwise.operators import profiling as prf
from stopwise.plans.reports import findings, profile, write_report
from stopwise.storage import fresh_dir

SMALL = Settings(min_arrivals=2, category_min_arrivals=0, quiet_hour_min_arrivals=0)


@pytest.fixture(scope="module")
def star(warehouse):
    return ana.Star.of(warehouse)


def _base():
    """(train, row) pairs of realised, plausible arrivals of a typed train."""
    return [
        (t, r)
        for trains in days().values()
        for t in trains
        for r in t["timeTableRows"]
        if r["type"] == "ARRIVAL"
        and r.get("actualTime")
        and (r.get("differenceInMinutes") is None or -60 <= r["differenceInMinutes"] <= 1440)
        and t["trainType"]
    ]


def _delays():
    return [r["differenceInMinutes"] for _, r in _base()]


def test_network_totals(star):
    got = ana.network_totals(star).first()
    delays = _delays()
    assert got["n"] == len(delays)
    assert got["avg_delay"] == pytest.approx(statistics.mean(delays))
    assert got["on_time_rate"] == pytest.approx(sum(d < 5 for d in delays) / len(delays))


def test_ranking_orders_by_rate_and_respects_the_floor(star):
    got = ana.station_ranking(star, SMALL).collect()
    assert [r["code"] for r in got] == ["TPE", "HKI", "PSL"]
    assert got[0]["name"] == "Station TPE"
    assert ana.stations_below_floor(star, SMALL).first()[0] == 0
    assert ana.distinct_stations(star).first()[0] == 3


def test_hours_follow_the_zone_not_the_session(star):
    fixed = {r["hour"]: r["n"] for r in ana.by_fixed_offset_hour(star).collect()}
    local = {r["hour"]: r["n"] for r in ana.by_zone_hour(star).collect()}
    assert fixed[5] == 1  # 02:30 UTC plus three
    assert local[4] == 1  # March 10 is still winter time in Helsinki
    assert sum(fixed.values()) == sum(local.values()) == len(_base())


def test_hour_extremes(star):
    got = {r["kind"]: r["hour"] for r in ana.hour_extremes(star, SMALL).collect()}
    assert got == {"peak": 11, "quietest": 10}


def test_causes_full_and_split_minutes(star):
    full = {r["code"]: r for r in ana.causes(star).collect()}
    assert {c: r["total_min"] for c, r in full.items()} == {"L": 9, "E": 9, "UNKNOWN": 0}
    split = {r["code"]: r["split_min"] for r in ana.causes_equal_split(star).collect()}
    assert split == {"L": 4.5, "E": 4.5, "UNKNOWN": 0.0}
    assert ana.coded_events(star).first()[0] == 3


def test_top_causes_are_labelled(star):
    got = [(r["ranking"], r["code"], r["label"]) for r in ana.top_causes(star).collect()]
    assert ("minutes", "E", "Running ahead of schedule") in got
    assert ("frequency", "UNKNOWN", "Unknown / unmapped cause") in got
    assert len([g for g in got if g[0] == "minutes"]) == 2


def test_categories(star):
    got = {r["train_category"]: r for r in ana.by_category(star, SMALL).collect()}
    long = [r["differenceInMinutes"] for t, r in _base() if t["trainCategory"]]
    assert got["Long-distance"]["n"] == len(long)
    assert got["Long-distance"]["avg_delay"] == pytest.approx(statistics.mean(long))
    cuts = statistics.quantiles(long, n=10, method="inclusive")
    assert got["Long-distance"]["p90"] == pytest.approx(cuts[8])


def test_progression_counts_positions_per_date(star):
    got = ana.delay_progression(star, 1).collect()
    assert [(r["seq"], r["scode"], r["avg_delay"], r["n"]) for r in got] == [
        (1, "PSL", 5.0, 2),
        (2, "TPE", 6.0, 2),
        (3, "TPE", 5.0, 1),
    ]
    ends = ana.progression_extremes(ana.delay_progression(star, 1), "TPE").first()
    assert (ends["early_peak"], ends["size_at_stop"], ends["peak"], ends["last"]) == (6, 6, 6, 5)
    stations = ana.station_progression(star, 1).collect()
    assert [(r["scode"], r["n"]) for r in stations] == [("PSL", 2), ("TPE", 3)]


def test_days_and_weekend(star):
    trend = {r["date"]: r["n"] for r in ana.daily_trend(star).collect()}
    assert trend == {dt.date(2024, 3, 10): 5, dt.date(2024, 3, 12): 2}
    kinds = {r["is_weekend"]: r["n"] for r in ana.weekday_weekend(star).collect()}
    assert kinds == {True: 5, False: 2}
    extremes = {r["kind"]: r["date"].day for r in ana.day_extremes(star).collect()}
    assert extremes == {"worst": 10, "best": 12}


def test_histogram_and_tails_cover_the_base(star):
    bins = {r["delay_minutes"]: r["n"] for r in ana.delay_histogram(star).collect()}
    assert sorted(bins) == list(range(-8, 14))
    tails = ana.delay_tails(star).first()
    assert sum(bins.values()) + tails["above"] + tails["below"] == tails["n"] == len(_base())
    assert tails["max_delay"] == 1440


def test_quantiles(star):
    got = ana.delay_quantiles(star).first()
    assert got["median_delay"] == statistics.median(_delays())
    cuts = statistics.quantiles(_delays(), n=20, method="inclusive")
    assert got["p95_delay"] == pytest.approx(cuts[18])


def test_a_visit_counts_once_for_arrival_and_departure(star):
    events = {
        r["station_short_code"]: r["events"]
        for r in ana.busiest_by_events(star, ana.PASSENGER).collect()
    }
    visits = {
        r["station_short_code"]: r["visit_count"]
        for r in ana.busiest_by_visits(star, ana.PASSENGER).collect()
    }
    assert events["PSL"] == 3 and visits["PSL"] == 2
    assert events["HKI"] == 2 and visits["HKI"] == 2
    assert all(visits[c] <= events[c] for c in visits)


def test_excluding_cancelled_is_a_parameter(star):
    assert ana.arrivals(star).count() >= ana.arrivals(star, exclude_cancelled=True).count()


def test_scope_and_days_of_the_profile(sources):
    trains = prf.raw_trains(sources.documents)
    got = prf.scope(trains).first()
    assert (got["trains"], got["events"], got["days"]) == (5, 14, 2)
    per_day = {r["ingest_date"].day: r for r in prf.trains_per_day(trains).collect()}
    assert (per_day[10]["trains"], per_day[10]["cancelled"]) == (4, 1)
    assert per_day[10]["day_name"] == "Sunday" and per_day[10]["is_weekend"]
    means = prf.mean_trains_by_day_kind(trains).collect()
    assert {r["is_weekend"]: r["mean_trains"] for r in means} == {True: 4.0, False: 1.0}


def test_profile_of_missing_and_extreme_values(sources):
    trains = prf.raw_trains(sources.documents)
    events = prf.raw_events(trains)
    assert prf.missing_actual_count(events).first()["no_actual_time"] == 2
    assert prf.missing_delay_count(events).first()[0] == 2
    sides = prf.extreme_delays(events, 1).collect()
    assert {r["side"]: r["difference_in_minutes"] for r in sides} == {"late": 1441, "early": -61}
    stats = prf.delay_distribution(events).first()["stats"]
    delays = [
        r["differenceInMinutes"]
        for ts in days().values()
        for t in ts
        for r in t["timeTableRows"]
        if r.get("differenceInMinutes") is not None
    ]
    assert (stats["min"], stats["max"]) == (min(delays), max(delays))
    assert stats["median"] == statistics.median(delays)
    cancelled = prf.cancelled_trains(trains).first()
    assert tuple(cancelled) == (1, 1, 0)


def test_profile_of_midnight_and_unmatched_stations(sources):
    trains = prf.raw_trains(sources.documents)
    events = prf.raw_events(trains)
    assert tuple(prf.midnight_trains(events).first()) == (1, 1)
    missing = prf.unmatched_stations(events, sources.stations).collect()
    assert [tuple(r) for r in missing] == [("XXX", 1)]
    assert prf.duplicate_train_count(trains).first()[0] == 0
    assert prf.last_day(sources.documents) == dt.date(2024, 3, 12)
    breakdown = prf.missing_actual_breakdown(events, dt.date(2024, 3, 12)).collect()
    assert {(r["train_cancelled"], r["after_last_day"], r["n"]) for r in breakdown} == {
        (False, False, 1),
        (True, False, 1),
    }


def test_reports_are_written_as_tables(spark, warehouse):
    root = fresh_dir(spark, "reports")
    found = write_report(warehouse, findings, f"{root}/findings")
    profiled = write_report(warehouse, profile, f"{root}/profile")
    assert found["network_totals"].first()["n"] == len(_base())
    assert profiled["scope"].first()["trains"] == 5
    assert spark.read.parquet(f"{root}/findings/causes").agg(F.sum("freq")).first()[0] == 3
    assert len(found) == 29 and len(profiled) == 22
    # What was written is what the questions answer, value by value.
    for name, answer in {**findings(warehouse), **profile(warehouse)}.items():
        table = {**found, **profiled}[name]
        assert sorted(map(repr, table.collect())) == sorted(map(repr, answer.collect())), name
