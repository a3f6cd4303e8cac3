import datetime as dt

import pytest
from conftest import days, land, row, sources_of, train
from pyspark.sql import functions as F
from stopwise import Settings
from stopwise.functions import number_rows, number_within
from stopwise.operators import punctuality, quality
from stopwise.plans.build import BuildFailed, build
from stopwise.plans.checks import declared_checks, violations
from stopwise.plans.refresh import refresh_days, replace_documents
from stopwise.plans.warehouse import Warehouse
from stopwise.storage import fresh_dir, save

LENIENT = Settings(
    warn_only=frozenset(
        {
            "orphan_stations_stg_timetable_events",
            "relationships_fct_delay_causes_cause_category_code",
        }
    )
)


def test_station_keys_are_dense_and_end_with_the_unknown_member(warehouse):
    keys = {r["station_short_code"]: r["station_key"] for r in warehouse.dim_station.collect()}
    assert keys == {"HKI": 1, "PSL": 2, "TPE": 3, "UNKNOWN": -1}


def test_calendar_fills_the_day_without_trains(warehouse):
    rows = warehouse.dim_date.orderBy("date").collect()
    assert [r["date_key"] for r in rows] == [20240310, 20240311, 20240312]
    assert [r["day_of_week"] for r in rows] == [0, 1, 2]
    assert [r["is_weekend"] for r in rows] == [True, False, False]
    assert [r["week_of_year"] for r in rows] == [10, 11, 11]
    assert rows[0]["day_name"] == "Sunday"


def test_train_types_keep_missing_parts(warehouse):
    rows = warehouse.dim_train_type.orderBy("train_type_key").collect()
    assert [(r["train_type"], r["train_category"]) for r in rows] == [
        ("IC", "Long-distance"),
        (None, "Long-distance"),
        ("IC", None),
    ]
    assert [r["is_commuter"] for r in rows] == [False, False, None]


def test_lookups_fall_back_as_defined(warehouse):
    fact = {
        (r["train_number"], r["station_short_code"]): r
        for r in warehouse.fct_timetable_events.collect()
    }
    assert fact[(3, "XXX")]["station_key"] == -1
    assert fact[(3, "XXX")]["train_type_key"] == 3  # a missing category is matched
    assert fact[(4, "TPE")]["train_type_key"] is None  # a missing type is not


def test_the_service_day_holds_after_midnight(warehouse):
    late = warehouse.fct_timetable_events.filter("scheduled_time = '2024-03-11 00:20:00'").first()
    assert late["date_key"] == 20240310
    assert late["source_ingest_date"] == dt.date(2024, 3, 10)


def test_fact_has_exactly_the_staged_rows(warehouse):
    assert quality.count_mismatch(
        warehouse.stg_timetable_events, warehouse.fct_timetable_events
    ).isEmpty()


def test_unmapped_cause_gets_the_unknown_member(warehouse):
    rows = {r["cause_category_code"]: r["cause_key"] for r in warehouse.fct_delay_causes.collect()}
    assert rows == {"E": 1, "L": 2, "Q": -1}


def test_punctuality_of_a_station_and_day(warehouse):
    agg = {
        (r["station_key"], r["date_key"]): r
        for r in warehouse.agg_station_punctuality.collect()
    }
    hki = agg[(1, 20240310)]
    # -60 and 1440 are measured, 1441 is implausible, the last has no actual time.
    assert (hki["scheduled_arrivals"], hki["measured_arrivals"], hki["on_time_events"]) == (4, 2, 1)
    assert hki["on_time_rate"] == 0.5
    assert hki["avg_delay_minutes"] == 690.0
    assert hki["median_delay_minutes"] == 690.0
    assert hki["worst_delay_minutes"] == 1440
    tpe = agg[(3, 20240310)]
    assert (tpe["scheduled_arrivals"], tpe["cancelled_arrivals"]) == (3, 1)
    unknown = agg[(-1, 20240310)]
    assert unknown["measured_arrivals"] == 0 and unknown["on_time_rate"] is None


def test_four_minutes_is_on_time_and_five_is_late(warehouse):
    psl = warehouse.agg_station_punctuality.filter("station_key = 2 and date_key = 20240310")
    assert psl.first()["on_time_events"] == 1
    tpe = warehouse.agg_station_punctuality.filter("station_key = 3 and date_key = 20240310")
    assert tpe.first()["on_time_events"] == 0


def test_pooling_divides_sums(warehouse):
    pooled = punctuality.pooled_punctuality(warehouse.agg_station_punctuality).first()
    sums = warehouse.agg_station_punctuality.agg(
        F.sum("on_time_events").alias("o"), F.sum("measured_arrivals").alias("m")
    ).first()
    assert pooled["on_time_rate"] == pytest.approx(round(sums["o"] / sums["m"], 4))


def test_scheduled_arrivals_add_up_to_the_fact(warehouse):
    total = warehouse.agg_station_punctuality.agg(F.sum("scheduled_arrivals")).first()[0]
    arrivals = punctuality.commercial_arrivals(warehouse.fct_timetable_events).count()
    assert total == arrivals


def test_there_are_44_column_checks_and_4_table_checks():
    checks = [c for stage in declared_checks().values() for c in stage]
    kinds = [c.kind for c in checks]
    assert len(checks) == 48 and len({c.name for c in checks}) == 48
    assert [kinds.count(k) for k in ("unique", "not_null", "accepted_values", "relationships")] == [
        12,
        23,
        2,
        7,
    ]


def test_build_stops_at_an_orphan_station_unless_it_only_warns(spark, sources):
    with pytest.raises(BuildFailed) as stopped:
        build(Warehouse(sources, fresh_dir(spark, "strict")))
    assert [r["check"] for r in stopped.value.failures] == ["orphan_stations_stg_timetable_events"]

    results = {
        r["check"]: r
        for r in build(Warehouse(sources, fresh_dir(spark, "lenient"), LENIENT)).collect()
    }
    assert len(results) == 48
    warned = {n: r["violations"] for n, r in results.items() if r["status"] == "warn"}
    assert warned == {
        "orphan_stations_stg_timetable_events": 1,
        "relationships_fct_delay_causes_cause_category_code": 1,
        "implausibly_early_fct_timetable_events": 1,
        "implausible_delay_fct_timetable_events": 2,
    }
    assert {r["status"] for n, r in results.items() if n not in warned} == {"pass"}


def test_check_counts_agree_with_their_violations(warehouse):
    for stage in declared_checks().values():
        for check in stage:
            assert violations(check, warehouse).count() >= 0


def test_duplicate_documents_fail_the_unique_check(spark, tmp_path, landing):
    twice = days()["2024-03-12"] * 2
    land(tmp_path / "trains", "2024-03-12", twice)
    for name in ("stations", "cause_codes", "detailed_cause_codes"):
        (tmp_path / f"{name}.json").write_text((landing / f"{name}.json").read_text())
    with pytest.raises(BuildFailed, match="unique_stg_timetable_events_event_key"):
        build(Warehouse(sources_of(spark, tmp_path), fresh_dir(spark, "twice"), LENIENT))


def test_relationship_counts_equal_the_violating_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(3,)], "p int")
    assert quality.relationships(child, "k", parent, "p").count() == 3
    assert quality.orphan_values(child, "k", parent, "p").agg(F.sum("n")).first()[0] == 3


def _refreshable(spark, tmp_path, landing):
    sources = sources_of(spark, landing)
    path = str(tmp_path / "documents")
    documents = save(sources.documents, path, "date")
    kept = type(sources)(
        documents, sources.stations, sources.cause_codes, sources.detailed_cause_codes
    )
    warehouse = Warehouse(kept, str(tmp_path / "warehouse"), LENIENT)
    build(warehouse)
    return path, warehouse


def _refetched(spark, tmp_path, trains, date="2024-03-12"):
    from stopwise.sources.documents import read_documents

    land(tmp_path / "again", date, trains)
    return read_documents(spark, str(tmp_path / "again"))


def test_a_refetched_day_replaces_itself_only(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    before = warehouse.fct_timetable_events.count()
    old_day = warehouse.fct_timetable_events.filter("date_key = 20240310")
    old_delays = sorted(str(r[0]) for r in old_day.select("delay_minutes").collect())

    settled = days()["2024-03-12"]
    settled[0]["timeTableRows"][1]["differenceInMinutes"] = 2
    landed = replace_documents(_refetched(spark, tmp_path, settled), path)
    assert refresh_days(warehouse, landed, [dt.date(2024, 3, 12)])

    fact = warehouse.fct_timetable_events
    assert fact.count() == before == fact.select("event_key").distinct().count()
    kept = fact.filter("date_key = 20240310").select("delay_minutes").collect()
    assert sorted(str(r[0]) for r in kept) == old_delays
    psl = fact.filter("date_key = 20240312 and station_short_code = 'PSL'").first()
    assert psl["delay_minutes"] == 2
    agg = warehouse.agg_station_punctuality
    assert agg.filter("date_key = 20240312 and station_key = 2").first()["on_time_events"] == 1
    assert agg.filter("date_key = 20240310").count() == 4


def test_a_new_day_extends_calendar_and_facts(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    before = warehouse.fct_timetable_events.count()
    new = [train("2024-03-14", 1, [row("HKI", "ARRIVAL", "2024-03-14T05:00:00.000Z", None, 1)])]
    landed = replace_documents(_refetched(spark, tmp_path, new, "2024-03-14"), path)
    assert refresh_days(warehouse, landed, [dt.date(2024, 3, 14)])
    assert warehouse.fct_timetable_events.count() == before + 1
    assert warehouse.dim_date.count() == 5
    assert warehouse.fct_timetable_events.filter("date_key is null").isEmpty()


def test_a_new_train_type_gets_the_next_key(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    old = {r["train_type_key"]: r["train_type"] for r in warehouse.dim_train_type.collect()}
    other = days()["2024-03-12"]
    other[0]["trainType"] = "ZZ"
    landed = replace_documents(_refetched(spark, tmp_path, other), path)
    assert refresh_days(warehouse, landed, [dt.date(2024, 3, 12)])
    new = {r["train_type_key"]: r["train_type"] for r in warehouse.dim_train_type.collect()}
    assert new == {**old, max(old) + 1: "ZZ"}
    number = other[0]["trainNumber"]
    moved = warehouse.fct_timetable_events.filter(f"date_key = 20240312 and train_number = {number}")
    assert {r["train_type_key"] for r in moved.collect()} == {max(old) + 1}


def test_nothing_of_a_refetched_day_stays_behind(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    day = dt.date(2024, 3, 12)
    bare = days()["2024-03-12"]
    for t in bare:
        for r in t["timeTableRows"]:
            r["causes"] = []
    landed = replace_documents(_refetched(spark, tmp_path, bare), path)
    refresh_days(warehouse, landed, [day])
    on_day = F.col("source_ingest_date") == day
    assert warehouse.fct_delay_causes.filter(on_day).isEmpty()
    assert not warehouse.fct_timetable_events.filter(on_day).isEmpty()

    nothing = landed.limit(0)
    landed = replace_documents(nothing, path, [day])
    refresh_days(warehouse, landed, [day])
    assert warehouse.fct_timetable_events.filter(on_day).isEmpty()
    assert warehouse.agg_station_punctuality.filter("date_key = 20240312").isEmpty()


def test_a_refresh_reads_only_the_partitions_it_needs(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    in_days = F.col("source_ingest_date").isin(dt.date(2024, 3, 12)) & F.col("date_key").isin(20240312)
    rows = warehouse.fct_timetable_events.filter(in_days)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "source_ingest_date" in filters


def test_a_full_build_leaves_nothing_of_an_earlier_one(spark, tmp_path, landing):
    path, warehouse = _refreshable(spark, tmp_path, landing)
    left = warehouse.sources.documents.filter("date <> '2024-03-12'")
    kept = type(warehouse.sources)(
        left, warehouse.sources.stations, warehouse.sources.cause_codes,
        warehouse.sources.detailed_cause_codes,
    )
    again = Warehouse(kept, warehouse.root + "-2", LENIENT)
    build(again)
    in_place = Warehouse(again.sources, warehouse.root, LENIENT)
    for name in ("fct_timetable_events", "fct_delay_causes", "agg_station_punctuality"):
        assert getattr(in_place, name).exceptAll(getattr(again, name)).isEmpty()


def test_a_build_without_any_cause(spark, tmp_path, landing):
    documents = sources_of(spark, landing)
    rows = F.transform("timeTableRows", lambda r: r.withField("causes", F.slice(r["causes"], 1, 0)))
    bare = type(documents)(
        documents.documents.withColumn("timeTableRows", rows), documents.stations,
        documents.cause_codes, documents.detailed_cause_codes,
    )
    warehouse = Warehouse(bare, str(tmp_path / "bare"), LENIENT)
    build(warehouse)
    assert warehouse.fct_delay_causes.isEmpty()


def test_a_built_warehouse_can_be_opened_again(spark, warehouse):
    for name in Warehouse.TABLES:
        getattr(warehouse, name)
    again = Warehouse.opened(warehouse.sources, warehouse.root)
    assert again.fct_timetable_events.count() == warehouse.fct_timetable_events.count()


def test_numbering_equals_the_window(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, "x").alias("g"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 4000).alias("v"),
        "id",
    )
    plain = number_within(df.withColumn("all", F.lit(1)), "n", ["v", "id"], ["all"])
    ranged = number_rows(df, "n", ["v", "id"])
    assert sorted(plain.select("id", "n").collect()) == sorted(ranged.select("id", "n").collect())
