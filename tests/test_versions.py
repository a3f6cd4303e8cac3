"""Versions of the warehouse: failures between writes, days landed again, changed metadata."""

import datetime as dt
import json

import pytest
from conftest import CAUSE_CODES, DETAILED, STATIONS, cause, days, land, row, train
from pyspark.sql import functions as F
from stopwise import schemas
from stopwise.operators import dimensions, ingest
from stopwise.plans.build import BuildFailed, build
from stopwise.plans.daily import daily_run
from stopwise.plans.refresh import refresh_days
from stopwise.plans.warehouse import Sources, Warehouse
from stopwise.registry.versions import FailingTableSet, InjectedFailure
from stopwise.settings import Settings
from stopwise.snapshots import TableSet, VersionConflict
from stopwise.sources.documents import read_documents

LENIENT = Settings(warn_only=frozenset({
    "orphan_stations_stg_timetable_events", "relationships_fct_delay_causes_cause_category_code",
}))


def sources(spark, landing, stations=STATIONS, causes=CAUSE_CODES):
    def table(records, schema):
        return spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in records]))

    return Sources(
        read_documents(spark, str(landing)), table(stations, schemas.STATIONS),
        table(causes, schemas.CAUSE_CODES), table(DETAILED, schemas.DETAILED_CAUSE_CODES),
    )


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "landing"
    for date, trains in days().items():
        land(root, date, trains)
    return root


def test_tables_of_a_version_appear_together(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    assert tables.latest() == 0 and "a" not in tables.version()
    draft = tables.draft()
    draft.write("a", spark.range(3))
    draft.write("b", spark.range(4).withColumn("day", F.col("id") % 2), "day")
    assert tables.latest() == 0
    draft.publish()
    first = tables.version()
    assert first.read("a").count() == 3 and first.read("b").count() == 4

    draft = tables.draft()
    new = spark.range(10, 15).withColumn("day", F.lit(1).cast("bigint"))
    assert draft.replace("b", new, "day", [1]).count() == 7
    draft.append("a", spark.range(2))
    assert tables.version().read("b").count() == 4
    draft.publish()
    assert (tables.version().read("a").count(), tables.version().read("b").count()) == (5, 7)
    assert first.read("b").count() == 4 and first.read("a").count() == 3
    # The untouched partition is shared, not copied.
    shared = set(first.entries["b"].folders) & set(tables.version().entries["b"].folders)
    assert {f.split("/")[0] for f in shared} == {"day=0"}


def test_a_replaced_partition_without_rows_is_gone(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    draft = tables.draft()
    rows = spark.range(4).withColumn("day", F.col("id") % 2)
    draft.write("b", rows, "day")
    draft.publish()
    draft = tables.draft()
    assert [r[0] for r in draft.replace("b", rows.limit(0), "day", [1]).select("day").distinct().collect()] == [0]
    assert draft.without("b", [1]).count() == 4
    assert draft.write("b", rows.limit(0), "day").columns == ["id", "day"]
    assert draft.read("b").isEmpty()
    draft.drop()
    assert tables.version().read("b").count() == 4


def test_a_second_writer_is_refused(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    one, two = tables.draft(), tables.draft()
    one.write("a", spark.range(1))
    two.write("a", spark.range(2))
    one.publish()
    with pytest.raises(VersionConflict):
        two.publish()
    assert tables.version().read("a").count() == 1


def test_old_versions_are_collected(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path / "set"))
    for n in range(1, 5):
        draft = tables.draft()
        draft.write("a", spark.range(n))
        if n == 1:
            draft.write("kept", spark.range(9))
        draft.publish()
    assert tables.collect(keep=2) == [1, 2]
    assert tables.numbers() == [3, 4]
    assert tables.version(3).read("a").count() == 3 and tables.version().read("kept").count() == 9
    assert len(list((tmp_path / "set" / "a").glob("in_version=*"))) == 2


def _state_of(version):
    return {n: sorted(map(str, version.read(n).collect())) for n in version.entries}


@pytest.mark.parametrize("writes", [0, 1, 3, 4])
def test_a_refresh_lost_between_two_writes_changes_nothing(spark, tmp_path, landed, writes):
    given = sources(spark, landed)
    warehouse = Warehouse(given, str(tmp_path / "warehouse"), LENIENT)
    build(warehouse)
    before = _state_of(warehouse.tables.version())
    settled = days()["2024-03-12"]
    settled[0]["timeTableRows"][1]["differenceInMinutes"] = 2
    land(landed, "2024-03-12", settled)
    whole = warehouse.tables
    warehouse.tables = FailingTableSet(whole, writes)
    with pytest.raises(InjectedFailure):
        refresh_days(warehouse, read_documents(spark, str(landed)), [dt.date(2024, 3, 12)])
    assert _state_of(whole.version()) == before
    # The writer itself goes on with what is stored.
    assert sorted(map(str, warehouse.fct_timetable_events.collect())) == before["fct_timetable_events"]
    warehouse.tables = whole
    refresh_days(warehouse, read_documents(spark, str(landed)), [dt.date(2024, 3, 12)])
    assert _state_of(whole.version()) != before


def test_a_day_that_fails_its_checks_is_not_published(spark, tmp_path, landed):
    warehouse = Warehouse(sources(spark, landed), str(tmp_path / "warehouse"), LENIENT)
    build(warehouse)
    before = _state_of(warehouse.tables.version())
    twice = days()["2024-03-12"] * 2
    land(landed, "2024-03-12", twice)
    with pytest.raises(BuildFailed) as stopped:
        refresh_days(warehouse, read_documents(spark, str(landed)), [dt.date(2024, 3, 12)])
    assert "unique_fct_timetable_events_event_key" in {r["check"] for r in stopped.value.failures}
    assert _state_of(warehouse.tables.version()) == before
    # Nothing of the refused draft is left behind.
    stored = sum(len(e.folders) for e in warehouse.tables.version().entries.values())
    assert len(list((tmp_path / "warehouse").glob("*/**/in_version=*"))) == stored


def test_keys_survive_new_names_new_codes_and_full_builds(spark, tmp_path, landed):
    old = sources(spark, landed, STATIONS[1:], CAUSE_CODES[1:])
    root = str(tmp_path / "warehouse")
    build(Warehouse(old, root, LENIENT))
    first = TableSet(spark, root).version()
    keys = {r["station_short_code"]: r["station_key"] for r in first.read("dim_station").collect()}

    renamed = [{**s, "stationName": s["stationName"] + " new"} for s in STATIONS]
    now = sources(spark, landed, renamed, CAUSE_CODES)
    refreshed = Warehouse.opened(now, root, LENIENT)
    refresh_days(refreshed, refreshed.sources.documents, [dt.date(2024, 3, 12)])
    after = {r["station_short_code"]: r for r in refreshed.dim_station.collect()}
    assert {c: after[c]["station_key"] for c in keys} == keys
    assert after["HKI"]["station_key"] == max(keys.values()) + 1
    assert after["PSL"]["station_name"] == "Station PSL new"
    # Older days get the key of the code that has come since, too.
    fact = refreshed.fct_timetable_events
    assert fact.filter("station_short_code = 'HKI' AND station_key = -1").isEmpty()
    known = [c["categoryCode"] for c in CAUSE_CODES]
    lost = refreshed.fct_delay_causes.filter(F.col("cause_category_code").isin(known) & (F.col("cause_key") == -1))
    assert lost.isEmpty()

    again = Warehouse(now, root, LENIENT)
    build(again)
    for name in ("dim_station", "dim_cause", "dim_train_type"):
        assert sorted(map(str, getattr(again, name).collect())) == sorted(map(str, getattr(refreshed, name).collect()))
    columns = sorted(set(again.fct_timetable_events.columns))
    assert again.fct_timetable_events.select(columns).exceptAll(fact.select(columns)).isEmpty()


def test_key_maps_are_null_safe_and_keep_their_keys(spark):
    rows = spark.createDataFrame([("b", None), ("a", "x"), ("b", None)], "train_category string, train_type string")
    by = dimensions.TRAIN_TYPE
    first = dimensions.extended_keys(None, rows, "k", by).checkpoint()
    assert sorted(r["k"] for r in first.collect()) == [1, 2]
    more = rows.unionByName(spark.createDataFrame([(None, "y")], rows.schema))
    second = {(r["train_category"], r["train_type"]): r["k"] for r in dimensions.extended_keys(first, more, "k", by).collect()}
    assert second == {("a", "x"): 1, ("b", None): 2, (None, "y"): 3}
    assert dimensions.extended_keys(first, rows.limit(0), "k", by).count() == 2


def test_daily_runs_of_separate_processes(spark, tmp_path, landed):
    root, at = str(tmp_path / "daily"), dt.datetime(2024, 4, 1, 6)

    def run(hour):
        warehouse = Warehouse(sources(spark, landed), f"{root}/warehouse", LENIENT)
        log = daily_run(warehouse, str(landed), root, at.replace(hour=hour)).orderBy("run_at").collect()
        return (log[-1]["dates"], log[-1]["status"]), TableSet(spark, f"{root}/warehouse").version()

    last, version = run(6)
    events = version.read("fct_timetable_events").count()
    assert last == (len(days()), "PASS")
    assert run(7)[0] == (0, "NOTHING NEW")

    settled = days()["2024-03-12"]
    settled[0]["timeTableRows"][1]["differenceInMinutes"] = 2
    land(landed, "2024-03-12", settled)
    last, version = run(8)
    assert last == (1, "PASS")
    fact = version.read("fct_timetable_events")
    assert fact.count() == events
    assert fact.filter("date_key = 20240312 and station_short_code = 'PSL'").first()["delay_minutes"] == 2
    assert version.read("state").filter("date = '2024-03-12'").count() == 2

    land(landed, "2024-03-12", "[{")  # a bad body: the day stays as it was, and is not read again
    assert run(9)[0] == (0, "NOTHING NEW")
    numbers = version.number
    last, version = run(10)
    assert last == (0, "NOTHING NEW") and version.read("fct_timetable_events").count() == events
    assert version.number == numbers + 1  # the list of seen files only, by the run before

    land(landed, "2024-03-12", settled)  # the body that is stored, under a new time
    last, version = run(11)
    assert version.read("fct_timetable_events").count() == events


def test_a_failed_daily_run_leaves_state_and_tables(spark, tmp_path, landed):
    root = str(tmp_path / "daily")

    def run(hour):
        warehouse = Warehouse(sources(spark, landed), f"{root}/warehouse", LENIENT)
        return daily_run(warehouse, str(landed), root, dt.datetime(2024, 4, 1, hour))

    run(6)
    before = TableSet(spark, f"{root}/warehouse").version()
    land(landed, "2024-03-12", days()["2024-03-12"] * 2)
    with pytest.raises(BuildFailed):
        run(7)
    after = TableSet(spark, f"{root}/warehouse").version()
    assert after.number == before.number
    log = spark.read.parquet(f"{root}/runs").orderBy("run_at").collect()
    assert [(r["dates"], r["status"]) for r in log] == [(len(days()), "PASS"), (0, "FAIL")]
    land(landed, "2024-03-12", days()["2024-03-12"])
    assert run(8).orderBy("run_at").collect()[-1]["status"] != "FAIL"


def test_changed_dates_follow_size_time_and_lost_files(spark):
    schema = "date date, file string, gz_bytes long, modified_at timestamp"
    moment, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    day = [dt.date(2024, 3, d) for d in range(1, 8)]
    seen = [(day[0], "a", 1, moment), (day[1], "b", 1, moment), (day[2], "c", 1, moment),
            (day[3], "d", 1, moment), (day[3], "e", 1, moment), (day[4], "f", 1, moment)]
    listed = [(day[0], "a", 1, moment), (day[1], "b", 2, moment), (day[2], "c", 1, later),
              (day[3], "d", 1, moment), (day[5], "g", 1, moment)]
    got = ingest.changed_dates(spark.createDataFrame(listed, schema), spark.createDataFrame(seen, schema))
    assert sorted(r[0] for r in got.collect()) == [day[1], day[2], day[3], day[5]]


def test_a_landing_is_read_once_for_outcomes_and_documents(spark, tmp_path, landed):
    land(landed, "2024-03-20", "   ")
    land(landed, "2024-03-21", '[{"trainNumber": "no number"}]')
    land(landed, "2024-03-22", json.dumps(days()["2024-03-12"]) + " trailing")
    land(landed, "2024-03-23", [train("2024-03-23", 1, [row("HKI", "ARRIVAL", "2024-03-23T05:00:00.000Z", causes=[cause("E")])])])
    scanned = ingest.scan_landing(spark, str(landed))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    files = {r["date"].day: r for r in ingest.file_outcomes(scanned).collect()}
    assert {d: files[d]["reason"] for d in (10, 12, 21, 22, 23)} == {
        10: "accepted", 12: "accepted", 21: "malformed", 22: "malformed", 23: "accepted"
    }
    assert files[20]["reason"] in ("empty", "malformed")
    by_reader = read_documents(spark, str(landed)).filter("date IN ('2024-03-10', '2024-03-12', '2024-03-23')")
    names = [*schemas.TRAINS.names, "date"]
    by_scan = scanned.filter("date IN ('2024-03-10', '2024-03-12', '2024-03-23')").select(names)
    assert by_scan.exceptAll(by_reader.select(names)).isEmpty() and by_scan.count() == by_reader.count()


def test_the_stream_parses_once_and_survives_kills_between_the_grains(spark, tmp_path, landed, monkeypatch):
    from stopwise.operators import staging
    from stopwise.streaming import new_days

    out, seen = str(tmp_path / "staged"), str(tmp_path / "seen")

    def run():
        new_days.stage_new_batches(new_days.read_new_bodies(spark, str(landed)), out, seen)
        events = new_days.staged(spark, out, new_days.EVENTS)
        return events.count(), events.select("event_key").distinct().count(), new_days.staged(spark, out, new_days.CAUSES).count()

    whole = read_documents(spark, str(landed))
    want = staging.timetable_events(whole).count(), staging.delay_causes(whole).count()
    inner = staging.delay_causes

    def killed(documents):
        raise RuntimeError("killed between the grains")

    monkeypatch.setattr(new_days.staging, "delay_causes", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(new_days.staging, "delay_causes", inner)
    assert run() == (want[0], want[0], want[1])
    assert run() == (want[0], want[0], want[1])

    land(landed, "2024-03-12", days()["2024-03-12"], "again.json.gz")  # the same body under another name
    land(landed, "2024-03-15", "[{")  # a bad one
    new = [train("2024-03-16", 1, [row("HKI", "ARRIVAL", "2024-03-16T05:00:00.000Z", None, 1, causes=[cause("E")])])]
    land(landed, "2024-03-16", new, "a.json.gz")
    land(landed, "2024-03-16", new, "b.json.gz")  # twice in one batch
    assert run() == (want[0] + 1, want[0] + 1, want[1] + 1)
    assert len(list((tmp_path / "staged" / "documents").glob("batch=*"))) == 2


def test_an_empty_landing_stages_nothing(spark, tmp_path):
    from stopwise.streaming import new_days

    land(tmp_path / "landing", "2024-03-12", "[]")
    bodies = new_days.read_new_bodies(spark, str(tmp_path / "landing"))
    new_days.stage_new_batches(bodies, str(tmp_path / "out"), str(tmp_path / "seen"))
    assert not list((tmp_path / "out").glob("events/batch=*/source_ingest_date=*"))


def test_running_totals_of_a_hot_group(spark):
    from stopwise.functions import running_total

    rows = [("hot" if i % 3 else None, i, i % 7) for i in range(3000)] + [("cold", 5000, 1)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    got = {(r["g"], r["i"]): r["t"] for r in running_total(df, "t", "v", ["g", "i"], ["g"]).collect()}
    for group in ("hot", None, "cold"):
        total = 0
        for g, i, v in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            assert got[(g, i)] == total
            total += v


def test_landed_lines_are_cut_at_the_target(spark, tmp_path, landed):
    from stopwise.sources import documents as src

    docs = read_documents(spark, str(landed))
    many = docs.unionByName(docs).unionByName(docs)
    root = str(tmp_path / "lines")
    src.write_landing_lines(many, root, 2000)
    again = src.read_document_lines(spark, root)
    assert again.select(many.columns).exceptAll(many).isEmpty() and again.count() == many.count()
    longest = max(len(line) for f in (tmp_path / "lines").glob("date=*/part*") for line in f.read_text().splitlines())
    by_date = {}
    for f in (tmp_path / "lines").glob("date=*/part*"):
        by_date.setdefault(f.parent.name, []).append(f.stat().st_size)
    for sizes in by_date.values():
        assert max(sizes) < 2000 + longest + 1 and sum(s < 2000 - longest for s in sizes) <= 1
    src.write_landing_lines(many.limit(0), str(tmp_path / "none"), 2000)


def _landed_files(root):
    """Sizes of the lines of each landed file, by folder and file."""
    found = {}
    for f in root.glob("date=*/part*"):
        found.setdefault(f.parent.name, {})[f.name] = [len(line) + 1 for line in f.read_text().splitlines()]
    return found


@pytest.mark.parametrize("day", ["date", "string"])
def test_a_task_lands_many_bins_each_a_file_of_its_own(spark, tmp_path, day):
    from stopwise.sources import documents as src

    # Long and short documents take turns, one date holds most of them, some have none.
    n, long = F.col("id"), F.lit("x")
    dated = F.when(n % 50 == 0, None).when(n % 20 == 0, F.lit("2024-03-13")).otherwise(F.lit("2024-03-12"))
    size = F.when(n % 7 == 0, 900 + n % 90).otherwise(20 + n % 40).cast("int")
    docs = spark.range(4000).select(n.alias("n"), F.repeat(long, size).alias("text"), dated.cast(day).alias("date"))
    src.write_landing_lines(docs, str(tmp_path / "lines"), 4000)
    read = spark.read.schema("n long, text string").json(str(tmp_path / "lines"))
    assert read.count() == 4000
    assert read.select("n", "text", F.col("date").cast("string")).exceptAll(
        docs.select("n", "text", F.col("date").cast("string"))
    ).isEmpty()
    landed = _landed_files(tmp_path / "lines")
    assert set(landed) == {"date=2024-03-12", "date=2024-03-13", "date=__HIVE_DEFAULT_PARTITION__"}
    longest = max(max(lines) for files in landed.values() for lines in files.values())
    for files in landed.values():
        assert all(sum(lines) < 4000 + max(lines) for lines in files.values())
        assert sum(sum(lines) <= 4000 - longest for lines in files.values()) <= 1
    tasks = {name.split("-")[1] for files in landed.values() for name in files}
    assert len(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions")) < 50 < sum(map(len, landed.values()))


def test_bins_of_documents_longer_than_the_target(spark, tmp_path):
    from stopwise.sources import documents as src

    docs = spark.range(60).select(
        F.col("id").alias("n"), F.repeat(F.lit("x"), F.when(F.col("id") < 50, 10).otherwise(5000)).alias("text"),
        F.lit("2024-03-12").cast("date").alias("date"),
    )
    src.write_landing_lines(docs, str(tmp_path / "lines"), 1000)
    assert spark.read.schema("n long, text string").json(str(tmp_path / "lines")).count() == 60
    (files,) = _landed_files(tmp_path / "lines").values()
    assert all(sum(lines) < 1000 + max(lines) for lines in files.values())
    assert sum(max(lines) > 5000 for lines in files.values()) == 10  # no two of them in a file


def test_running_totals_over_all_groups(spark):
    from stopwise.functions import running_total

    rows = [("hot" if i % 3 else None, i, i % 7) for i in range(3000)] + [("cold", 5000, 1)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    got = {(r["g"], r["i"]): (r["t"], r["o"]) for r in running_total(df, "t", "v", ["g", "i"], ["g"], "o").collect()}
    overall = 0
    for group in ("cold", "hot", None):
        total = 0
        for g, i, v in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            assert got[(g, i)] == (total, overall)
            total, overall = total + v, overall + v


def test_distributions_are_read_from_stored_counts(spark, tmp_path, landed):
    from dataclasses import replace

    from stopwise.operators import analysis as ana
    from stopwise.operators import punctuality
    from stopwise.operators.analysis import Star

    warehouse = Warehouse(sources(spark, landed), str(tmp_path / "warehouse"), LENIENT)
    build(warehouse)
    star = Star.of(warehouse)
    for question in (
        lambda s: ana.by_category(s, LENIENT, floor=-1), lambda s: ana.delay_histogram(s, LENIENT),
        lambda s: ana.delay_tails(s, LENIENT), ana.delay_quantiles,
    ):
        got, want = question(star), question(replace(star, counts=None))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        read = {f.split("/warehouse/")[1].split("/")[0] for f in got.inputFiles()}
        assert "delay_counts" in read and "fct_timetable_events" not in read
    assert warehouse.agg_station_punctuality.exceptAll(
        punctuality.station_punctuality(warehouse.fct_timetable_events, LENIENT)
    ).isEmpty()
    settled = days()["2024-03-12"]
    settled[0]["timeTableRows"][1]["differenceInMinutes"] = 2
    land(landed, "2024-03-12", settled)
    refresh_days(warehouse, read_documents(spark, str(landed)), [dt.date(2024, 3, 12)])
    assert warehouse.delay_counts.exceptAll(punctuality.delay_counts(warehouse.fct_timetable_events)).isEmpty()
    assert warehouse.delay_counts.agg(F.sum("rows")).first()[0] == punctuality.commercial_arrivals(
        warehouse.fct_timetable_events
    ).count()


def test_bucketed_keys_are_checked_and_joined_without_a_shuffle(spark, tmp_path, landed):
    from stopwise.operators import facts, quality
    from stopwise.plans.colocated import KeyTables

    warehouse = Warehouse(sources(spark, landed), str(tmp_path / "warehouse"), LENIENT)
    fact, causes = warehouse.fct_timetable_events, warehouse.fct_delay_causes
    lost = causes.limit(1)
    twice = fact.unionByName(fact.filter("train_number = 3")).join(lost, "event_key", "left_anti")
    tables = KeyTables(twice.select(fact.columns), causes, buckets=3)
    answers = {"unique": tables.repeated(), "orphans": tables.orphans(), "causes": tables.known_causes()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with keys too many to broadcast
    try:
        for answer in (tables.repeated(), tables.orphans(), tables.known_causes()):
            assert "Exchange" not in answer._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(answers["unique"]) == rows(quality.unique(twice, "event_key")) != []
    assert rows(answers["orphans"]) == rows(quality.relationships(causes, "event_key", twice, "event_key")) != []
    assert rows(answers["causes"]) == rows(facts.known_causes(causes, twice)) != []
    tables.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keys_")]


def test_bucketed_keys_leave_nothing_in_the_catalog(spark, tmp_path, landed):
    from stopwise.plans.colocated import KeyTables

    listed = lambda: sorted(t.name for t in spark.catalog.listTables())
    warehouse = Warehouse(sources(spark, landed), str(tmp_path / "warehouse"), LENIENT)
    before = listed()
    tables = KeyTables.of(warehouse, buckets=3)
    assert listed() == before
    assert tables.events.count() == warehouse.fct_timetable_events.count() > 0
    assert tables.known_causes().count() == warehouse.fct_delay_causes.count() > 0
    tables.drop()
