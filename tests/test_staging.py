import datetime as dt
import hashlib

from conftest import days, land, row, train
from pyspark.sql import functions as F
from stopwise import schemas
from stopwise.operators import staging
from stopwise.sources import documents as src


def _key(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def test_event_key_is_the_digest_of_its_parts_in_any_session_zone(warehouse):
    rows = warehouse.stg_timetable_events.filter("train_number = 1 and station_short_code = 'PSL'")
    keys = {r["event_key"] for r in rows.filter("departure_date = '2024-03-10'").collect()}
    assert keys == {
        _key("2024-03-10", "1", "PSL", "ARRIVAL", "2024-03-10T02:30:00"),
        _key("2024-03-10", "1", "PSL", "DEPARTURE", "2024-03-10T02:31:00"),
    }


def test_missing_key_parts_stay_distinct(spark, tmp_path):
    rows = [row(None, "ARRIVAL", "2024-03-10T02:30:00.000Z"), row("NU", "ARRIVAL", None)]
    land(tmp_path, "2024-03-10", [train("2024-03-10", None, rows)])
    staged = staging.timetable_events(src.read_documents(spark, str(tmp_path)))
    assert {r["event_key"] for r in staged.collect()} == {
        _key("2024-03-10", "NULL", "NULL", "ARRIVAL", "2024-03-10T02:30:00"),
        _key("2024-03-10", "NULL", "NU", "ARRIVAL", "NULL"),
    }


def test_flatten_keeps_every_row_and_drops_empty_documents(warehouse):
    expected = sum(len(t["timeTableRows"]) for ts in days().values() for t in ts)
    staged = warehouse.stg_timetable_events
    assert staged.count() == expected
    assert staged.filter("train_number = 2").count() == 0
    assert staged.select("event_key").distinct().count() == expected


def test_flags_follow_the_band_and_missing_values(warehouse):
    rows = warehouse.stg_timetable_events.filter("train_number = 3").collect()
    plausible = {r["delay_minutes"]: r["is_plausible_delay"] for r in rows}
    assert plausible == {-61: False, -60: True, 1440: True, 1441: False, None: True}
    assert {r["commuter_line_id"] for r in rows} == {"Z"}
    other = warehouse.stg_timetable_events.filter("train_number = 1").first()
    assert other["commuter_line_id"] is None
    assert other["commercial_track"] is None
    assert other["is_cancelled"] is False
    cancelled = warehouse.stg_timetable_events.filter("train_number = 4").first()
    assert cancelled["is_cancelled"] and not cancelled["has_actual_time"]


def test_cause_counts_for_missing_null_empty_and_filled_arrays(warehouse):
    counts = {
        (r["train_number"], r["departure_date"].day, r["station_short_code"]): r["cause_count"]
        for r in warehouse.stg_timetable_events.filter("station_short_code = 'TPE'")
        .orderBy("scheduled_time", ascending=False)
        .collect()
    }
    assert counts == {(1, 10, "TPE"): 2, (4, 10, "TPE"): 0, (1, 12, "TPE"): 0}


def test_causes_are_numbered_in_array_order(warehouse):
    rows = warehouse.stg_delay_causes.orderBy("cause_category_code").collect()
    assert [(r["cause_category_code"], r["cause_seq"]) for r in rows] == [
        ("E", 2),
        ("L", 1),
        ("Q", 1),
    ]
    assert [r["third_cause_category_code"] for r in rows] == ["E11", None, None]


def test_service_date_comes_from_the_path_when_there_is_no_partition(spark, landing):
    file = str(landing / "trains" / "date=2024-03-12" / "trains.json.gz")
    loose = spark.read.schema(schemas.TRAINS).option("multiLine", True).json(file)
    assert "date" not in loose.columns
    dates = staging.timetable_events(loose).select("source_ingest_date").distinct().collect()
    assert [d[0] for d in dates] == [dt.date(2024, 3, 12)]


def test_a_path_without_a_date_gives_null(spark):
    df = spark.createDataFrame([("/x/date=2024-01-02/f",), ("/x/f",), ("/date=9/f",)], "p string")
    dates = [r[0] for r in df.select(src.path_date(F.col("p"))).collect()]
    assert dates == [dt.date(2024, 1, 2), None, None]


def test_a_date_filter_prunes_folders(spark, landing):
    documents = src.read_documents(spark, str(landing / "trains"))
    one = documents.filter("date = '2024-03-12'")
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_views_answer_ad_hoc_sql(spark, sources):
    src.register_views(sources.documents, "trains_t", "events_t")
    assert spark.sql("SELECT count(*) FROM trains_t").first()[0] == 5
    assert len(spark.table("events_t").columns) == 16
    worst = spark.sql("SELECT max(differenceInMinutes) FROM events_t").first()[0]
    assert worst == 1441


def test_default_listings(sources):
    first = src.first_trains(sources.documents).collect()
    assert [r["trainNumber"] for r in first] == [1, 2, 3]
    assert "timeTableRows" not in first[0].asDict()
    assert len(src.first_full_record(sources.documents).first()["timeTableRows"]) == 5


def test_metadata_staging(warehouse):
    stations = {r["station_short_code"]: r for r in warehouse.stg_stations.collect()}
    assert [stations[c]["passenger_traffic"] for c in ("HKI", "PSL", "TPE")] == [
        True,
        False,
        False,
    ]
    assert warehouse.stg_cause_codes.first()["valid_from"] == dt.date(2020, 1, 1)
    assert warehouse.stg_cause_codes_detailed.first()["valid_from"] == dt.date(2021, 2, 3)


def test_staging_causes_reads_only_the_nested_fields_it_needs(spark, tmp_path, sources):
    path = str(tmp_path / "documents")
    sources.documents.write.parquet(path)
    plan = staging.delay_causes(spark.read.parquet(path))._jdf.queryExecution().toString()
    schema = plan[plan.rindex("ReadSchema") :]
    assert "differenceInMinutes" not in schema and "commercialTrack" not in schema


def test_landing_writer_replaces_a_date_and_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "trains")
    arrays = [("2024-01-01", "[1]"), ("2024-01-02", "[2]")]
    src.write_landing(spark.createDataFrame(arrays, "date string, body string"), root)
    again = spark.createDataFrame([("2024-01-02", "[3]")], "date string, body string")
    src.write_landing(again, root)
    bodies = {str(r["date"]): r["value"] for r in spark.read.text(root).collect()}
    assert bodies == {"2024-01-01": "[1]", "2024-01-02": "[3]"}
