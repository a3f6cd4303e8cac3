import datetime as dt
import json

import pytest
from conftest import days, land
from pyspark.sql import types as T
from stopwise import schemas
from stopwise.operators import ingest, staging
from stopwise.sources.documents import read_documents
from stopwise.streaming.new_days import read_new_documents, stage_new_days


def _date(day):
    return dt.date(2024, 3, day)


def _state(spark, *loaded):
    rows = [(_date(d), dt.datetime(2024, 4, 1), 10, 1, 1) for d in loaded]
    return spark.createDataFrame(rows, schemas.INGESTION_STATE)


@pytest.fixture
def faulty(tmp_path):
    good = days()["2024-03-12"]
    body = json.dumps(good)
    land(tmp_path, "2024-03-01", good)
    land(tmp_path, "2024-03-02", "[]")
    land(tmp_path, "2024-03-03", body[: len(body) // 2])
    land(tmp_path, "2024-03-04", json.dumps(good[0]))
    land(tmp_path, "2024-03-05", "  \n" + json.dumps(good, indent=1))
    land(tmp_path, "2024-03-06", good, "a.json.gz")
    land(tmp_path, "2024-03-06", "[]", "b.json.gz")
    return tmp_path


def test_each_landed_date_gets_its_outcome(spark, faulty):
    got = {r["date"].day: r for r in ingest.validate_landing(spark, str(faulty)).collect()}
    assert {d: r["status"] for d, r in got.items()} == {
        1: "accepted",
        2: "empty",
        3: "malformed",
        4: "not_an_array",
        5: "accepted",
        6: "empty",
    }
    assert got[1]["num_trains"] == 1
    assert got[1]["response_bytes"] == len(json.dumps(days()["2024-03-12"]))
    assert got[6]["files"] == 2 and got[6]["bad_files"] == 1


def test_validation_can_be_limited_to_new_days(spark, faulty):
    outcomes = ingest.validate_landing(spark, str(faulty), [_date(2), _date(5), _date(9)])
    got = {r["date"].day: r["status"] for r in outcomes.collect()}
    assert got == {2: "empty", 5: "accepted"}


def test_a_bad_body_neither_advances_nor_reaches_staging(spark, faulty, tmp_path_factory):
    outcomes = ingest.validate_landing(spark, str(faulty))
    accepted = ingest.accepted_state(outcomes, ingest.wall_clock(dt.datetime(2024, 4, 1)))
    log = ingest.record_state(accepted, str(tmp_path_factory.mktemp("state")))
    state = ingest.current_state(log)
    assert ingest.watermark(state).first()[0] == _date(5)
    documents = ingest.accepted_documents(read_documents(spark, str(faulty)), state)
    assert {r["source_ingest_date"].day for r in staging.timetable_events(documents).collect()} == {
        1,
        5,
    }
    summary = {r["status"]: r["dates"] for r in ingest.outcome_summary(outcomes).collect()}
    assert summary == {"accepted": 2, "empty": 2, "malformed": 1, "not_an_array": 1}


def test_the_latest_fetch_of_a_date_wins(spark, tmp_path):
    path = str(tmp_path / "state")
    for hour, trains in ((1, 5), (3, 7), (2, 6)):
        row = (_date(1), dt.datetime(2024, 4, 1, hour), 10 * trains, trains, trains)
        log = ingest.record_state(spark.createDataFrame([row], schemas.INGESTION_STATE), path)
    got = ingest.current_state(log).collect()
    assert [(r["date"], r["num_trains"], r["response_bytes"]) for r in got] == [(_date(1), 7, 70)]


def test_catch_up_starts_after_the_watermark(spark):
    window = ingest.catch_up_window(_state(spark, 1, 2, 5), _date(9)).first()
    assert (window["first_date"], window["last_date"], window["dates"]) == (_date(6), _date(8), 3)
    dates = ingest.catch_up_dates(_state(spark, 1, 2, 5), _date(9)).collect()
    assert sorted(r["date"].day for r in dates) == [6, 7, 8]


@pytest.mark.parametrize("as_of", [5, 6])
def test_an_up_to_date_watermark_gives_an_empty_window(spark, as_of):
    state = _state(spark, 5)
    assert ingest.catch_up_window(state, _date(as_of)).first()["dates"] == 0
    assert ingest.catch_up_dates(state, _date(as_of)).isEmpty()


def test_missing_dates_include_holes(spark):
    missing = ingest.missing_dates(_state(spark, 1, 2, 5), _date(8)).collect()
    assert sorted(r["date"].day for r in missing) == [3, 4, 6, 7]


def test_date_range_is_inclusive_and_never_backwards(spark):
    assert ingest.date_range(spark, _date(1), _date(3)).count() == 3
    assert ingest.date_range(spark, _date(3), _date(1)).isEmpty()


def test_metadata_older_than_a_week_is_stale(spark, landing):
    path = str(landing / "stations.json")
    now = dt.datetime.now(dt.timezone.utc)
    fresh = ingest.stale_metadata(spark, path, now).first()
    stale = ingest.stale_metadata(spark, path, now + dt.timedelta(days=8)).first()
    assert (fresh["is_stale"], stale["is_stale"]) == (False, True)
    assert fresh["file"] == "stations.json"


def test_run_log_row(spark, warehouse):
    got = ingest.run_log_row(
        _state(spark, 1, 5),
        warehouse.fct_timetable_events,
        warehouse.fct_delay_causes,
        2,
        "PASS",
        dt.datetime(2024, 3, 9, 2, 30),
    ).first()
    assert (got["watermark"], got["event_rows"], got["cause_rows"]) == (_date(5), 14, 3)
    assert got["run_at"] == dt.datetime(2024, 3, 9, 2, 30)


def test_the_stream_stages_each_landed_file_once(spark, tmp_path):
    landing, out, progress = (str(tmp_path / p) for p in ("landing", "out", "progress"))
    schema = T.StructType([*schemas.TRAINS.fields, T.StructField("date", T.DateType())])

    def run():
        stage_new_days(read_new_documents(spark, landing, schema), out, progress)
        return spark.read.parquet(out)

    land(landing, "2024-03-10", days()["2024-03-10"])
    assert run().count() == 11
    assert run().count() == 11
    land(landing, "2024-03-12", days()["2024-03-12"])
    staged = run()
    assert staged.count() == 14 == staged.select("event_key").distinct().count()


def test_of_two_fetches_at_one_time_the_same_one_wins(spark):
    from stopwise.operators.ingest import current_state

    rows = [("2024-01-01", "t", 1), ("2024-01-01", "t", 2)]
    for order in (rows, rows[::-1]):
        log = spark.createDataFrame(order, "date string, fetched_at string, num_trains int")
        assert [tuple(r) for r in current_state(log).collect()] == [("2024-01-01", "t", 2)]


def test_documents_of_an_unknown_date_come_last(spark):
    from stopwise.sources.documents import first_full_record, first_trains

    docs = spark.createDataFrame(
        [(None, 1, []), ("2024-01-02", 5, []), ("2024-01-01", 9, [])],
        "date string, trainNumber int, timeTableRows array<int>",
    )
    assert [r["trainNumber"] for r in first_trains(docs, 3).collect()] == [9, 5, 1]
    assert first_full_record(docs.filter("date is null")).count() == 1
