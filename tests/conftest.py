from __future__ import annotations

import gzip
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Nothing may depend on the session zone; this one has daylight-saving gaps.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def row(station, kind, scheduled, actual=None, delay=None, **more):
    """One raw timetable row; optional fields are left out unless given."""
    out = {
        "stationShortCode": station,
        "type": kind,
        "trainStopping": True,
        "commercialStop": True,
        "scheduledTime": scheduled,
        "commercialTrack": "",
    }
    if actual is not None:
        out["actualTime"] = actual
    if delay is not None:
        out["differenceInMinutes"] = delay
    out.update(more)
    return out


def train(date, number, rows, **more):
    out = {
        "departureDate": date,
        "trainNumber": number,
        "operatorShortCode": "vr",
        "trainType": "IC",
        "trainCategory": "Long-distance",
        "commuterLineID": "",
        "cancelled": False,
        "timetableType": "REGULAR",
        "timeTableRows": rows,
    }
    out.update(more)
    return out


def land(root, date, trains, name="trains.json.gz"):
    """Write one landed file; ``trains`` may be a ready body."""
    folder = os.path.join(str(root), f"date={date}")
    os.makedirs(folder, exist_ok=True)
    body = trains if isinstance(trains, str) else json.dumps(trains)
    with gzip.open(os.path.join(folder, name), "wt", encoding="utf-8") as f:
        f.write(body)


def cause(code, detailed=None, third=None):
    out = {"categoryCode": code}
    if detailed:
        out["detailedCategoryCode"] = detailed
    if third:
        out["thirdCategoryCode"] = third
    return out


STATIONS = [
    {
        "stationShortCode": code,
        "stationName": f"Station {code}",
        "stationUICCode": 100 + i,
        "countryCode": "FI",
        "latitude": 60 + i,
        "longitude": 24.5,
        "passengerTraffic": traffic,
        "type": "STATION",
    }
    for i, (code, traffic) in enumerate([("HKI", True), ("PSL", None), ("TPE", False)])
]

CAUSE_CODES = [
    {"categoryCode": c, "categoryName": f"Cause {c}", "validFrom": "2020-01-01"} for c in "EL"
]

DETAILED = [
    {"detailedCategoryCode": "E1", "detailedCategoryName": "Detail", "validFrom": "2021-02-03"}
]


def days():
    """Two service dates with the odd cases of the feed; 2024-03-11 is not landed."""
    a = "ARRIVAL"
    d = "DEPARTURE"
    first = [
        train(
            "2024-03-10",
            1,
            [
                row("HKI", d, "2024-03-10T05:00:00.000Z", "2024-03-10T05:00:10.000Z", 0),
                # 02:30 on this date does not exist on the session's clock.
                row("PSL", a, "2024-03-10T02:30:00.000Z", "2024-03-10T02:34:00.000Z", 4),
                row("PSL", d, "2024-03-10T02:31:00.000Z", "2024-03-10T02:36:00.000Z", 5),
                row(
                    "TPE",
                    a,
                    "2024-03-10T23:50:00.000Z",
                    "2024-03-10T23:59:00.000Z",
                    9,
                    causes=[cause("L", "L1"), cause("E", "E1", "E11")],
                ),
                # The same station again, after midnight.
                row("TPE", a, "2024-03-11T00:20:00.000Z", "2024-03-11T00:25:00.000Z", 5),
            ],
        ),
        train("2024-03-10", 2, []),
        train(
            "2024-03-10",
            3,
            [
                row("XXX", a, "2024-03-10T08:00:00.000Z", "2024-03-10T06:59:00.000Z", -61),
                row("HKI", a, "2024-03-10T08:10:00.000Z", "2024-03-10T07:10:00.000Z", -60),
                row("HKI", a, "2024-03-10T08:20:00.000Z", "2024-03-11T08:20:00.000Z", 1440),
                row("HKI", a, "2024-03-10T08:30:00.000Z", "2024-03-11T08:31:00.000Z", 1441),
                row("HKI", a, "2024-03-10T08:40:00.000Z", causes=[cause("Q")]),
            ],
            trainCategory=None,
            commuterLineID="Z",
        ),
        train(
            "2024-03-10",
            4,
            [row("TPE", a, "2024-03-10T09:00:00.000Z", causes=[], cancelled=True)],
            trainType=None,
            cancelled=True,
        ),
    ]
    second = [
        train(
            "2024-03-12",
            1,
            [
                row("HKI", d, "2024-03-12T05:00:00.000Z", "2024-03-12T05:00:00.000Z", 0),
                row("PSL", a, "2024-03-12T06:00:00.000Z", "2024-03-12T06:06:00.000Z", 6),
                row(
                    "TPE",
                    a,
                    "2024-03-12T07:00:00.000Z",
                    "2024-03-12T07:03:00.000Z",
                    3,
                    causes=None,
                ),
            ],
        )
    ]
    return {"2024-03-10": first, "2024-03-12": second}


@pytest.fixture(scope="session")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for date, trains in days().items():
        land(root / "trains", date, trains)
    for name, records in (
        ("stations", STATIONS),
        ("cause_codes", CAUSE_CODES),
        ("detailed_cause_codes", DETAILED),
    ):
        with open(root / f"{name}.json", "w", encoding="utf-8") as f:
            json.dump(records, f)
    return root


def sources_of(spark, root):
    from stopwise import schemas
    from stopwise.plans.warehouse import Sources
    from stopwise.sources.documents import read_documents, read_metadata

    return Sources(
        documents=read_documents(spark, str(root / "trains")),
        stations=read_metadata(spark, str(root / "stations.json"), schemas.STATIONS),
        cause_codes=read_metadata(spark, str(root / "cause_codes.json"), schemas.CAUSE_CODES),
        detailed_cause_codes=read_metadata(
            spark, str(root / "detailed_cause_codes.json"), schemas.DETAILED_CAUSE_CODES
        ),
    )


@pytest.fixture(scope="session")
def sources(spark, landing):
    return sources_of(spark, landing)


@pytest.fixture(scope="session")
def warehouse(spark, sources):
    from stopwise.plans.warehouse import Warehouse
    from stopwise.storage import fresh_dir

    return Warehouse(sources, fresh_dir(spark, "warehouse"))
