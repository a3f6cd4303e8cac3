"""The daily run: find what has landed or changed, validate it, refresh or build, log the run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise import schemas
from stopwise.operators import ingest
from stopwise.operators.ingest import ACCEPTED
from stopwise.plans.build import build
from stopwise.plans.refresh import refresh_days
from stopwise.plans.warehouse import Warehouse
from stopwise.storage import fresh_dir, save

PASSED, FAILED, IDLE = "PASS", "FAIL", "NOTHING NEW"

#: What is kept of every landed file that has been read, accepted or not.
SEEN = ["date", "file", "gz_bytes", "modified_at", "response_bytes", "body_hash", "documents", "reason"]


def daily_run(
    warehouse: Warehouse, landing: str, root: str, at: dt.datetime, as_of: dt.date | None = None
) -> DataFrame:
    """One run over the landing folder; returns the run log (``root``/runs) with the new line.

    Days before ``as_of`` with a file that is new, or of another size or time than when it was
    read, holes and days landed again included, are read: every body once. Where all bodies of a
    day are known, it is as it was. Other accepted days are taken in: the warehouse is built when
    it has no version yet and refreshed for these days otherwise, in this process or a later one.
    Documents, tables, state and the list of files seen are published together, after the checks. A
    rejected day stays as it is and is looked at again when it has changed. A run whose checks fail
    is logged as such, changes nothing else and raises ``BuildFailed``.
    """
    spark = warehouse.spark
    as_of = as_of or warehouse.settings.as_of or at.date()
    if "fct_timetable_events" in warehouse.tables.version():
        warehouse.reopen()
    latest = warehouse.tables.version()
    listed = ingest.landed_files(spark, landing).filter(F.col("date") < F.lit(as_of))
    if "landed_files" in latest:
        wanted = ingest.changed_dates(listed, latest.read("landed_files"))
    else:
        wanted = listed.select("date").distinct()
    wanted = sorted(r["date"] for r in wanted.collect())  # days, not documents

    status, days = IDLE, []
    try:
        if wanted:
            status = FAILED
            days = _take_in(warehouse, landing, wanted, at)
            status = PASSED if days else IDLE
    finally:
        latest = warehouse.tables.version()
        if "fct_delay_causes" in latest:
            line = ingest.run_log_row(
                ingest.current_state(latest.read("state")), latest.read("fct_timetable_events"),
                latest.read("fct_delay_causes"), dates=len(days), status=status, at=at,
            )
            save(line, f"{root}/runs", mode="append")
    return spark.read.parquet(f"{root}/runs")


def _take_in(warehouse: Warehouse, landing: str, wanted: list[dt.date], at: dt.datetime) -> list[dt.date]:
    """Read the wanted days, take those in that are accepted and new; the days taken in."""
    spark = warehouse.spark
    scanned = save(ingest.scan_landing(spark, landing, wanted), f"{fresh_dir(spark, 'landed')}/documents", "date")
    with warehouse.writing() as draft:
        files = save(ingest.file_outcomes(scanned), f"{fresh_dir(spark, 'landed')}/files")
        outcomes = ingest.date_outcomes(files)
        known = draft.read("landed_files") if "landed_files" in draft else None
        seen = files.select(SEEN)
        if known is not None:
            other_days = known.filter(~F.col("date").isin(*wanted))
            changed = _bodies(files).join(_bodies(known), ["date", "bodies"], "left_anti").select("date")
            outcomes = outcomes.join(changed, "date", "left_semi")
            seen = other_days.unionByName(seen)
        accepted = ingest.accepted_state(outcomes, ingest.wall_clock(at))
        days = sorted(r["date"] for r in accepted.select("date").collect())
        if days:
            documents = scanned.filter(F.col("date").isin(*days)).select(*schemas.TRAINS.names, "date")
            if "fct_timetable_events" in draft:
                refresh_days(warehouse, documents, days)
            else:
                warehouse.take(documents)
                build(warehouse)
            draft.append("state", accepted)
        draft.write("landed_files", seen)
    return days


def _bodies(files: DataFrame) -> DataFrame:
    """What a date consists of: the checksums of its bodies and whether all were accepted."""
    return files.groupBy("date").agg(
        F.struct(
            F.sort_array(F.collect_list("body_hash")).alias("hashes"),
            F.bool_and(F.col("reason") == ACCEPTED).alias("ok"),
        ).alias("bodies")
    )
