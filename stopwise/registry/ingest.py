"""Incremental ingestion and run state: ING-*."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators import ingest
from stopwise.plans.build import BuildFailed, build, result_rows
from stopwise.plans.daily import daily_run
from stopwise.plans.refresh import refresh_days, replace_documents
from stopwise.plans.warehouse import Sources, Warehouse
from stopwise.registry.sample import Sample
from stopwise.registry.sql import over
from stopwise.sources import documents as src
from stopwise.sources import sample_tables as bind
from stopwise.storage import save
from stopwise.streaming.new_days import CAUSES, EVENTS, read_new_bodies, stage_new_batches, staged

# The day the catch-up queries run on; given events end on 2024-01-30.
AS_OF = dt.date(2024, 2, 10)
MIDWAY = dt.date(2024, 1, 16)
# Seven days after this moment a day's fetch turns stale, to the second.
STALE_AS_OF = dt.datetime(2024, 2, 3)

# Re-fetched days: delays settle by some minutes, causes are withdrawn, all is gone, arrivals are.
SETTLED, NO_CAUSES, EMPTIED, NO_ARRIVALS = (dt.date(2024, 1, d) for d in (8, 9, 10, 11))
REFETCHED = (SETTLED, NO_CAUSES, EMPTIED, NO_ARRIVALS)
SETTLED_MINUTES = 2


def _validation(s: Sample) -> DataFrame:
    outcomes = ingest.validate_landing(s.spark, s.faulty_json_root)
    return outcomes.select("date", "files", "bad_files", "status", "num_trains")


def _state_log(s: Sample) -> DataFrame:
    """Fetches appended to the log in two runs; the latest per date is the state."""
    fetches = bind.fetches_from_events(s.given("events"))
    path = s.scratch("state")
    ingest.record_state(fetches.filter(F.col("fetched_at") < "2024-01-16"), path)
    log = ingest.record_state(fetches.filter(F.col("fetched_at") >= "2024-01-16"), path)
    return ingest.current_state(log)


def _accepted_events(s: Sample) -> DataFrame:
    accepted = ingest.accepted_documents(s.documents, s.state)
    return accepted.groupBy("date").agg(
        F.count("*").alias("documents"),
        F.sum(F.size("timeTableRows.type").cast("bigint")).alias("events"),
    )


def _loaded_dates(s: Sample) -> DataFrame:
    bounds = s.documents.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    return ingest.date_range(s.spark, bounds["a"], bounds["b"]).join(
        s.documents.groupBy("date").agg(F.count("*").alias("documents")), "date", "left"
    )


def _fetched_again(documents: DataFrame) -> DataFrame:
    day, rows = F.col("date"), F.col("timeTableRows")
    settled = F.transform(
        rows,
        lambda r: r.withField("differenceInMinutes", r["differenceInMinutes"] + SETTLED_MINUTES),
    )
    bare = F.transform(rows, lambda r: r.withField("causes", F.slice(r["causes"], 1, 0)))
    leaving = F.filter(rows, lambda r: r["type"] != "ARRIVAL")
    again = (
        F.when(day == SETTLED, settled).when(day == NO_CAUSES, bare).when(day == NO_ARRIVALS, leaving)
    )
    return documents.filter(day.isin(*REFETCHED) & (day != EMPTIED)).withColumn("timeTableRows", again)


def _copy_of_documents(s: Sample, root: str) -> DataFrame:
    return save(s.documents, f"{root}/documents", "date")


def _refetch(s: Sample) -> DataFrame:
    """Re-fetched days replace theirs in all three tables; other days stay."""
    root = s.scratch("refetch")
    documents = _copy_of_documents(s, root)
    sources = Sources(
        documents,
        s.warehouse.sources.stations,
        s.warehouse.sources.cause_codes,
        s.warehouse.sources.detailed_cause_codes,
    )
    warehouse = Warehouse(sources, f"{root}/warehouse", s.settings)
    warehouse.fct_delay_causes, warehouse.agg_station_punctuality  # noqa: B018 - built here
    warehouse.service_days  # noqa: B018 - built here
    landed = replace_documents(
        _fetched_again(s.documents), f"{root}/documents", list(REFETCHED)
    )
    refresh_days(warehouse, landed, list(REFETCHED))
    events = warehouse.fct_timetable_events.groupBy("source_ingest_date").agg(
        F.count("*").alias("events"), F.sum("delay_minutes").alias("minutes")
    )
    causes = warehouse.fct_delay_causes.groupBy("source_ingest_date").agg(
        F.count("*").alias("causes")
    )
    days = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("source_ingest_date")
    arrivals = warehouse.agg_station_punctuality.groupBy(days).agg(
        F.sum("measured_arrivals").alias("measured"), F.max("worst_delay_minutes").alias("worst")
    )
    return events.join(causes, "source_ingest_date", "left").join(
        arrivals, "source_ingest_date", "left"
    )


def _stale(s: Sample) -> DataFrame:
    """Age of each user's last fetch against the allowed age, the boundary second included."""
    fetched = s.given("events").groupBy(F.col("user_id").alias("file")).agg(
        F.max(F.date_trunc("day", "ts")).cast("timestamp_ntz").alias("fetched_at")
    )
    return ingest.stale(fetched, STALE_AS_OF, s.settings.metadata_max_age_days)


def _run_log(s: Sample) -> DataFrame:
    return ingest.run_log_row(
        s.state,
        s.warehouse.fct_timetable_events,
        s.warehouse.fct_delay_causes,
        dates=10,
        status="PASS",
        at=dt.datetime(2024, 2, 10, 6, 30),
    )


def _stream(s: Sample) -> DataFrame:
    """Two runs of the file stream over landed JSON, at both grains; the second sees only days
    landed in between, and one of the first delivered once more. The facts are built from what it
    has staged."""
    root = s.scratch("stream")
    landing = f"{root}/landing"
    early, again = F.dayofmonth("date") <= 15, F.dayofmonth("date") == 10
    for part in (early, ~early | again):
        src.write_landing(s.json_arrays.filter(part), landing)
        stage_new_batches(read_new_bodies(s.spark, landing), f"{root}/staged", f"{root}/seen", s.settings)
    warehouse = Warehouse(s.warehouse.sources, f"{root}/warehouse", s.settings)
    warehouse.use_staged(staged(s.spark, f"{root}/staged", EVENTS), staged(s.spark, f"{root}/staged", CAUSES))
    causes = warehouse.fct_delay_causes.groupBy("source_ingest_date").agg(
        F.count("*").alias("cause_rows")
    )
    return (
        warehouse.fct_timetable_events.groupBy("source_ingest_date")
        .agg(
            F.count("*").alias("events"),
            F.countDistinct("event_key").alias("event_keys"),
            F.sum("cause_count").alias("causes"),
        )
        .join(causes, "source_ingest_date", "left")
    )


def _accepted_build(s: Sample) -> DataFrame:
    """A build over the spoiled landing: only accepted days reach the tables, day by day."""
    given = s.warehouse.sources
    landed = Sources(
        src.read_documents(s.spark, s.faulty_json_root),
        given.stations, given.cause_codes, given.detailed_cause_codes,
    )
    warehouse = Warehouse(landed, s.scratch("accepted"), s.settings)
    try:
        build(warehouse, s.state)
    except BuildFailed as stopped:
        return result_rows(s.spark, stopped.failures)
    causes = warehouse.fct_delay_causes.groupBy("source_ingest_date").agg(
        F.count("*").alias("causes")
    )
    return (
        warehouse.fct_timetable_events.groupBy("source_ingest_date")
        .agg(F.count("*").alias("events"), F.sum("cause_count").alias("listed"))
        .join(causes, "source_ingest_date", "left")
    )


def _rebuilt(s: Sample) -> DataFrame:
    """A second full build into a used root, after a day has left the documents."""
    root = s.scratch("rebuilt")
    given = s.warehouse.sources
    sources = Sources(s.documents, given.stations, given.cause_codes, given.detailed_cause_codes)
    build(Warehouse(sources, f"{root}/warehouse", s.settings))
    left = Sources(
        s.documents.filter(F.col("date") != EMPTIED),
        given.stations, given.cause_codes, given.detailed_cause_codes,
    )
    again = Warehouse(left, f"{root}/warehouse", s.settings)
    build(again)
    return (
        again.fct_timetable_events.groupBy("source_ingest_date").agg(F.count("*").alias("events"))
    )


def _build(s: Sample) -> DataFrame:
    """A fresh build: check outcomes, and the rows of its last table if it got there."""
    warehouse = Warehouse(s.warehouse.sources, s.scratch("build"), s.settings)
    try:
        results = build(warehouse)
    except BuildFailed as stopped:
        failed = result_rows(s.spark, stopped.results)
        return failed.groupBy("status").agg(F.count("*").alias("n"))
    checks = results.groupBy("status").agg(F.count("*").alias("n"))
    tables = warehouse.agg_station_punctuality.agg(F.count("*").alias("n"))
    return checks.unionByName(tables.withColumn("status", F.lit("aggregate rows")))


def _daily_runs(s: Sample) -> DataFrame:
    """Three runs over the spoiled landing: a build, a refresh, and one with nothing new."""
    root = s.scratch("daily")
    warehouse = Warehouse(s.warehouse.sources, f"{root}/warehouse", s.settings)
    for day, as_of in ((16, MIDWAY), (17, AS_OF), (18, AS_OF)):
        log = daily_run(
            warehouse, s.faulty_json_root, root, dt.datetime(2024, 2, day, 6, 30), as_of
        )
    return log


QUERIES = {
    "ing_1_current_state": _state_log,
    "ing_2_validate_landing": _validation,
    "ing_2_accepted_documents": _accepted_events,
    "ing_3_catch_up_window": lambda s: ingest.catch_up_window(s.state, AS_OF),
    "ing_3_catch_up_dates": lambda s: ingest.catch_up_dates(s.state, AS_OF),
    "ing_4_missing_dates": lambda s: ingest.missing_dates(s.state, AS_OF),
    "ing_5_date_range": _loaded_dates,
    "ing_6_refetched_days": _refetch,
    "ing_7_stale_metadata": _stale,
    "ing_8_outcome_summary": lambda s: ingest.outcome_summary(s.outcomes),
    "ing_9_run_log": _run_log,
    "ing_9_daily_runs": _daily_runs,
    "ing_10_new_days_stream": _stream,
    "ing_11_build": _build,
    "ing_11_build_of_accepted_days": _accepted_build,
    "ing_11_second_full_build": _rebuilt,
}

_OUTCOMES = """
outcomes AS (
  SELECT ingest_date AS date, count(DISTINCT slice) AS files,
         CASE day(ingest_date) % 10 WHEN 3 THEN 'malformed' WHEN 5 THEN 'empty'
              WHEN 7 THEN 'not_an_array' ELSE 'accepted' END AS status,
         count(DISTINCT (train_number, slice)) AS documents, count(*) AS events
  FROM raw GROUP BY 1
),
state AS (SELECT * FROM outcomes WHERE status = 'accepted')
"""

_DATES_UNTIL_YESTERDAY = (
    "CAST(unnest(generate_series({first}, DATE '2024-02-09', INTERVAL 1 DAY)) AS DATE)"
)

ORACLES = {
    "ing_1_current_state": over(
        """
        SELECT date, fetched_at, response_bytes, 3 * num_trains AS gz_bytes, num_trains
        FROM (SELECT d AS date, max(ts) AS fetched_at,
                     CAST(sum(length('{"k": ' || k || '}')) AS BIGINT) AS response_bytes,
                     count(*) AS num_trains,
                     row_number() OVER (PARTITION BY d ORDER BY max(ts) DESC) AS nth
              FROM ev GROUP BY d, kind)
        WHERE nth = 1
        """
    ),
    "ing_2_validate_landing": over(
        """
        SELECT date, files, CASE status WHEN 'accepted' THEN 0 ELSE files END AS bad_files,
               status, CASE status WHEN 'accepted' THEN documents ELSE 0 END AS num_trains
        FROM outcomes
        """,
        _OUTCOMES,
    ),
    "ing_2_accepted_documents": over("SELECT date, documents, events FROM state", _OUTCOMES),
    "ing_3_catch_up_window": over(
        """
        SELECT max(date) AS watermark, max(date) + 1 AS first_date,
               DATE '2024-02-09' AS last_date,
               greatest(DATE '2024-02-09' - max(date), 0) AS dates
        FROM state
        """,
        _OUTCOMES,
    ),
    "ing_3_catch_up_dates": over(
        f"""
        SELECT {_DATES_UNTIL_YESTERDAY.format(first="(SELECT max(date) + 1 FROM state)")} AS date
        """,
        _OUTCOMES,
    ),
    "ing_4_missing_dates": over(
        f"""
        SELECT date FROM (
          SELECT {_DATES_UNTIL_YESTERDAY.format(first="(SELECT min(date) FROM state)")} AS date)
        WHERE date NOT IN (SELECT date FROM state)
        """,
        _OUTCOMES,
    ),
    "ing_5_date_range": over(
        "SELECT d.date, o.documents FROM dim_date d LEFT JOIN outcomes o ON o.date = d.date",
        _OUTCOMES,
    ),
    "ing_6_refetched_days": over(
        f"""
        SELECT source_ingest_date, count(*) AS events, CAST(sum(delay) AS BIGINT) AS minutes,
               CAST(nullif(sum(cause_count) FILTER (WHERE source_ingest_date <> '{NO_CAUSES}'), 0)
                    AS BIGINT) AS causes,
               CAST(sum(CAST(ok AND (delay IS NULL OR delay BETWEEN -60 AND 1440) AS INTEGER))
                    FILTER (WHERE arrived) AS BIGINT) AS measured,
               max(delay) FILTER (WHERE ok AND arrived AND delay BETWEEN -60 AND 1440) AS worst
        FROM (SELECT *, event_type = 'ARRIVAL' AND is_commercial_stop AS arrived,
                     has_actual_time AND NOT is_cancelled AS ok,
                     delay_minutes
                       + CASE WHEN source_ingest_date = '{SETTLED}'
                              THEN {SETTLED_MINUTES} ELSE 0 END AS delay
              FROM stg
              WHERE source_ingest_date <> '{EMPTIED}'
                AND NOT (source_ingest_date = '{NO_ARRIVALS}' AND event_type = 'ARRIVAL'))
        GROUP BY 1
        """
    ),
    "ing_7_stale_metadata": """
        SELECT user_id AS file, date_trunc('day', max(ts)) AS fetched_at,
               date_trunc('day', max(ts)) <= TIMESTAMP '2024-02-03' - INTERVAL 7 DAY AS is_stale
        FROM events GROUP BY user_id
    """,
    "ing_8_outcome_summary": over(
        """
        SELECT status, count(*) AS dates,
               CAST(sum(CASE status WHEN 'accepted' THEN documents ELSE 0 END) AS BIGINT)
                 AS num_trains
        FROM outcomes GROUP BY 1
        """,
        _OUTCOMES,
    ),
    "ing_9_run_log": over(
        """
        SELECT TIMESTAMP '2024-02-10 06:30:00' AS run_at, CAST(10 AS BIGINT) AS dates,
               (SELECT max(date) FROM state) AS watermark,
               (SELECT count(*) FROM fct) AS event_rows,
               (SELECT count(*) FROM fct_causes) AS cause_rows, 'PASS' AS status
        """,
        _OUTCOMES,
    ),
    "ing_10_new_days_stream": over(
        """
        SELECT source_ingest_date, count(*) AS events,
               count(DISTINCT event_key) AS event_keys,
               CAST(sum(cause_count) AS BIGINT) AS causes,
               CAST(nullif(sum(cause_count), 0) AS BIGINT) AS cause_rows
        FROM stg GROUP BY 1
        """
    ),
    "ing_9_daily_runs": over(
        f"""
        SELECT run_at, (SELECT count(*) FROM state WHERE date < upto AND date >= since) AS dates,
               (SELECT max(date) FROM state WHERE date < upto) AS watermark,
               (SELECT count(*) FROM stg WHERE source_ingest_date < upto
                AND source_ingest_date IN (SELECT date FROM state)) AS event_rows,
               (SELECT CAST(sum(cause_count) AS BIGINT) FROM stg WHERE source_ingest_date < upto
                AND source_ingest_date IN (SELECT date FROM state)) AS cause_rows, status
        FROM (VALUES
          (TIMESTAMP '2024-02-16 06:30:00', DATE '2000-01-01', DATE '{MIDWAY}', 'PASS'),
          (TIMESTAMP '2024-02-17 06:30:00', DATE '{MIDWAY}', DATE '{AS_OF}', 'PASS'),
          (TIMESTAMP '2024-02-18 06:30:00', DATE '{AS_OF}', DATE '{AS_OF}', 'NOTHING NEW')
        ) runs(run_at, since, upto, status)
        """,
        _OUTCOMES,
    ),
    "ing_11_build_of_accepted_days": over(
        """
        SELECT source_ingest_date, count(*) AS events, CAST(sum(cause_count) AS BIGINT) AS listed,
               CAST(nullif(sum(cause_count), 0) AS BIGINT) AS causes
        FROM stg WHERE source_ingest_date IN (SELECT date FROM state) GROUP BY 1
        """,
        _OUTCOMES,
    ),
    "ing_11_second_full_build": over(
        f"""
        SELECT source_ingest_date, count(*) AS events FROM stg
        WHERE source_ingest_date <> '{EMPTIED}' GROUP BY 1
        """
    ),
    "ing_11_build": over(
        """
        SELECT 'pass' AS status, CAST(44 AS BIGINT) AS n
        UNION ALL SELECT 'warn', 4
        UNION ALL SELECT 'aggregate rows', (SELECT count(*) FROM punctuality)
        """
    ),
}
