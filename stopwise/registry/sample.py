"""The given tables as inputs: landed once per session and folder, then reused."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise import schemas
from stopwise.operators import ingest, profiling, staging
from stopwise.operators.analysis import Star
from stopwise.plans.warehouse import Sources, Warehouse
from stopwise.settings import Settings
from stopwise.sources import documents as src
from stopwise.sources import sample_tables as bind
from stopwise.storage import file_system, fresh_dir, save

SETTINGS = Settings(
    min_arrivals=50,
    quiet_hour_min_arrivals=100,
    # The given tables hold orphan stations and an unmapped cause on purpose.
    warn_only=frozenset(
        {
            "orphan_stations_stg_timetable_events",
            "relationships_fct_delay_causes_cause_category_code",
        }
    ),
)

RECORDS_PER_FILE = 4096

FETCHED_AT = dt.datetime(2024, 2, 10, 5, 0)


class Sample:
    """Inputs and built tables for one folder of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = fresh_dir(spark, "stopwise")
        self.settings = SETTINGS

    def given(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def scratch(self, label: str) -> str:
        """A folder of its own for a query that writes."""
        return fresh_dir(self.spark, f"stopwise-{label}")

    @cached_property
    def sliced_documents(self) -> DataFrame:
        """Landed documents, partitioned by service date, with their slice number."""
        return save(
            bind.documents_from_events(self.given("events")), f"{self.root}/documents", "date"
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self.sliced_documents.drop("slice")

    @cached_property
    def warehouse(self) -> Warehouse:
        sources = Sources(
            documents=self.documents,
            stations=bind.stations_from_suppliers(self.given("supplier")),
            cause_codes=bind.cause_codes_from_parts(self.given("part")),
            detailed_cause_codes=bind.detailed_cause_codes_from_parts(self.given("part")),
        )
        return Warehouse(sources, f"{self.root}/warehouse", self.settings)

    @cached_property
    def star(self) -> Star:
        return Star.of(self.warehouse)

    @cached_property
    def raw_trains(self) -> DataFrame:
        return profiling.raw_trains(self.documents)

    @cached_property
    def raw_events(self) -> DataFrame:
        return profiling.raw_events(self.raw_trains)

    @property
    def json_arrays(self) -> DataFrame:
        return src.json_arrays(bind.as_landed(self.sliced_documents), ["slice"])

    @cached_property
    def json_root(self) -> str:
        """The documents as gzipped JSON arrays in one folder per date."""
        root = f"{self.root}/json"
        src.write_landing(self.json_arrays, root)
        return root

    @cached_property
    def faulty_json_root(self) -> str:
        """The same, with the bodies of some dates spoiled."""
        root = f"{self.root}/json-faulty"
        src.write_landing(bind.with_faults(self.json_arrays), root)
        return root

    @cached_property
    def outcomes(self) -> DataFrame:
        """Outcome per date of the spoiled landing, validated once and stored."""
        found = ingest.validate_landing(self.spark, self.faulty_json_root)
        return save(found, f"{self.root}/outcomes")

    @cached_property
    def state(self) -> DataFrame:
        """The accepted dates, recorded and read back."""
        accepted = ingest.accepted_state(self.outcomes, ingest.wall_clock(FETCHED_AT))
        log = ingest.record_state(accepted, f"{self.root}/state")
        return ingest.current_state(log)

    @cached_property
    def json_documents(self) -> DataFrame:
        return src.read_documents(self.spark, self.json_root)

    def metadata_root(self, name: str) -> str:
        return getattr(self, f"_{name}_root")

    @cached_property
    def _stations_root(self) -> str:
        root = f"{self.root}/metadata/stations"
        key = F.floor((F.col("stationUICCode") - 1000) / RECORDS_PER_FILE)
        src.land_metadata(self.warehouse.sources.stations, root, key)
        return root

    @cached_property
    def _cause_codes_root(self) -> str:
        root = f"{self.root}/metadata/cause_codes"
        src.land_metadata(
            self.warehouse.sources.cause_codes, root, F.pmod(F.xxhash64("categoryCode"), F.lit(4))
        )
        return root

    @cached_property
    def _detailed_cause_codes_root(self) -> str:
        root = f"{self.root}/metadata/detailed_cause_codes"
        number = F.expr("cast(substring(detailedCategoryCode, 2) as bigint)")
        src.land_metadata(
            self.warehouse.sources.detailed_cause_codes, root, F.floor(number / RECORDS_PER_FILE)
        )
        return root

    @cached_property
    def volume_documents(self) -> DataFrame:
        """Orders and line items as documents."""
        return bind.documents_from_orders(self.given("orders"), self.given("lineitem"))

    @cached_property
    def volume_events(self) -> DataFrame:
        return staging.timetable_events(self.volume_documents, self.settings)

    def read_metadata(self, name: str) -> DataFrame:
        declared = {
            "stations": schemas.STATIONS,
            "cause_codes": schemas.CAUSE_CODES,
            "detailed_cause_codes": schemas.DETAILED_CAUSE_CODES,
        }
        return src.read_metadata(self.spark, self.metadata_root(name), declared[name])


_samples: dict[tuple, Sample] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the given tables: changed ones are other ones."""
    files, at = file_system(spark, sf_dir)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(at)))


def sample(spark: SparkSession, sf_dir: str) -> Sample:
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _samples:
        _samples[key] = Sample(spark, sf_dir)
    return _samples[key]
