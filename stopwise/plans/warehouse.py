"""The built tables: landed documents to staging views to dimensions and facts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stopwise.operators import dimensions, facts, punctuality, staging
from stopwise.operators.ingest import accepted_documents
from stopwise.settings import Settings
from stopwise.snapshots import Draft, TableSet
from stopwise.storage import gathered


@dataclass(frozen=True)
class Sources:
    """Raw inputs, as landed."""

    documents: DataFrame
    stations: DataFrame
    cause_codes: DataFrame
    detailed_cause_codes: DataFrame


class Warehouse:
    """Staging stays lazy (SNK-1); dimensions, facts and the aggregate are tables (SNK-2).

    A table is written on first use and read back, so whatever is derived from it starts at a scan
    with real statistics and a short lineage. Tables belong to versions: what is written within
    ``writing`` becomes visible at once when that ends, or not at all; a table written outside is a
    version of its own. ``opened`` reads the latest version.
    """

    TABLES = (
        "dim_station",
        "dim_date",
        "dim_train_type",
        "dim_cause",
        "fct_timetable_events",
        "fct_delay_causes",
        "agg_station_punctuality",
        "service_days",
        "delay_counts",
    )
    #: Those of the star; the others help to keep it.
    STAR = TABLES[:7]

    def __init__(self, sources: Sources, root: str, settings: Settings = Settings()):
        self.sources = sources
        self.root = root
        self.settings = settings
        self.tables = TableSet(sources.documents.sparkSession, root)
        self._draft: Draft | None = None

    @classmethod
    def opened(cls, sources: Sources, root: str, settings: Settings = Settings()) -> "Warehouse":
        warehouse = cls(sources, root, settings)
        warehouse.reopen()
        return warehouse

    def reopen(self) -> None:
        """Read the tables of the latest version, without building any."""
        self.forget()
        latest = self.tables.version()
        for name in self.TABLES:
            if name in latest:
                self.__dict__[name] = latest.read(name)
        if "documents" in latest:
            self.take(latest.read("documents"))

    def forget(self) -> None:
        """Derive staging and tables anew on their next use."""
        for name in [n for n in self.__dict__ if n.startswith("stg_") or n == "headers" or n in self.TABLES]:
            del self.__dict__[name]

    @contextmanager
    def writing(self) -> Iterator[Draft]:
        """A draft of the next version: published at the end, dropped when anything fails.

        After a failure the warehouse reads the latest version, as everyone else does.
        """
        if self._draft is not None:  # within an outer one, which decides
            yield self._draft
            return
        self._draft = self.tables.draft()
        sources = self.sources
        try:
            yield self._draft
            self._draft.publish()
        except BaseException:
            self._draft.drop()
            self.sources = sources
            self.reopen()
            raise
        finally:
            self._draft = None

    def hold(self, name: str, table: DataFrame) -> None:
        """Read this for a table from here on."""
        self.__dict__[name] = table

    @property
    def spark(self) -> SparkSession:
        return self.sources.documents.sparkSession

    def take(self, documents: DataFrame) -> None:
        """Use these documents from here on."""
        self.sources = replace(self.sources, documents=documents)

    def use_staged(self, events: DataFrame, causes: DataFrame) -> None:
        """Read staging that a stream has written instead of flattening the documents again."""
        self.__dict__["stg_timetable_events"] = events
        self.__dict__["stg_event_keys"] = events.select("event_key")
        self.__dict__["stg_delay_causes"] = causes

    def store_documents(self, state: DataFrame | None = None) -> None:
        """Parse the landed documents once: from here on they are a Parquet table by date.

        With ``state``, only documents of its dates, the accepted ones, are taken.
        """
        taken = self.sources.documents
        if state is not None:
            taken = accepted_documents(taken, state)
        self.take(self._table("documents", gathered(taken, "date"), "date"))

    def _table(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        with self.writing() as draft:
            return draft.write(name, df, partition_by)

    def keys(self, name: str, rows: DataFrame, by: list[str]) -> DataFrame:
        """The key map of a dimension, extended by natural keys that it lacks.

        It outlives full builds, so a key means the same before and after one.
        """
        table = f"key_{name}"
        with self.writing() as draft:
            known = draft.read(table) if table in draft else None
            if known is not None and dimensions.lacking(known, rows, by).isEmpty():
                return known
            extended = dimensions.extended_keys(known, rows, f"{name}_key", by)
            return draft.write(table, extended)

    @cached_property
    def stg_timetable_events(self) -> DataFrame:
        return staging.timetable_events(self.sources.documents, self.settings)

    @cached_property
    def stg_event_keys(self) -> DataFrame:
        """Keys of the staged events, without the columns that checks never read."""
        return staging.event_keys(self.sources.documents)

    @cached_property
    def stg_delay_causes(self) -> DataFrame:
        return staging.delay_causes(self.sources.documents)

    @cached_property
    def stg_stations(self) -> DataFrame:
        return staging.stations(self.sources.stations)

    @cached_property
    def stg_cause_codes(self) -> DataFrame:
        return staging.cause_codes(self.sources.cause_codes)

    @cached_property
    def stg_cause_codes_detailed(self) -> DataFrame:
        return staging.detailed_cause_codes(self.sources.detailed_cause_codes)

    @cached_property
    def headers(self) -> DataFrame:
        return staging.event_headers(self.sources.documents)

    @cached_property
    def dim_station(self) -> DataFrame:
        with self.writing():
            keys = self.keys("station", self.stg_stations, dimensions.STATION)
            return self._table("dim_station", dimensions.station(self.stg_stations, keys))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._table("dim_date", dimensions.date(self.headers))

    @cached_property
    def dim_train_type(self) -> DataFrame:
        with self.writing():
            keys = self.keys("train_type", self.headers, dimensions.TRAIN_TYPE)
            return self._table("dim_train_type", dimensions.train_type(self.headers, keys))

    @cached_property
    def dim_cause(self) -> DataFrame:
        with self.writing():
            keys = self.keys("cause", self.stg_cause_codes, dimensions.CAUSE)
            return self._table("dim_cause", dimensions.cause(self.stg_cause_codes, keys))

    @cached_property
    def fct_timetable_events(self) -> DataFrame:
        fact = facts.timetable_events(
            self.stg_timetable_events, self.dim_station, self.dim_train_type, self.dim_date
        )
        # Lookups that shuffle scatter dates over tasks.
        return self._table(
            "fct_timetable_events", gathered(fact, "source_ingest_date"), "source_ingest_date"
        )

    @cached_property
    def fct_delay_causes(self) -> DataFrame:
        fact = facts.delay_causes(
            self.stg_delay_causes, self.fct_timetable_events, self.dim_cause
        )
        # The join on event keys scatters dates over tasks.
        return self._table(
            "fct_delay_causes", gathered(fact, "source_ingest_date"), "source_ingest_date"
        )

    @cached_property
    def agg_station_punctuality(self) -> DataFrame:
        agg = punctuality.punctuality_of_counts(self.delay_counts, self.settings)
        return self._table("agg_station_punctuality", gathered(agg, "date_key"), "date_key")

    @cached_property
    def delay_counts(self) -> DataFrame:
        """Arrivals by station, date, train type, flags and minute: what distributions are read from."""
        counts = punctuality.delay_counts(self.fct_timetable_events)
        return self._table("delay_counts", gathered(counts, "date_key"), "date_key")

    @cached_property
    def service_days(self) -> DataFrame:
        """Which service days the events of each landed day belong to."""
        days = punctuality.service_days(self.fct_timetable_events)
        return self._table("service_days", gathered(days, "source_ingest_date"), "source_ingest_date")
