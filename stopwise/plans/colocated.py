"""Event keys of both grains, bucketed alike: key checks and the cause join without a shuffle.

The keys of the event fact and the rows of the cause fact are written once into tables bucketed and
sorted by event key. Uniqueness, the relationship between the grains and the join of causes to
their events then read matching buckets side by side; each would shuffle both facts otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stopwise.operators import facts, quality
from stopwise.plans.warehouse import Warehouse
from stopwise.storage import file_system, fresh_dir


class KeyTables:
    """``events`` (event_key, cause_count) and ``causes``, in ``buckets`` buckets by event key.

    The files live in the shared folder until ``drop``. The session's catalog names a table only
    while it is written: the readers returned hold its files and buckets, so nothing stays behind.
    """

    def __init__(self, events: DataFrame, causes: DataFrame, buckets: int | None = None):
        self.spark: SparkSession = events.sparkSession
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._root, self._id = fresh_dir(self.spark, "keys"), uuid.uuid4().hex[:12]
        self.events = self._write("events", events.select("event_key", "cause_count"))
        self.causes = self._write("causes", causes)

    @classmethod
    def of(cls, warehouse: Warehouse, buckets: int | None = None) -> KeyTables:
        return cls(warehouse.fct_timetable_events, warehouse.fct_delay_causes, buckets)

    def _write(self, name: str, rows: DataFrame) -> DataFrame:
        table = f"keys_{self._id}_{name}"
        # One shuffle into the buckets, so that a bucket is one file and stays sorted.
        placed = rows.repartition(self.buckets, "event_key")
        writer = placed.write.bucketBy(self.buckets, "event_key").sortBy("event_key")
        writer.option("path", f"{self._root}/{name}").saveAsTable(table)
        reader = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # an external one: its files stay
        return reader

    def repeated(self) -> DataFrame:
        """DQ-1. Event keys that occur more than once."""
        return quality.unique(self.events, "event_key")

    def orphans(self) -> DataFrame:
        """DQ-4. Cause rows whose event does not exist."""
        return self.causes.join(self.events.select("event_key"), "event_key", "left_anti")

    def known_causes(self) -> DataFrame:
        """FCT-5. Cause rows whose event exists."""
        return facts.known_causes(self.causes, self.events)

    def drop(self) -> None:
        files, at = file_system(self.spark, self._root)
        files.delete(at, True)
