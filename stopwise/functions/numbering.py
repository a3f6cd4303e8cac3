"""Row numbers that do not funnel a large table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.storage import ensure_checkpoint_dir

_SLICE = "__slice"
_LOCAL = "__local"
_BEFORE = "__before"
_AHEAD = "__ahead"


def number_rows(df: DataFrame, name: str, order_by: list[str]) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... over the whole table, in ``order_by`` order (NULLs last).

    ``order_by`` must be a total order. Rows are range-partitioned on it, numbered inside each
    slice, and shifted by the sizes of the earlier slices; only these sizes meet in one task. Both
    readers must see the same slices, so the sliced rows are kept in the checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(c).asc_nulls_last() for c in order_by]
    sliced = (
        df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id()).checkpoint()
    )
    earlier = W.orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(_SLICE)
        .agg(F.count("*").alias("n"))
        .select(_SLICE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    local = F.row_number().over(W.partitionBy(_SLICE).orderBy(*order))
    return (
        sliced.withColumn(_LOCAL, local)
        .join(offsets, _SLICE)
        .withColumn(name, (F.col(_LOCAL) + F.col(_BEFORE)).cast("bigint"))
        .drop(_SLICE, _LOCAL, _BEFORE)
    )


def running_total(
    df: DataFrame, name: str, value: str, order_by: list[str], within: list[str], overall: str | None = None
) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the rows before this one in its ``within`` group.

    ``order_by`` must be a total order that begins with ``within``. As in ``number_rows``, rows are
    cut into ranges and a group that goes on over several of them is never in one task; only one
    sum per group and range is. With ``overall``, that column is the sum over the rows of earlier
    groups as well.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(c).asc_nulls_last() for c in order_by]
    sliced = df.repartitionByRange(*order).withColumn(_SLICE, F.spark_partition_id()).checkpoint()
    sums = sliced.groupBy(_SLICE, *within).agg(F.sum(value).alias("n"))
    earlier = W.partitionBy(*within).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(_SLICE, *within, "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    if overall:
        groups = W.orderBy(_SLICE, *[F.col(c).asc_nulls_last() for c in within])
        ahead = F.sum("n").over(groups.rowsBetween(W.unboundedPreceding, -1))
        carried = carried.withColumn(_AHEAD, F.coalesce(ahead, F.lit(0)))
    before = W.partitionBy(_SLICE, *within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(before), F.lit(0))
    rows, more = sliced.withColumn(_LOCAL, local).alias("r"), carried.alias("c")
    same = F.col(f"r.{_SLICE}") == F.col(f"c.{_SLICE}")
    for c in within:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
    found = {name: _BEFORE, overall: _AHEAD} if overall else {name: _BEFORE}
    totals = [(F.col(_LOCAL) + F.col(c)).cast("bigint").alias(n) for n, c in found.items()]
    return rows.join(more, same).select(*[F.col(f"r.{c}") for c in df.columns], *totals)


def number_within(df: DataFrame, name: str, order_by: list[str], within: list[str]) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... inside each ``within`` group, whose rows meet in one task.

    For groups that cannot grow with the table, such as the stops of one train on one date.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    window = W.partitionBy(*within).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))
