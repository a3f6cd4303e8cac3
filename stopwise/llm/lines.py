"""Line dedup by site-relative frequency: lines on a large part of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import same

#: A line goes when it is on more than this part of its host's pages ...
RATIO = 0.08
#: ... and on this many of them at least: on a host of one page every line is on all pages.
LEAST_PAGES = 5

_LINES, _TEXT = "__lines", "__texthash"


def _line_key(line: Column) -> Column:
    """128 bits of a trimmed line."""
    return F.unhex(F.md5(F.trim(line).cast("binary")))


def boilerplate(docs: DataFrame, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(source, line, pages, host_pages) of every line to drop; ``line`` is its 128-bit key.

    A page counts a line once, whatever its repeats; blank lines are never boilerplate. Counts are
    combined before each shuffle, so neither a hot host nor a hot line meets in one task.
    """
    hosts = docs.groupBy("source").agg(F.count("*").alias("host_pages"))
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))
    counted = (
        docs.select("source", F.explode(lines).alias("line"))
        .filter(F.col("line") != "")
        .groupBy("source", _line_key(F.col("line")).alias("line"))
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") >= least)
    )
    return (
        counted.alias("c").join(hosts.alias("h"), same("c", "h", "source"))
        .filter(F.col("pages") > F.col("host_pages") * ratio)
        .select("c.source", "line", "pages", "host_pages")
    )


def drop_boilerplate(docs: DataFrame, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``docs`` without boilerplate lines, plus n_lines and n_removed.

    ``docs`` needs doc_id, text and source (the host); all its columns and rows stay. Lines are
    compared trimmed and kept as they are. A null text stays null with no lines; a text of which
    every line goes becomes empty; a null source is a host of its own. Rows that share an id and
    a text get the same answer, and each stays.
    """
    found = boilerplate(docs, ratio, least)
    # Whether a document has lines to drop is decided on (id, position, key) alone; the texts
    # meet only the positions, of which boilerplate-free documents have none.
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias(_TEXT), "source",
        F.posexplode(F.transform(F.split("text", "\n", -1), _line_key)).alias("at", "line"),
    )
    gone = (
        keyed.alias("k").join(found.alias("f"), same("k", "f", "source") & (F.col("k.line") == F.col("f.line")))
        .groupBy("k.doc_id", "k.source", _TEXT)
        .agg(F.collect_set("at").alias("__gone"))
    )
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    stay = F.filter(F.col(_LINES), lambda x, i: ~F.array_contains(F.col("__gone"), i))
    return (
        docs.withColumn(_TEXT, F.xxhash64("text")).alias("d")
        .join(gone.alias("g"), same("d", "g", "doc_id", "source", _TEXT), "left")
        .select(
            *[f"d.{c}" for c in docs.columns],
            F.coalesce("__gone", none).alias("__gone"),
            lines.alias(_LINES),
        )
        .withColumn("n_lines", F.coalesce(F.size(_LINES), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.size("__gone").cast("bigint"))
        .withColumn(
            "text", F.when(F.size("__gone") > 0, F.array_join(stay, "\n")).otherwise(F.col("text"))
        )
        .drop("__gone", _LINES)
    )
