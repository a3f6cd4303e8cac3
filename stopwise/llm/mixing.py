"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

DataFrame operations only. Slot k of the schedule has the point k * A mod M of a golden-ratio
sequence; the cumulative targets of the sources cut [0, M) into intervals, and the interval a
point falls into names the slot's source. The j-th slot of a source takes the j-th block of that
source's line of tokens: its documents in hashed order, repeated as often as needed. Slots beyond a
source's target are passed over, its last block is cut at the target, and a source whose interval
has met too few points, as a small one may, is served afterwards, so every source is given its
target to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.functions.numbering import number_rows
from stopwise.llm.common import kept, same

#: Words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: Words a slot takes. Larger blocks make a shorter, coarser schedule.
BLOCK = 64
#: The golden-ratio step over M = 2^31 points; odd, so a period meets every point once.
POINTS = 1 << 31
STEP = 1_327_217_885
#: Rows that are put in order together, about: of slots, of points in a cell, of a hot source's documents.
ROWS = 1 << 16


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) for (source, source_size): one row per source in and out.

    Water filling: every source gets level * weight unless that is above ``most`` times its size.
    Raising the level only ever adds capped sources, so it settles after few rounds; each round is
    one aggregate over the sources, of which one row comes back.
    """
    ranked = number_rows(sizes.withColumn("__null", F.col("source").isNull()), "__rank", ["__null", "source"])
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("__rank") - 1) % len(weights)).cast("int"))
    rows = kept(
        ranked.select(
            "source", "source_size", weight.cast("bigint").alias("weight"),
            (F.col("source_size") * most).alias("cap"), "__rank",
        )
    )
    over, level = F.lit(False), None
    while True:
        got = rows.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, F.col("cap")).otherwise(F.lit(0))).alias("capped"),
            F.sum(F.when(over, F.lit(0)).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(over, F.lit(1)).otherwise(F.lit(0))).alias("n"),
        ).first()
        if not got["weight"] or got["total"] is None:
            break
        found = (got["total"] - got["capped"], got["weight"], got["n"])
        if level is not None and found[2] == level[2]:
            break
        level = found
        # level * weight > cap, in whole numbers
        over = F.lit(level[0]).cast("decimal(38,0)") * F.col("weight") > F.lit(level[1]).cast(
            "decimal(38,0)"
        ) * F.col("cap")
    free = (
        F.lit(float(level[0])) * F.col("weight") / F.lit(float(level[1])) if level else F.lit(0.0)
    )
    target = F.when(over, F.col("cap").cast("double")).otherwise(free)
    return rows.select("source", "source_size", target.cast("double").alias("target"), "__rank")


def stop(target: Column) -> Column:
    """Words a source is given: its target, to the nearest word."""
    return F.round(target).cast("bigint")


def schedule(shares: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, turn): which source's which block fills each slot of the mix.

    ``shares`` has source_no and target. Slots and cumulative targets meet in cells of the point
    range, so neither side is held whole anywhere. A source has the turns its target takes: those
    its points lack fill slots of their own after the others.
    """
    spark = shares.sparkSession
    upto = F.sum("target").over(W.partitionBy("__part").orderBy("__rank"))
    # Running totals in two steps: inside ranges of ranks, then over the ranges.
    parts = shares.withColumn("__part", F.floor(F.col("__rank") / 4096))
    local = parts.withColumn("__upto", upto)
    before = F.coalesce(
        F.sum("sum").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    earlier = parts.groupBy("__part").agg(F.sum("target").alias("sum")).select("__part", before.alias("__before"))
    edge = lambda c: F.round(c / F.lit(float(max(total, 1))) * POINTS).cast("bigint")
    cuts = local.join(earlier, "__part").select(
        "source_no",
        edge(F.col("__before") + F.col("__upto") - F.col("target")).alias("lo"),
        edge(F.col("__before") + F.col("__upto")).alias("hi"),
    ).filter("lo < hi")
    slots = -(-total // block)
    width = POINTS // min(POINTS, 1 << max(0, (slots // ROWS).bit_length()))
    cells = cuts.select(
        "*", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell")
    )
    point = (F.col("id") % POINTS) * STEP % POINTS
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    placed = points.join(
        cells, (points["cell"] == cells["cell"]) & (F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi"))
    ).select("slot", "source_no")
    turns = kept(_ranked(placed, "source_no", "slot", "turn"))
    needed = shares.select("source_no", F.ceil(stop(F.col("target")) / block).alias("needed"))
    had = turns.groupBy("source_no").agg(F.count("*").alias("had"))
    lacking = (
        needed.join(had, "source_no", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < needed")
    )
    late = lacking.select("source_no", F.explode(F.sequence("had", F.col("needed") - 1)).alias("turn"))
    late = number_rows(late, "late", ["source_no", "turn"])
    late = late.select((F.col("late") + (slots - 1)).alias("slot"), "source_no", "turn")
    return turns.join(needed, "source_no").filter("turn < needed").select("slot", "source_no", "turn").unionByName(late)


def _ranked(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Rank from 0 within a group, laid out in ranges of the order so that no group is one task."""
    cut = df.withColumn("__b", F.floor(F.col(order) / ROWS))
    local = cut.withColumn("__l", F.row_number().over(W.partitionBy(group, "__b").orderBy(order)))
    before = F.coalesce(
        F.sum("n").over(W.partitionBy(group).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    earlier = cut.groupBy(group, "__b").agg(F.count("*").alias("n")).select(group, "__b", before.alias("__before"))
    return local.join(earlier, [group, "__b"]).select(
        order, group, (F.col("__before") + F.col("__l") - 1).cast("bigint").alias(name)
    )


def laid_out(docs: DataFrame) -> tuple[DataFrame, int]:
    """(documents, total words): every document's place in its source's shuffled line of words.

    Columns: doc_id, source, size, source_no, source_size, target, offset. The order is that of a
    hash of the id, so reruns agree; a line is laid out in hashed buckets of some ROWS documents.
    """
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    digits = 1 + ((docs.count() // ROWS).bit_length() + 3) // 4
    sized = kept(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), h.alias("__h"))
        .withColumn("__b", F.substring("__h", 1, digits))
    )
    buckets = kept(sized.groupBy("source", "__b").agg(F.sum("size").alias("words")))
    shares = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")))
    total = buckets.agg(F.sum("words")).first()[0] or 0
    earlier = W.partitionBy("source").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        buckets.withColumn("__before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).alias("b")
        .join(shares.alias("s"), same("b", "s", "source"))
        .select("b.source", "__b", "__before", "source_size", "target", F.col("__rank").alias("source_no"))
    )
    inside = W.partitionBy("source", "__b").orderBy("__h", "doc_id", "size")
    inside = inside.rowsBetween(W.unboundedPreceding, -1)
    lines = sized.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = lines.alias("l").join(placed.alias("p"), same("l", "p", "source", "__b")).select(
        "doc_id", "l.source", "size", "source_no", "source_size", "target",
        (F.col("__before") + F.col("__in")).alias("offset"),
    )
    return kept(out), total


def mixture(lines: DataFrame, total: int, block: int = BLOCK, most: int = MOST_REPEATS) -> DataFrame:
    """The mix: one row per slot and document piece in it.

    slot, source_no, turn, offset (of the document), repeat, from, words: the slot takes ``words``
    words of the document, from its word ``from`` on.
    """
    shares = lines.groupBy("source_no").agg(F.first("target").alias("target"))
    shares = shares.withColumn("__rank", F.col("source_no"))
    plan = schedule(shares, total, block)
    start = F.col("repeat") * F.col("source_size") + F.col("offset")
    end = stop(F.col("target"))
    pieces = (
        lines.filter("size > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("repeat"))
        .withColumn("__start", start)
        .withColumn("__end", F.least(F.col("__start") + F.col("size"), end))
        .filter("__start < __end")
        .select(
            "source_no", "offset", "repeat", "__start", "__end",
            F.explode(
                F.sequence(F.floor(F.col("__start") / block), F.floor((F.col("__end") - 1) / block))
            ).alias("turn"),
        )
    )
    first = F.greatest(F.col("__start"), F.col("turn") * block)
    last = F.least("__end", (F.col("turn") + 1) * block)
    return pieces.join(plan, ["source_no", "turn"]).select(
        "slot", "source_no", "turn", "offset", "repeat",
        (first - F.col("__start")).alias("from"), (last - first).alias("words"),
    )


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Words the mix takes of every document.

    ``docs`` needs doc_id, text and source; other columns are ignored. One row per input row:
    doc_id, source, size, source_size, target, taken. Null and empty texts have size 0 and are
    never taken; a null source is a source of its own, ordered last; repeated rows are rows of
    their own; no rows in, none out.
    """
    lines, total = laid_out(docs)
    taken = mixture(lines, total, block).groupBy("source_no", "offset").agg(F.sum("words").alias("taken"))
    # A place in a line belongs to one document with words; those without take nothing.
    keyed = F.when(F.col("size") > 0, F.col("offset"))
    return (
        lines.withColumn("__at", keyed).alias("l")
        .join(
            taken.alias("t"),
            (F.col("l.source_no") == F.col("t.source_no")) & (F.col("__at") == F.col("t.offset")),
            "left",
        )
        .select(
            "doc_id", "source", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        )
    )
