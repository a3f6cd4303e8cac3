"""Benchmark decontamination: a hash set of test n-grams probed by every training window.

DataFrame operations only. Every document position makes the hash of the n words that start
there; a hash join finds the positions whose hash is in the set, and the words themselves are
compared before a position counts. Only hits, and one row per document, leave that stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.llm.common import ascii_lower, kept, same

#: Words of the contract: runs of digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: More windows than this are joined by shuffling both sides instead of broadcasting the set
#: (about 100 MB: a hash, the window's words and its length).
BROADCAST_WINDOWS = 500_000

_KEY, _COPY, _WORDS, _N = "__key", "__copy", "__words", "__n"


def words(text: Column) -> Column:
    """Normalised words of a text; a null text has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _window_hash(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, at + k) for k in range(length)])


def benchmark_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, length, hash, words) of every window; items of under n words are one window."""
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    long = split.filter(F.size("w") >= n).select(
        "item_id", "w", F.lit(n).alias("length"), F.posexplode("w").alias("at", "first")
    )
    long = long.filter(F.col("at") + n <= F.size("w")).select(
        "item_id", "length", F.slice("w", F.col("at") + 1, n).alias("window")
    )
    short = split.filter(F.size("w") < n).select(
        "item_id", F.size("w").alias("length"), F.col("w").alias("window")
    )
    hashed = reduce(
        lambda rest, k: F.when(F.size("window") == k, _window_hash(F.col("window"), F.lit(0), k))
        .otherwise(rest),
        range(1, n + 1),
        F.lit(None).cast("bigint"),
    )
    return (
        long.unionByName(short)
        .select("item_id", "length", hashed.alias("hash"), F.array_join("window", " ").alias("window"))
        .distinct()
    )


def hits(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(positions, windows): positions has one row per document and one per verified hit.

    Columns of positions: doc_id, ``__copy`` (hash of the text, so that different texts under one
    id stay apart), ``__n`` (number of words), at, length, window (null where nothing matched).
    A document's first position is always there, so documents without hits stay.
    """
    windows = benchmark_windows(items, n)
    found = windows.select("length", "hash", "window").distinct()
    sizes = found.groupBy("length").count().collect()  # at most n rows
    lengths = sorted(r["length"] for r in sizes) or [n]
    split = docs.select(
        "doc_id", F.xxhash64("text").alias(_COPY), words(F.col("text")).alias(_WORDS)
    )
    if sum(r["count"] for r in sizes) <= BROADCAST_WINDOWS:
        return _probed(split, F.broadcast(found), lengths, [_WORDS]), windows
    return _looked_up(split, found, lengths), windows


def _probed(split: DataFrame, found: DataFrame, lengths: list[int], carried: list[str]) -> DataFrame:
    """Every position against the set; the words are compared where they are carried along.

    Carrying them costs nothing as long as the join stays in the stage that splits the text.
    """
    at = split.select(
        "doc_id", _COPY, F.size(_WORDS).alias(_N), _WORDS, F.posexplode_outer(_WORDS).alias("at", "w")
    )
    w, pos = F.col(_WORDS), F.col("at")
    hashed = [
        F.when(pos + k <= F.col(_N), _window_hash(w, pos, k)).alias(f"__h{k}") for k in lengths
    ]
    own = ["doc_id", _COPY, _N, "at", *carried]
    if len(lengths) == 1:
        probes = at.select(*own, hashed[0].alias("__probe"), F.lit(lengths[0]).alias("__length"))
    else:
        pairs = F.array(*[F.struct(h.alias("h"), F.lit(k).alias("k")) for h, k in zip(hashed, lengths)])
        probes = at.select(*own, F.explode(pairs).alias("__pair")).select(
            *own, F.col("__pair.h").alias("__probe"), F.col("__pair.k").alias("__length")
        )
    met = (F.col("__probe") == F.col("hash")) & (F.col("__length") == F.col("length"))
    if not carried:
        return probes.join(found, met).select("doc_id", _COPY, "at", "length", "window")
    met &= F.array_join(F.slice(w, pos + 1, F.col("__length")), " ") == F.col("window")
    return (
        probes.join(found, met, "left")
        .filter(F.col("window").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))
        .select("doc_id", _COPY, _N, "at", "length", "window")
    )


def _looked_up(split: DataFrame, found: DataFrame, lengths: list[int]) -> DataFrame:
    """The same for a set that is not broadcast: hashes alone are shuffled, and a document meets
    its candidate positions, one list per document, to have the words compared."""
    hit = F.struct("at", "length", "window")
    maybe = _probed(split, found, lengths, []).groupBy("doc_id", _COPY).agg(F.collect_set(hit).alias("maybe"))
    same_words = lambda c: F.array_join(F.slice(_WORDS, c["at"] + 1, c["length"]), " ") == c["window"]
    checked = (
        split.alias("s").join(maybe.alias("m"), same("s", "m", "doc_id", _COPY), "left")
        .select("s.doc_id", f"s.{_COPY}", F.size(_WORDS).alias(_N), F.filter("maybe", same_words).alias("hits"))
    )
    return checked.select("doc_id", _COPY, _N, F.explode_outer("hits").alias("h")).select(
        "doc_id", _COPY, _N, "h.at", "h.length", "h.window"
    )


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """What each document shares with the benchmark.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored. One
    row per distinct (doc_id, text): doc_id, n_words, n_hit (words inside any occurrence), n_items,
    items_sha256, contaminated. Null and empty texts have no words and are clean; a null doc_id is
    an id like any other; repeated items count once; items without words never match.
    """
    positions, windows = hits(docs, items, n)
    positions = kept(positions)  # small, and read twice below
    key = ["doc_id", _COPY]
    found = positions.filter(F.col("window").isNotNull())

    # Words covered: runs of overlapping windows count their words once. One document at a time.
    before = W.partitionBy(*key).orderBy("at", "length").rowsBetween(W.unboundedPreceding, -1)
    start, end = F.col("at"), F.col("at") + F.col("length")
    new = end - F.greatest(start, F.coalesce(F.max(end).over(before), F.lit(0)))
    covered = positions.select(*key, _N, F.greatest(new, F.lit(0)).alias("new"))
    counts = covered.groupBy(*key).agg(
        F.max(_N).alias("n_words"), F.coalesce(F.sum("new"), F.lit(0)).alias("n_hit")
    )
    listed = (
        found.select(*key, "window").distinct()
        .join(windows.select("item_id", "window"), "window")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return (
        counts.alias("c").join(listed.alias("l"), same("c", "l", *key), "left")
        .select(
            "c.doc_id",
            F.col("n_words").cast("bigint"),
            F.col("n_hit").cast("bigint"),
            F.size(ids).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents; all columns and all clean rows stay."""
    positions, _ = hits(docs, items, n)
    dirty = positions.filter(F.col("window").isNotNull()).select("doc_id", _COPY).distinct()
    return (
        docs.withColumn(_COPY, F.xxhash64("text")).alias("d")
        .join(dirty.alias("x"), same("d", "x", "doc_id", _COPY), "left_anti")
        .drop(_COPY)
    )


def spans(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Verified hits as word spans: doc_id, start, end (exclusive), window."""
    positions, _ = hits(docs, items, n)
    return positions.filter(F.col("window").isNotNull()).select(
        "doc_id", F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end"), "window"
    )
