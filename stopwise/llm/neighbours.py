"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are rotated at random and every curve orders them along a Hilbert curve through its own
few rotated dimensions, shifted at random. Near vectors are often near on some curve: a query reads
the blocks of keys around its own place on every curve, scores what it finds by inner product in
double precision, and the curves' answers are merged. Every vector is on every curve. How far a
query reads is fitted: exact neighbours of a bounded sample of queries tell how far from the query,
on its best curve, neighbours lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.functions.numbering import number_rows
from stopwise.llm.common import kept, smallest

CURVES = 8
DIMENSIONS = 8  # of a curve
BITS = 7  # of a dimension; a key has DIMENSIONS * BITS, at most 62
SEED = 20
#: Queries of which exact neighbours are found, and the part of these the reach must cover.
FIT_QUERIES = 100
COVER = 0.96
#: Rows of a block at most; vectors of the sample that scales the curves.
BLOCK = 8192
#: Queries that read a block together at most; a block that more read is copied.
QUERIES = 4096
SCALE_ROWS = 4096
#: More neighbours than asked for that every block hands on, so that rounding decides nothing.
SPARE = 8


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of rows of whole numbers below 2^bits."""
    x = [c.astype(np.int64) for c in points.T]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections of each level
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> b) & 1)
    return key


def _rotation(dim: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q


def _axes(dim: int, curve: int) -> np.ndarray:
    return (np.arange(min(DIMENSIONS, dim)) + curve * DIMENSIONS) % dim


class Curves:
    """The curves' common scale: rotation, centre and width of the rotated dimensions, largest norm.

    Inner products become distances by one more coordinate: sqrt(largest^2 - norm^2) for a vector
    on the curve, 0 for a query, which is first brought to the largest norm.
    """

    def __init__(self, sample: np.ndarray, largest: float):
        self.largest = largest
        self.rotation = _rotation(sample.shape[1] + 1)
        spread = self.lifted(sample) @ self.rotation
        self.lo = spread.min(axis=0)
        self.width = np.maximum(spread.max(axis=0) - self.lo, 1e-12)
        rng = np.random.default_rng(SEED + 1)
        self.shift = rng.uniform(0, 0.5, (CURVES, len(self.lo)))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest**2 - (x * x).sum(axis=1), 0)
        return np.column_stack([x, np.sqrt(rest)])

    def asked(self, x: np.ndarray) -> np.ndarray:
        scale = self.largest / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)
        return np.column_stack([x * scale, np.zeros(len(x))])

    def keys(self, x: np.ndarray, asked: bool) -> list[np.ndarray]:
        spread = ((self.asked(x) if asked else self.lifted(x)) @ self.rotation - self.lo) / self.width
        out = []
        for c in range(CURVES):
            axes = _axes(len(self.lo), c)
            cell = (spread[:, axes] + self.shift[c, axes]) / 1.5 * (1 << BITS)
            out.append(hilbert_keys(np.clip(np.floor(cell), 0, (1 << BITS) - 1).astype(np.int64)))
        return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column]).reshape(len(column), -1)


def _scores(query: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Inner products, each summed the same way whatever stands beside it."""
    return (found * query).sum(axis=1)


def _best(queries: np.ndarray, rows: np.ndarray, keys: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the (keys, scores) of the k + SPARE rows with the largest inner products."""
    out = []
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        rough = part @ rows.T
        take = min(k + SPARE, len(rows))
        near = np.argpartition(-rough, take - 1, axis=1)[:, :take]
        out += [(keys[at], _scores(q, rows[at])) for q, at in zip(part, near)]
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, vkey): vectors with an id, of the commonest length, finite and not zero."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    v = v.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    sizes = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    size = sizes[0]["d"] if sizes else 0
    return v.filter(F.size("vec") == size).withColumn("vkey", F.xxhash64("vec"))


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """The k nearest found of every query: query_id, rank, vec_id, score.

    ``vectors`` needs vec_id and embedding; ``is_query`` is a condition on vec_id. Candidates are
    all rows but those with the query's own id; ties go to the smaller id. Vectors that are null,
    zero, of another length than most, or hold a null or a value that is not finite take no part;
    rows that repeat id and vector count once. Equal vectors are one point of the curves with its
    k + 1 least ids, which is all a query can need of them.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    # The least ids of a vector, chosen in two steps so that a vector with very many rows spreads.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    ids = rows.select("vkey", "vec_id").distinct().withColumn("s", salt)
    place = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("vec_id"))
    ids = ids.withColumn("r", place("vkey", "s")).filter(F.col("r") <= k + 1)
    ids = ids.withColumn("r", place("vkey")).filter(F.col("r") <= k + 1)
    members = kept(ids.groupBy("vkey").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    distinct = kept(rows.groupBy("vkey").agg(F.first("vec").alias("vec"), F.max(is_query.cast("int")).alias("asked")))

    top = distinct.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m"), F.count("*").alias("n"), F.sum("asked").alias("asked")).first()
    if not top["n"]:
        empty = "query_id long, rank int, vec_id long, score double"
        return spark.createDataFrame([], empty)
    sample = smallest(distinct, SCALE_ROWS, top["n"], "vkey").select("vec").toPandas()
    curves = Curves(_matrix(sample["vec"]), float(np.sqrt(top["m"])))
    state = spark.sparkContext.broadcast((curves.largest, curves.rotation, curves.lo, curves.width, curves.shift))

    def place_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Curves.__new__(Curves)
        own.largest, own.rotation, own.lo, own.width, own.shift = state.value
        for b in batches:
            x = _matrix(b["vec"])
            asked = b["asked"].to_numpy() == 1
            for flag, part in ((0, np.ones(len(b), bool)), (1, asked)):
                if part.any():
                    for c, key in enumerate(own.keys(x[part], bool(flag))):
                        yield pd.DataFrame({"curve": c, "key": key, "vkey": b["vkey"].to_numpy()[part], "query": flag})

    points = distinct.mapInPandas(place_all, "curve int, key long, vkey long, query int")
    # All curves are numbered at once; each has as many points as the others.
    placed = number_rows(points, "__row", ["curve", "key", "vkey", "query"])
    size = top["n"] + top["asked"]
    placed = kept(placed.withColumn("place", F.col("__row") - 1 - F.col("curve") * size).drop("__row"))

    reach = _fitted_reach(distinct, placed, k, top["asked"])
    block = int(min(max(reach, 256), BLOCK))
    at = F.floor(F.col("place") / block).cast("int")
    near = F.sequence(
        F.greatest(F.lit(0), F.floor((F.col("place") - reach) / block)).cast("int"),
        F.floor((F.col("place") + reach) / block).cast("int"),
    )
    asks = placed.filter("query = 1").select("curve", F.explode(near).alias("block"), "vkey", "query")
    readers = asks.groupBy("curve", "block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies"))
    asks = asks.join(readers, ["curve", "block"]).withColumn("copy", F.pmod(F.xxhash64("vkey"), F.col("copies")).cast("int"))
    data = placed.filter("query = 0").select("curve", at.alias("block"), "vkey", "query")
    data = data.join(readers, ["curve", "block"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    met = data.unionByName(asks).drop("copies").join(distinct.select("vkey", "vec"), "vkey")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        asked = part["query"].to_numpy() == 1
        queries, held = part[asked], part[~asked]
        if not len(queries) or not len(held):
            return pd.DataFrame({"vkey": pd.Series([], dtype="int64"), "found": pd.Series([], dtype=object)})
        best = _best(_matrix(queries["vec"]), _matrix(held["vec"]), held["vkey"].to_numpy(), k)
        found = [[{"score": s, "other": o} for o, s in zip(keys, scores)] for keys, scores in best]
        return pd.DataFrame({"vkey": queries["vkey"].to_numpy(), "found": found})

    kind = "vkey long, found array<struct<score: double, other: long>>"
    answers = met.groupBy("curve", "block", "copy").applyInPandas(compare, kind)
    # A query has a bounded number of answers: curves times blocks, k + SPARE each.
    largest_first = lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(
        F.when(a["other"] < b["other"], -1).when(a["other"] > b["other"], 1).otherwise(0)
    )
    merged = answers.groupBy("vkey").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found"))), largest_first).alias("found")
    )
    # The k nearest vectors, and those that tie with the k-th, hold all of the k nearest rows; the
    # query's own vector is among them and may hold no other row, so one more is needed.
    cut = F.element_at("found", F.least(F.lit(k + 1), F.size("found")))["score"]
    hits = (
        merged.withColumn("cut", cut)
        .select("vkey", "cut", F.explode("found").alias("f")).filter(F.col("f.score") >= F.col("cut"))
        .select("vkey", F.col("f.score").alias("score"), F.col("f.other").alias("other"))
        .join(members.withColumnRenamed("vkey", "other"), "other")
        .select("vkey", F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id"))).alias("some"))
        .groupBy("vkey").agg(F.slice(F.sort_array(F.flatten(F.collect_list("some"))), 1, k + 1).alias("some"))
    )
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "vkey").distinct()
    others = F.slice(F.filter("some", lambda x: x["id"] != F.col("query_id")), 1, k)
    return queries.join(hits, "vkey").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
        (-F.col("x.s")).alias("score"),
    )


def _fitted_reach(distinct: DataFrame, placed: DataFrame, k: int, total: int) -> int:
    """Places to each side within which COVER of a sample's exact neighbours lie on some curve."""
    spark = distinct.sparkSession
    asked = smallest(distinct.filter("asked = 1"), FIT_QUERIES, total, "vkey").toPandas()
    if not len(asked):
        return 1
    queries = spark.sparkContext.broadcast((_matrix(asked["vec"]), asked["vkey"].to_numpy()))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vec, names = queries.value
        for b in batches:
            for own, (keys, scores) in zip(names, _best(vec, _matrix(b["vec"]), b["vkey"].to_numpy(), k)):
                yield pd.DataFrame({"vkey": own, "other": keys, "score": scores})

    found = distinct.select("vkey", "vec").mapInPandas(exact, "vkey long, other long, score double")
    nth = F.row_number().over(W.partitionBy("vkey").orderBy(F.desc("score"), "other"))
    found = found.withColumn("r", nth).filter(F.col("r") <= k + 1).filter("vkey <> other")
    mine = placed.filter("query = 1").select("curve", "vkey", F.col("place").alias("mine"))
    theirs = placed.filter("query = 0").select("curve", F.col("vkey").alias("other"), F.col("place").alias("theirs"))
    apart = (
        found.select("vkey", "other").join(mine, "vkey").join(theirs, ["curve", "other"])
        .groupBy("vkey", "other").agg(F.min(F.abs(F.col("mine") - F.col("theirs"))).alias("apart"))
    )
    got = apart.agg(F.percentile("apart", COVER).alias("p")).first()["p"]
    return max(1, int(got or 1))
