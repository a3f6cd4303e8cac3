"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without ever forming it: a block of vectors is
multiplied by the centred XᵀX in passes over the rows, a Chebyshev recurrence of such passes damps
the part of the spectrum that is not wanted, and QR with a Rayleigh-Ritz step turns the block into
estimates whose residuals certify them. Rows stay in Spark; the driver holds matrices of
dimension x block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.storage import fresh_dir, save

COMPONENTS = 32
#: Vectors the block holds beyond the wanted ones, and passes of one filter.
GUARD = 16
DEGREE = 12
#: A component is certified when its residual is this part of the largest eigenvalue. Rounding of
#: the passes may keep it from that: then a residual that no longer falls counts below the second.
CERTAIN, ENOUGH = 1e-13, 1e-11
ROUNDS = 100
SEED = 13
#: Rows become whole numbers: entries times SCALE, rounded down, plus OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Larger entries have no exact whole number and take their vector out.
LARGEST = float(1 << 46)
#: Bytes of a packed block; matrices that one task sums.
BLOCK_BYTES = 1 << 18
FAN_IN = 64
_LONG = (1 << 63) - 1


@dataclass
class Model:
    """Components in columns, their eigenvalues, and what certifies them."""

    n: int
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): vectors of the commonest length (ties: the longer), as whole numbers.

    Null vectors, vectors with null, not finite or too large entries and empty vectors are left out.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    v = v.filter(F.col("x").isNotNull() & (F.size("x") > 0) & ~bad)
    sizes = v.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    size = sizes[0]["d"] if sizes else 0
    return v.filter(F.size("x") == size).withColumn("x", F.transform("x", lambda c: F.floor(c * SCALE) + OFFSET))


def _rows(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in column])


def _exact(values: np.ndarray, largest: int) -> np.ndarray:
    """The values in a type whose sums cannot overflow when single terms reach ``largest``."""
    return values if largest * max(len(values), 1) < _LONG else values.astype(object)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, total, square = 0, 0, 0
    for batch in batches:
        if len(batch):
            v = _rows(batch["x"]) - OFFSET
            top = int(np.abs(v).max())
            n += len(v)
            total = total + _exact(v, top).sum(axis=0).astype(object)
            wide = _exact(v, top * top)
            square = square + (wide * wide).sum(axis=0).astype(object)
    if n:
        yield pd.DataFrame(
            {"at": range(len(total)), "n": n, "s": [Decimal(int(t)) for t in total], "q": [Decimal(int(t)) for t in square]}
        )


class Rows:
    """The usable rows, packed into blocks around their mean in a folder all executors share."""

    def __init__(self, points: DataFrame):
        found = points.select("x").mapInPandas(_sums, "at int, n long, s decimal(38,0), q decimal(38,0)")
        sums = found.groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        per = sums.orderBy("at").collect()  # a row per dimension
        self.dim = len(per)
        self.n = n = int(per[0]["n"]) if per else 0
        self.sums = [int(r["s"]) for r in per]  # of x - OFFSET, exact
        self.middle = np.array([s // n for s in self.sums], np.int64)
        self.rest = np.array([(s % n) / n for s in self.sums])
        #: Whole-number sum of n times each dimension's variance times n.
        self.trace = float(sum((n * int(r["q"]) - s * s) / (n * n) for r, s in zip(per, self.sums))) if n else 0.0
        self.blocks: DataFrame | None = None
        if n:
            types = "ids array<long>, deviations array<decimal(38,0)>, n_rows int, width int, data binary"
            packed = points.mapInPandas(self._packer(), types)
            self.blocks = save(packed, fresh_dir(points.sparkSession, "whitening"))
            self.tasks = self.blocks.rdd.getNumPartitions()

    def _packer(self) -> Callable:
        n, middle, sums = self.n, self.middle, self.sums
        left = np.array([s - n * int(m) for s, m in zip(sums, middle)], object)  # below n

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            step = max(1, BLOCK_BYTES // (8 * len(middle)))
            for batch in batches:
                for at in range(0, len(batch), step):
                    part = batch.iloc[at : at + step]
                    v = _rows(part["x"]) - OFFSET - middle
                    top = int(np.abs(v).max())
                    width = next(w for w in (2, 4, 8) if top < 1 << (8 * w - 1))
                    apart = (n * top + n) ** 2
                    away = _exact(np.broadcast_to(v, v.shape), apart * len(middle))
                    away = n * away - (left if away.dtype == object else left.astype(np.int64))
                    yield pd.DataFrame({
                        "ids": [[None if pd.isna(i) else int(i) for i in part["vec_id"]]],
                        "deviations": [[Decimal(int(t)) for t in (away * away).sum(axis=1)]],
                        "n_rows": len(v), "width": width, "data": [v.astype(f"<i{width}").tobytes()],
                    })

        return pack

    def unpacker(self) -> Callable[[bytes, int, int], np.ndarray]:
        dim, rest = self.dim, self.rest
        return lambda data, n_rows, width: np.frombuffer(data, f"<i{width}").reshape(n_rows, dim) - rest

    def summed(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """Sum over all blocks of a matrix made from each block's centred rows.

        Every task adds its blocks in order, and its matrix is added to others in the order of
        their tasks, FAN_IN at a time, so that reruns agree to the last bit.
        """
        unpack = self.unpacker()

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for batch in batches:
                for data, n_rows, width in zip(batch["data"], batch["n_rows"], batch["width"]):
                    total += of(unpack(data, n_rows, width))
            yield pd.DataFrame({"at": [TaskContext.get().partitionId()], "total": [total.tobytes()]})

        def together(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("at")
            total = np.zeros(shape)
            for t in group["total"]:
                total += np.frombuffer(t).reshape(shape)
            return pd.DataFrame({"at": [int(group["at"].iloc[0]) // FAN_IN], "total": [total.tobytes()]})

        types, left = "at int, total binary", self.tasks
        parts = self.blocks.select("data", "n_rows", "width").mapInPandas(partial, types)
        while left > FAN_IN:
            parts = parts.groupBy(F.floor(F.col("at") / FAN_IN)).applyInPandas(together, types)
            left = -(-left // FAN_IN)
        found = sorted(((r["at"], r["total"]) for r in parts.collect()), key=lambda r: r[0])  # FAN_IN matrices at most
        return sum((np.frombuffer(t).reshape(shape) for _, t in found), np.zeros(shape))


def _filtered(times: Callable, block: np.ndarray, product: np.ndarray, lo: float, hi: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the covariance on ``block``: small on [lo, hi], 1 near ``top``."""
    centre, half = (hi + lo) / 2, (hi - lo) / 2
    first = sigma = half / (top - centre)
    before, now = block, (product - centre * block) * (sigma / half)
    for _ in range(DEGREE - 1):
        then = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * then / half) - (sigma * then) * before
        sigma = then
    return now


def fit(rows: Rows, components: int = COMPONENTS, guard: int = GUARD) -> Model:
    """The leading eigenvectors of the rows' covariance, certified by their residuals.

    Directions without variance are no components, so there may be fewer than asked for; without
    rows there are none. Raises when ROUNDS filters do not certify the components.
    """
    dim, n = rows.dim, rows.n
    wanted = min(components, dim)
    if not n or rows.trace == 0:
        return Model(n, rows.trace, np.zeros(0), np.zeros((dim, 0)), 0.0, 0)
    width = min(dim, wanted + guard)
    passes = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return rows.summed(lambda c: c.T @ (c @ block), block.shape) / n

    block, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, width)))
    lowest, best, stuck = np.inf, np.inf, 0
    for _ in range(ROUNDS):
        product = times(block)
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        off = np.linalg.norm(product - block * values, axis=0)
        residual = float(off[:wanted].max())
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if residual <= CERTAIN * values[0] or (stuck >= 2 and residual <= ENOUGH * values[0]):
            break
        # An eigenvalue lies within each residual of its estimate: the least one bounds the spectrum.
        lowest = max(0.0, min(lowest, float((values - off).min())))
        hi = float(values[-1])
        lo = min(lowest, hi - 1e-3 * values[0])
        block, _ = np.linalg.qr(_filtered(times, block, product, lo, hi, float(values[0])))
    else:
        raise RuntimeError(f"components not certified: residual {residual:.3g} of {values[0]:.3g}")
    real = values[:wanted] > 1e-12 * values[0]
    vectors = block[:, :wanted][:, real]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Model(n, rows.trace, values[:wanted][real], vectors * sign, residual, passes)


def whiten(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error and deviation_exact.

    ``vectors`` needs vec_id (long) and embedding (array); all its usable rows, repeated ones and
    ones without an id too, are fitted and returned. ``deviation`` is null where it exceeds a long,
    ``deviation_exact`` (decimal) is not. Rows that are all alike, or none, give no component and
    so no row. Every component's sign makes its largest entry positive.
    """
    rows = Rows(usable(vectors))
    model = fit(rows, components, guard)
    names = "vec_id component n deviation whitened explained identity_error deviation_exact".split()
    kinds = [T.LongType(), T.IntegerType(), *[T.LongType()] * 2, *[T.DoubleType()] * 3, T.DecimalType(38, 0)]
    schema = T.StructType([T.StructField(a, b) for a, b in zip(names, kinds)])
    k = len(model.values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    scaled, n = model.vectors / np.sqrt(model.values), model.n
    second = rows.summed(lambda c: (c @ scaled).T @ (c @ scaled), (k, k)) / n
    mean = rows.summed(lambda c: (c @ scaled).sum(axis=0, keepdims=True), (1, k)) / n
    error = float(np.abs(second - mean.T @ mean - np.eye(k)).max())
    unpack, explained = rows.unpacker(), model.values / model.trace

    def out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, away, data, n_rows, width in zip(
                batch["ids"], batch["deviations"], batch["data"], batch["n_rows"], batch["width"]
            ):
                z = unpack(data, n_rows, width) @ scaled
                whole = pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64")
                longs = pd.array([int(a) if a <= _LONG else None for a in away], "Int64")
                yield pd.DataFrame({
                    "vec_id": whole.repeat(k), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), n_rows),
                    "n": n, "deviation": longs.repeat(k), "whitened": z.reshape(-1),
                    "explained": np.tile(explained, n_rows), "identity_error": error,
                    "deviation_exact": np.repeat(np.array(away, object), k),
                })

    return rows.blocks.mapInPandas(out, schema)
