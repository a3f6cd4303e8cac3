"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed n-grams of the whole lower-cased text: the logarithms of their counts,
brought to length 1. Each is scaled by the log ratio of its smoothed share in toxic and in other
training documents; a logistic regression is trained on the scaled features. Training reads a
bounded sample of labelled rows; scoring is one map over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import held_out

ORDERS = (3, 4, 5)
BITS = 18
#: Labelled rows of each class the model is fitted on, at most: those with the smallest id hash.
TOXIC_ROWS = 1000
OTHER_ROWS = 2000
THRESHOLD = 0.3
L2 = 1e-5

_MUL = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def features(text: str | None, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text's n-grams. ``last`` is scratch of 2^BITS places; its content is free."""
    raw = f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, dtype=np.uint32) * _MIX
    h, hashed = points, []
    for n in range(2, max(ORDERS) + 1):
        if len(points) < n:
            break
        h = (h[:-1] * _MUL) ^ points[n - 1 :]
        if n in ORDERS:
            hashed.append((h * _MIX) >> np.uint32(32 - BITS))
    if not hashed:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at = np.concatenate(hashed).astype(np.int64)
    turn = np.arange(len(at), dtype=np.int32)
    last[at] = turn
    own = last[at]  # the last of equal n-grams stands for all of them
    first = own == turn
    values = np.log1p(np.bincount(own, minlength=len(at))[first]).astype(np.float32)
    return at[first].astype(np.int32), values / np.sqrt((values * values).sum())


class Model:
    """Weights per hashed n-gram and an intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, found: tuple[np.ndarray, np.ndarray]) -> float:
        z = self.bias + float((self.weights[found[0]] * found[1]).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 40, least: float = 0.8) -> Model:
    """Train on features and 0/1 labels. Without both classes the score is the class share.

    Features whose log-count ratio is within ``least`` of 0 would be scaled to little and are left
    out. The weights are drawn, slightly, towards the log-count ratios themselves.
    """
    size, n = 1 << BITS, len(rows)
    share = float(np.clip(labels.mean(), 0.001, 0.999)) if n else 0.001
    if n == 0 or labels.min() == labels.max():
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    yes, no = np.ones(size), np.ones(size)
    for (at, values), y in zip(rows, labels):
        (yes if y else no)[at] += 20 * values
    ratio = (np.log(yes / yes.sum()) - np.log(no / no.sum())).astype(np.float32)
    ratio[np.abs(ratio) < least] = 0
    rows = [(at[keep], values[keep]) for at, values in rows for keep in (ratio[at] != 0,)]
    of = np.repeat(np.arange(n, dtype=np.int32), [len(at) for at, _ in rows])
    flat = np.concatenate([at for at, _ in rows])
    scaled = np.concatenate([values for _, values in rows]) * ratio[flat]
    del rows
    w, b = np.ones(size, np.float32), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(of, weights=scaled * w[flat], minlength=n)
        err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n).astype(np.float32)
        pull = np.bincount(flat, weights=scaled * err[of], minlength=size) + L2 * (w - 1)
        g = np.append(pull, err.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    return Model((w * ratio).astype(np.float32), float(b))


def _scratch() -> np.ndarray:
    return np.zeros(1 << BITS, np.int32)


def _train_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last = _scratch()
    for batch in batches:
        found = [features(t, last) for t in batch["text"]]
        yield pd.DataFrame(
            {
                "toxic": batch["toxic"],
                "places": pd.Series([at.tobytes() for at, _ in found], dtype=object),
                "vals": pd.Series([values.tobytes() for _, values in found], dtype=object),
            }
        )


def _fit_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = sorted(row for b in batches for row in zip(b["places"], b["vals"], b["toxic"]))
    found = [(np.frombuffer(at, np.int32), np.frombuffer(values, np.float32)) for at, values, _ in rows]
    model = fit(found, np.array([toxic for _, _, toxic in rows], dtype=np.int64))
    yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> Model:
    """Fit on at most ``toxic_rows`` + ``other_rows`` labelled documents that are not held out.

    The features of this bounded sample meet in one task, which trains; the driver gets the weights.
    """
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = lambda c, n: usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = by_hash(1, toxic_rows).unionByName(by_hash(0, other_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the parameters
    sent = sample.select("toxic", "text").mapInPandas(_train_rows, "toxic int, places binary, vals binary")
    got = sent.repartition(1).mapInPandas(_fit_rows, "weights binary, bias double").collect()
    if not got:
        return fit([], np.zeros(0, np.int64))
    return Model(np.frombuffer(got[0]["weights"], np.float32), got[0]["bias"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 from THRESHOLD on).

    ``docs`` needs text; every column and row stays, repeated rows included. A null text scores
    like an empty one. No training rows give every text the same low score.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 1 MB

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, last = Model(*shared.value), _scratch()
        for texts in batches:
            yield pd.Series([own.score(features(t, last)) for t in texts], dtype="float64")

    scored = F.pandas_udf(scores, "double")
    out = docs.withColumn("score", scored(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without documents that the classifier rejects; columns as given."""
    named = docs.select("doc_id", "text")
    model = train(named, labels)
    rated = score(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return rated.filter(F.col("predicted") == 0).select("row.*")
