"""Every operator as a named query over the given tables, with its plain SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stopwise.registry import facts, ingest, profile, questions, staging, versions, volume
from stopwise.registry.sample import Sample, sample

_LAYERS = (staging, facts, questions, profile, ingest, versions, volume)


def _bind(query: Callable[[Sample], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(sample(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(q) for layer in _LAYERS for name, q in layer.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for layer in _LAYERS for name, sql in layer.ORACLES.items()}
