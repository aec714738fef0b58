"""Pairs each query key with its Spark plan and, as SQL, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adloom.session import DUPLICATE_KEYS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn):
        def run(spark, sf_dir):
            spark.conf.set(DUPLICATE_KEYS, "true")
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register
