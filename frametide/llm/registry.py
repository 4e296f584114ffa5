"""Queries of the training-data operators: name -> (function, oracle SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frametide.llm.common import start

QUERIES: dict = {}


def llm_query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(start(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = (run, sql)
        return run

    return deco
