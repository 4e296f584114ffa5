"""Exact samples by radix selection."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from frametide.operators import sampling

N = 3_000_000


def expected(keys, n, seed):
    return sorted(sorted(keys, key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest())[:n])


@pytest.mark.parametrize("n", [0, 1, 7, 1499, 1500, 1501, 2999, 3000, 4000])
def test_the_rows_of_the_smallest_hashes(spark, n, monkeypatch):
    monkeypatch.setattr(sampling, "BOUNDARY_ROWS", 3)
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", 1)
    df = spark.range(0, 3000, 1, 9).withColumnRenamed("id", "k")
    for settle in (False, True):
        hist = sampling._histogram(df, sampling.key_hash(["k"], 5), "")
        sample, total = sampling.sample_from_histogram(df, hist, n, ["k"], 5, settle=settle)
        assert total == 3000 and sorted(r["k"] for r in sample.collect()) == expected(range(3000), n, 5)


def test_half_of_three_million_rows_stay_spread(spark):
    df = spark.range(0, N, 1, 24).withColumnRenamed("id", "k")
    sample, total = sampling.sample_exact_n_with_total(df, N // 2, ["k"])
    assert total == N
    sizes = [r["n"] for r in sample.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == N // 2 and len(sizes) == 24 and max(sizes) < N // 24
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Limit" not in plan


def test_rows_that_agree_in_their_keys(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BOUNDARY_ROWS", 10)
    df = spark.range(0, 5000, 1, 6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    same = spark.range(0, 400, 1, 3).select(F.lit(1).alias("k"), F.lit(9).alias("id"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    for n in (1, 900, 2500, 4999):
        first = sampling.sample_exact_n(df, n, ["k"], seed=2)
        assert first.count() == n
        again = sampling.sample_exact_n(df.repartition(11), n, ["k"], seed=2)
        assert sorted(r["id"] for r in first.collect()) == sorted(r["id"] for r in again.collect())
        assert sampling.sample_exact_n(same, min(n, 399), ["k"]).count() == min(n, 399)


def test_empty_table(spark):
    sample, total = sampling.sample_exact_n_with_total(spark.createDataFrame([], "k long"), 5, ["k"])
    assert total == 0 and sample.collect() == []
