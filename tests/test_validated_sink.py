"""The one-pass validated sink."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from frametide.operators.validate import ValidationError
from frametide.sources.validated import observe_ids, write_validated


def frames(spark, n=1000):
    test = spark.range(0, n, 1, 4).selectExpr("string(id) AS id", "id AS n")
    return test, test.selectExpr("id", "double(n) AS x", "double(n) / 2 AS y")


def test_valid_rows_are_published_in_one_pass(spark, tmp_path):
    test, _ = frames(spark)
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    path = f"{tmp_path}/out"
    for _ in range(2):  # the second replaces the first
        counted = test.mapInArrow(count, test.schema)
        measured, seen = observe_ids(counted)
        report = write_validated(measured.selectExpr("id", "double(n) AS x", "1.5D AS y"), counted, path, seen)
        assert report == {"n_expected": 1000, "n_rows": 1000, "n_missing": 0, "n_unexpected": 0, "n_not_finite": 0, "valid": True}
    assert passed.value == 2000
    out = spark.read.parquet(path)
    assert out.columns == ["id", "x", "y"] and out.count() == 1000
    assert os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize(
    "spoil,found",
    [
        (lambda p: p.where("x > 9"), "n_expected=1000, n_rows=990, n_missing=10, n_unexpected=0, n_not_finite=0"),
        (lambda p: p.unionByName(p.where("x = 5")), "n_expected=1000, n_rows=1001"),
        (lambda p: p.withColumn("id", F.when(F.col("x") == 3, "zz").otherwise(F.col("id"))), "n_missing=1, n_unexpected=1"),
        (lambda p: p.withColumn("x", F.when(F.col("x") == 3, float("inf")).when(F.col("x") == 4, float("nan")).when(F.col("x") > 5, F.col("x"))), "n_not_finite=6"),
        (lambda p: p.where("false"), "n_rows=0, n_missing=1000"),
    ],
)
def test_invalid_rows_leave_what_was_there(spark, tmp_path, spoil, found):
    test, preds = frames(spark)
    path = f"{tmp_path}/out"
    write_validated(preds, test, path)
    measured, seen = observe_ids(test)
    bad = spoil(measured.selectExpr("id", "double(n) AS x", "double(n) / 2 AS y"))
    with pytest.raises(ValidationError, match=found):
        write_validated(bad, test, path, seen)
    with pytest.raises(ValidationError, match=found):
        write_validated(spoil(preds), test, f"{tmp_path}/none")
    assert os.listdir(tmp_path) == ["out"] and spark.read.parquet(path).agg(F.sum("x")).first()[0] == 999 * 500


def test_columns_types_and_failures(spark, tmp_path):
    test, preds = frames(spark, 20)
    for bad in (preds.drop("y"), preds.withColumn("x", F.lit("a"))):
        with pytest.raises(ValidationError):
            write_validated(bad, test, f"{tmp_path}/out")
    with pytest.raises(Exception, match="raise_error|broken"):
        write_validated(preds.withColumn("x", F.raise_error(F.lit("broken")).cast("double")), test, f"{tmp_path}/out")
    assert os.listdir(tmp_path) == []


def test_no_expected_rows(spark, tmp_path):
    test, _ = frames(spark, 0)
    measured, seen = observe_ids(test)
    assert write_validated(measured.selectExpr("id", "double(n) AS x", "1D AS y"), test, f"{tmp_path}/out", seen)["n_rows"] == 0
