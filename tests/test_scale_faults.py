"""Faults that small inputs didn't show: split hash, global index, header binding."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frametide.functions.encoders import dense_index
from frametide.operators import sampling
from frametide.plans.train import SPLIT_SEED_STEP
from frametide.schemas import TEST
from frametide.sources.files import scan_csv_glob, scan_gateway


@pytest.mark.parametrize("share", [0.02, 0.15, 0.5])
def test_split_is_independent_of_the_sample(spark, share):
    df = spark.range(0, 60_000, 1, 8).withColumnRenamed("id", "k")
    sample = sampling.sample_exact_n(df, int(60_000 * share), ["k"], 42)
    got = sampling.train_val_split(sample, ["k"], 0.15, 42 + SPLIT_SEED_STEP).agg(F.avg(F.col("is_val").cast("double"))).first()[0]
    assert abs(got - 0.15) < 0.035


def test_whole_fraction_takes_every_row(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert sampling.train_val_split(df, ["k"], 1.0).where("not is_val").count() == 0


def test_index_is_a_permutation_with_payload(spark, tmp_path):
    n = 400_000
    df = spark.range(0, n, 1, 16).select(F.xxhash64("id").alias("k"), F.repeat(F.lit("x"), 60).alias("load"))
    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        dense_index(df, ["k"], "i").write.parquet(str(tmp_path / "i"))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
    r = spark.read.parquet(str(tmp_path / "i")).agg(F.countDistinct("i"), F.min("i"), F.max("i")).first()
    assert tuple(r) == (n, 0, n - 1)


def test_csv_binds_by_header(spark, tmp_path):
    names = [f.name for f in TEST]
    (tmp_path / "a.csv").write_text(",".join(names[::-1]) + "\n" + ",".join(str(i) for i in range(len(names)))[::1] + "\n")
    row = scan_csv_glob(spark, str(tmp_path / "a.csv"), TEST).first()
    assert str(row[names[-1]]) == "0"


def test_missing_id_is_refused(spark, tmp_path):
    names = [f.name for f in TEST if f.name != "id"]
    (tmp_path / "test.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="id"):
        scan_gateway(spark, str(tmp_path))
