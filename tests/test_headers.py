"""CSV files with different headers, and counts of unreadable cells."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from frametide.sources import files, headers

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def write(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"{folder}/*.csv"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_bind_by_each_files_header(spark, tmp_path):
    pattern = write(tmp_path, input_w01="id,x,y\n1,1.5,2\n", input_w02="y,extra,x,id\r\n20,z,15,2\r\n", input_w03="id,y\n3,30\n", input_w04="", input_w05="id,x,y\n", input_w06='"x","id"\n7,6\n')
    want = [(1, 1.5, 2.0), (2, 15.0, 20.0), (3, None, 30.0), (6, 7.0, None)]
    assert rows(files.scan_csv_glob(spark, pattern, SCHEMA)) == sorted(want, key=repr)
    by_file = {r["source_file"].rsplit("/", 1)[1]: r["id"] for r in files.scan_csv_glob(spark, pattern, SCHEMA, with_source=True).collect()}
    assert by_file == {"input_w01.csv": 1, "input_w02.csv": 2, "input_w03.csv": 3, "input_w06.csv": 6}
    every = headers.scan_by_name(spark, pattern)
    assert every.columns == ["id", "x", "y", "extra"]
    assert rows(every.select("id", "extra")) == sorted([("1", None), ("2", "z"), ("3", None), ("6", None)], key=repr)


def test_one_scan_per_distinct_header(spark, tmp_path):
    texts = {f"f{i:02d}": ("id,x\n" if i % 3 else "x,id\n") + "1,1\n" * 50 for i in range(24)}
    df = files.scan_csv_glob(spark, write(tmp_path, **texts), SCHEMA)
    assert df.count() == 24 * 50
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1t"


def test_header_lines(spark, tmp_path):
    assert headers.column_names("﻿id,x,x,,x\r\n") == ["id", "x", "x.1", "Unnamed: 3", "x.2"]
    assert headers.column_names('"a,b",c') == ["a,b", "c"]
    pattern = write(tmp_path, a="﻿id,x\n1,2\n".encode(), b="x,x,id\n5,6,2\n")
    assert rows(files.scan_csv_glob(spark, pattern, SCHEMA)) == [(1, 2.0, None), (2, 5.0, None)]
    assert files.scan_csv_glob(spark, f"{tmp_path}/none_*.csv", SCHEMA).collect() == []
    (tmp_path / "sub").mkdir()
    assert files.scan_csv_glob(spark, write(tmp_path / "sub", a=""), SCHEMA).collect() == []


def test_a_large_file_is_read_for_its_header_only_once(spark, tmp_path):
    write(tmp_path, big="id,x,y\n" + "".join(f"{i},{i},{i}\n" for i in range(60_000)))
    assert headers.header_index(spark, f"{tmp_path}/*.csv")[0][1] == "id,x,y"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = files.scan_csv_glob(spark, f"{tmp_path}/*.csv", SCHEMA)
        assert df.rdd.getNumPartitions() > 5 and df.selectExpr("sum(id)", "count(*)").first() == (60_000 * 59_999 // 2, 60_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejected_cells_per_file_and_column(spark, tmp_path):
    pattern = write(tmp_path, a="id,x,y\n1,bad,2\nz9,,3\n3,1e3,oops\n", b="y,id\n,4\n7,5.5e\n")
    got = {(r["file"][-5:], r["column_name"]): (r["n_rows"], r["n_rejected"], r["example"]) for r in headers.reject_report(spark, pattern, SCHEMA).collect()}
    assert got == {("a.csv", "id"): (3, 1, "z9"), ("a.csv", "x"): (3, 1, "bad"), ("a.csv", "y"): (3, 1, "oops"), ("b.csv", "y"): (2, 0, None), ("b.csv", "id"): (2, 1, "5.5e")}
    assert headers.reject_report(spark, pattern, T.StructType.fromDDL("other double")).collect() == []


def test_rejects_are_observed_in_the_scan(spark, tmp_path):
    pattern = write(tmp_path, a="id,x,y\n1,bad,2\nz9,,3\n", b="y,id\nbad,4\n")
    seen = Observation("cells")
    df = files.scan_csv_glob(spark, pattern, SCHEMA, with_source=True, observation=seen)
    assert df.columns == ["id", "x", "y", "source_file"]
    df.write.mode("overwrite").parquet(f"{tmp_path}/out")
    assert seen.get == {"n_rows": 3, "n_rejected_id": 1, "n_rejected_x": 1, "n_rejected_y": 1}
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id", "x", "y")) == sorted([(1, None, 2.0), (None, None, 3.0), (4, None, None)], key=repr)


@pytest.mark.parametrize("text", ['{"id": 1, "x": "1.5", "y": null}\n{"id": "q", "x": true}\n'])
def test_rejected_json_values(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    got = {r["column_name"]: (r["n_rows"], r["n_rejected"], r["example"]) for r in headers.reject_report(spark, f"{tmp_path}/r.json", SCHEMA, json_lines=True).collect()}
    assert got == {"id": (2, 1, "q"), "x": (2, 1, "true"), "y": (2, 0, None)}
