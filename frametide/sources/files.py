"""File scans (S1-S7) with explicit schemas.

Each scan is one distributed FileScan: the glob is expanded by Spark, files
are split into tasks, and only the columns a query uses are parsed/read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frametide.functions.keys import week_from_filename
from frametide.operators.validate import check_required_column
from frametide.schemas import TEST, TRACKING_INPUT, TRACKING_OUTPUT
from frametide.sources.headers import observed_rejects, scan_by_name


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _missing_path(err: AnalysisException) -> bool:
    text = str(err)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text


def scan_csv_glob(
    spark: SparkSession, pattern: str, schema: T.StructType, with_source: bool = False, observation: Observation | None = None
) -> DataFrame:
    """S1 + U1: all CSV files matching ``pattern``, concatenated by column name
    under an explicit schema (files may differ in the order and choice of
    their columns); an empty DataFrame with ``schema`` when nothing matches.

    ``with_source`` adds ``source_file`` (the full file path) from the scan's
    hidden metadata column - the key for per-file attributes such as week. With
    ``observation`` the text that is no value of its column's type is counted
    per column while the result is first computed.
    """
    try:
        if observation is None:
            out = scan_by_name(spark, pattern, schema, with_source)
        else:
            out = scan_by_name(spark, pattern, None, with_source)
            out = out if out is None else observed_rejects(out, schema, observation, ["source_file"] if with_source else [])
    except AnalysisException as err:
        if not _missing_path(err):
            raise
        out = None
    if out is not None:
        return out
    out = empty(spark, schema)
    return out.withColumn("source_file", F.lit(None).cast("string")) if with_source else out


def _scan_weekly(spark: SparkSession, train_dir: str, prefix: str, schema: T.StructType, pattern: str | None):
    glob = pattern or f"{train_dir.rstrip('/')}/{prefix}_*.csv"
    df = scan_csv_glob(spark, glob, schema, with_source=True)
    return df.withColumn("week", week_from_filename(F.col("source_file"))).drop("source_file")


def scan_inputs(
    spark: SparkSession, train_dir: str = "train", schema: T.StructType = TRACKING_INPUT, pattern: str | None = None
) -> DataFrame:
    """S2 + P16: all weekly input files, with ``week`` parsed from the name."""
    return _scan_weekly(spark, train_dir, "input", schema, pattern)


def scan_outputs(
    spark: SparkSession, train_dir: str = "train", schema: T.StructType = TRACKING_OUTPUT, pattern: str | None = None
) -> DataFrame:
    """S3 + P16: all weekly label files, with ``week``."""
    return _scan_weekly(spark, train_dir, "output", schema, pattern)


def scan_test_input(spark: SparkSession, base_dir: str = ".", schema: T.StructType = TRACKING_INPUT) -> DataFrame:
    """``test_input.csv`` or an empty frame."""
    return scan_csv_glob(spark, f"{base_dir.rstrip('/')}/test_input.csv", schema)


def scan_test(spark: SparkSession, base_dir: str = ".", schema: T.StructType = TEST) -> DataFrame:
    """``test.csv`` or an empty frame."""
    return scan_csv_glob(spark, f"{base_dir.rstrip('/')}/test.csv", schema)


def scan_gateway(
    spark: SparkSession,
    base_dir: str = ".",
    test_schema: T.StructType = TEST,
    input_schema: T.StructType = TRACKING_INPUT,
    id_col: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """(test, test_input); fails when the row id column is absent."""
    test = scan_test(spark, base_dir, test_schema)
    path = f"{base_dir.rstrip('/')}/test.csv"
    try:
        check_required_column(spark.read.option("header", True).csv(path), id_col)
    except AnalysisException as err:
        if not _missing_path(err):
            raise
    return test, scan_test_input(spark, base_dir, input_schema)


def scan_json_rows(spark: SparkSession, path: str, schema: T.StructType = TRACKING_INPUT) -> DataFrame:
    """JSON-lines request rows (one object per line) with an explicit
    schema; a ``.csv`` path is read as CSV instead."""
    if path.endswith(".csv"):
        return scan_csv_glob(spark, path, schema)
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as err:
        if not _missing_path(err):
            raise
        return empty(spark, schema)


def scan_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet folder, or no rows where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if not _missing_path(err):
            raise
        return empty(spark, schema)


def write_weekly_csv(df: DataFrame, root: str, prefix: str, week: str = "week", year: int = 2023) -> str:
    """Lay a frame table out as weekly CSV files ``<prefix>_<year>_wNN.csv``
    - the fixed weekly naming the scans expect - as one directory of part
    files per week, written by one distributed job."""
    named = df.withColumn(
        "file", F.concat(F.lit(f"{prefix}_{year}_w"), F.lpad(F.col(week).cast("string"), 2, "0"), F.lit(".csv"))
    )
    named.drop(week).write.mode("overwrite").partitionBy("file").option("header", True).csv(root)
    return f"{root.rstrip('/')}/file={prefix}_*.csv"
