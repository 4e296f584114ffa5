"""Sinks (S8-S12). Data sinks are distributed writes; the status and metadata
sinks write exactly one row by definition."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.operators.joins import attach_row_ids
from frametide.operators.validate import ErrorType, ValidationError
from frametide.schemas import PREDICTION_COLUMNS, RESULT, ROW_ID

# Fixed value: status details are cut to this many characters.
MAX_ERROR_DETAILS = 8000


def write_submission_parquet(
    predictions: DataFrame, path: str, row_ids: DataFrame | None = None, id_col: str = ROW_ID
) -> str:
    """S8 + P15: predictions keyed by id (joined to ``row_ids`` when given),
    id columns first, as one parquet dataset."""
    sub = attach_row_ids(predictions, row_ids, id_col) if row_ids is not None else predictions
    rest = [c for c in sub.columns if c != id_col]
    sub.select(id_col, *rest).write.mode("overwrite").parquet(path)
    return path


def write_submission_csv(
    submission: DataFrame, path: str, columns=PREDICTION_COLUMNS, order_by: str = ROW_ID
) -> str:
    """The external form - header plus exactly the prediction columns,
    rows in ``order_by`` order (a range-partitioned sort; part files are
    written in order)."""
    submission.orderBy(order_by).select(*columns).write.mode("overwrite").option("header", True).csv(path)
    return path


def result_frame(spark: SparkSession, error: ValidationError | Exception | None) -> DataFrame:
    """S10 row: Succeeded, ErrorType, ErrorName, ErrorDetails (<= 8000 chars)."""
    if error is None:
        row = (True, None, None, None)
    elif isinstance(error, ValidationError):
        row = (False, error.error_type.value, error.error_type.name, error.details)
    else:
        row = (False, ErrorType.GATEWAY_RAISED_EXCEPTION.value, ErrorType.GATEWAY_RAISED_EXCEPTION.name, repr(error))
    df = spark.createDataFrame([row], RESULT)
    return df.withColumn("ErrorDetails", F.substring("ErrorDetails", 1, MAX_ERROR_DETAILS))


def write_result_json(spark: SparkSession, path: str, error: ValidationError | Exception | None = None) -> str:
    """The status record as JSON."""
    result_frame(spark, error).coalesce(1).write.mode("overwrite").json(path)
    return path


def write_model_metadata(spark: SparkSession, path: str, meta: Mapping) -> str:
    """The model metadata record as one JSON document."""
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def read_model_metadata(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one metadata record at {path}")
    return json.loads(rows[0]["value"])


def write_parquet_lz4(df: DataFrame, path: str, codec: str = "lz4_raw") -> str:
    """A frame as compressed parquet (lz4 family codecs)."""
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return path
