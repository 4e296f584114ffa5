"""Scoring job (M9, T3): test rows -> features -> models -> validated
predictions keyed by row id. One plan scores every play; the model is loaded
once (not per play)."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from frametide.operators import models as M
from frametide.operators.features import transform_for_inference
from frametide.operators.joins import join_test_features
from frametide.operators.validate import (
    ErrorType,
    ValidationError,
    check_columns,
    check_numeric,
    check_required_column,
    submission_report,
)
from frametide.schemas import FRAME_KEYS, ROW_ID
from frametide.sources.catalogue import resolve_model
from frametide.sources.validated import observe_ids, report_details, write_validated


def score_test(
    test: DataFrame,
    test_input: DataFrame,
    bundle: M.ModelBundle,
    keys: Sequence[str] = FRAME_KEYS,
    id_col: str = ROW_ID,
    hot_group_rows: int | None = 2_000_000,
) -> DataFrame:
    """M9: (id, x, y) for every test row.

    J2 left join on the shared frame keys, lag features when the model's
    feature list uses them, the stored feature list and vocabulary, then
    every model and the weighted blend - all one plan."""
    from frametide.plans.train import lag_stage, uses_lag_features

    check_required_column(test, id_col)
    joined = join_test_features(test, test_input, keys)
    if uses_lag_features(bundle.feature_columns):
        joined = lag_stage(joined, test, test_input, [id_col], hot_group_rows, keys, "left")
    feats = transform_for_inference(joined, bundle.feature_columns, bundle.vocabulary or [], keep=[id_col])
    return M.score(bundle, feats, keep=[id_col]).select(id_col, "x", "y")


def score_rows(rows: DataFrame, bundle: M.ModelBundle, id_col: str = ROW_ID) -> DataFrame:
    """T3 core: score request rows directly (no join), keeping ``id_col``
    when the rows carry one."""
    keep = [id_col] if id_col in rows.columns else []
    feats = transform_for_inference(rows, bundle.feature_columns, bundle.vocabulary or [], keep=keep)
    return M.score(bundle, feats, keep=keep).select(*keep, "x", "y")


def validate_submission(predictions: DataFrame, test: DataFrame, id_col: str = ROW_ID) -> dict:
    """V2 + V4 at plan time, V1/V5/V6/V8 in one aggregation; raises
    INVALID_SUBMISSION on any failure, returns the report otherwise."""
    check_columns(predictions, id_col=id_col)
    check_numeric(predictions)
    report = submission_report(predictions, test, id_col=id_col).first().asDict()
    if not report["valid"]:
        raise ValidationError(ErrorType.INVALID_SUBMISSION, report_details(report))
    return report


def score_to(
    test: DataFrame, test_input: DataFrame, bundle: M.ModelBundle, path: str, id_col: str = ROW_ID
) -> dict:
    """M9 + V1-V6, V8 + S8 in one pass: test rows are read and scored once,
    measured on the way, and published at ``path`` only when valid; returns
    the submission report."""
    check_required_column(test, id_col)
    measured, seen = observe_ids(test, id_col)
    return write_validated(score_test(measured, test_input, bundle, id_col=id_col), test, path, seen, id_col)


def score_request(spark: SparkSession, input_path: str, model_path: str, id_col: str = ROW_ID) -> DataFrame:
    """Score a JSON-lines (or CSV) request file with the model at
    ``model_path``; swapping models is just another path, and
    ``<folder>/latest`` the newest whole model of a folder."""
    from frametide.sources.files import scan_json_rows
    from frametide.schemas import TRACKING_INPUT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(id_col, T.StringType()), *TRACKING_INPUT.fields])
    rows = scan_json_rows(spark, input_path, schema)
    return score_rows(rows, M.load_bundle(spark, resolve_model(spark, model_path)), id_col)


def main(argv: Sequence[str] | None = None) -> None:
    from frametide.session import build_session
    from frametide.sources.files import scan_gateway
    from frametide.sources.sinks import write_result_json

    ap = argparse.ArgumentParser(description="Score test rows with a saved model")
    ap.add_argument("--data-dir", default=".")
    ap.add_argument("--model", required=True, help="a saved model, or <folder>/latest for its newest whole one")
    ap.add_argument("--output", default="submission.parquet")
    ap.add_argument("--result", default="result.json")
    args = ap.parse_args(argv)
    spark = build_session()
    error = None
    try:
        test, test_input = scan_gateway(spark, args.data_dir)
        score_to(test, test_input, M.load_bundle(spark, resolve_model(spark, args.model)), args.output)
    except Exception as exc:  # any failure leaves a status record, then the exit code tells
        error = exc
    write_result_json(spark, args.result, error)
    if error is not None:
        raise SystemExit(1) from error


if __name__ == "__main__":
    main()
