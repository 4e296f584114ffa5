"""User-supplied prediction functions (F1).

The contract matches a per-play predictor: ``fn(test_rows, input_rows)``
receives one play's test rows and input frames as pandas DataFrames and
returns one prediction row per test row, in test-row order. Spark groups both
tables by play and calls ``fn`` once per play through Arrow
(``cogroup().applyInPandas``); ids are attached inside the same pandas frame,
so no alignment is ever positional across tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from frametide.operators.validate import ErrorType, ValidationError
from frametide.schemas import PLAY_KEYS, PREDICTION_COLUMNS, ROW_ID
from frametide.session import ship_package

PredictFn = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]

def check_named(fn: Callable) -> None:
    """The predictor must be a named function (not a lambda)."""
    if getattr(fn, "__name__", "<lambda>") == "<lambda>":
        raise ValidationError(ErrorType.GATEWAY_RAISED_EXCEPTION, "predict must be a named function")


def checked_values(
    pred: pd.DataFrame, ids: pd.Series, columns: Sequence[str], id_col: str, allow_missing: bool
) -> pd.DataFrame:
    """The predictor's answer as (id, *columns) doubles. Refused: other
    columns than ``columns``, another number of rows than ``ids``, columns
    that aren't numeric, and (unless ``allow_missing``) missing or infinite
    values."""
    if list(pred.columns) != list(columns) and sorted(map(str, pred.columns)) != sorted(columns):
        raise ValueError(f"predictor returned the columns {list(pred.columns)}; wanted {list(columns)}")
    if len(pred) != len(ids):
        raise ValueError(f"predictor returned {len(pred)} rows for {len(ids)} test rows")
    values = pred[list(columns)].reset_index(drop=True)
    text = [c for c in columns if not pd.api.types.is_numeric_dtype(values[c]) or pd.api.types.is_bool_dtype(values[c])]
    if text and len(ids):
        raise ValueError(f"predictor returned values that are not numbers in {text}")
    values = values.astype(float)
    if not allow_missing and not np.isfinite(values.to_numpy()).all():
        raise ValueError("predictor returned missing or infinite values")
    values.insert(0, id_col, ids.to_numpy())
    return values


def custom_predict(
    test: DataFrame,
    test_input: DataFrame,
    fn: PredictFn,
    keys: Sequence[str] = PLAY_KEYS,
    id_col: str = ROW_ID,
    columns: Sequence[str] = PREDICTION_COLUMNS,
    allow_missing: bool = False,
) -> DataFrame:
    """run ``fn`` once per play; output (id, *columns) as doubles. Every
    answer passes :func:`checked_values`. A play is the unit that ``fn`` is
    promised whole, so it must fit a Python worker; predictors that need no
    whole play scale by :func:`row_local_predict`."""
    check_named(fn)
    ship_package(test.sparkSession)
    out_cols = list(columns)
    id_type = test.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, " + ", ".join(f"{c} double" for c in out_cols)

    def per_play(test_pdf: pd.DataFrame, input_pdf: pd.DataFrame) -> pd.DataFrame:
        if test_pdf.empty:
            return pd.DataFrame({id_col: pd.Series([], dtype=object), **{c: pd.Series([], dtype=float) for c in out_cols}})
        return checked_values(fn(test_pdf.drop(columns=[id_col]), input_pdf), test_pdf[id_col], out_cols, id_col, allow_missing)

    return test.groupBy(*keys).cogroup(test_input.groupBy(*keys)).applyInPandas(per_play, schema)


def row_local_predict(
    rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], id_col: str = ROW_ID,
    columns: Sequence[str] = PREDICTION_COLUMNS, allow_missing: bool = False,
) -> DataFrame:
    """F1 for predictors that need no play context: Arrow batches through
    ``mapInPandas`` with no grouping, so no group size limit applies. ``fn``
    doesn't see the ids; every answer passes :func:`checked_values`."""
    check_named(fn)
    ship_package(rows.sparkSession)
    id_type = rows.schema[id_col].dataType.simpleString()
    out_cols = list(columns)
    schema = f"{id_col} {id_type}, " + ", ".join(f"{c} double" for c in out_cols)

    def batches(it):
        for pdf in it:
            yield checked_values(fn(pdf.drop(columns=[id_col])), pdf[id_col], out_cols, id_col, allow_missing)

    return rows.mapInPandas(batches, schema)
