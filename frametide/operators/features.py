"""Feature pipelines composed from the scalar functions.

Everything here is a projection over one DataFrame: Catalyst collapses the
chained ``withColumns`` into a single Project inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.functions.encoders import (
    category_code_first_seen,
    category_code_sorted,
    category_code_vocab,
)
from frametide.functions.geometry import ball_relative, direction_sin_cos, has_ball_columns
from frametide.functions.numeric import ensure_numeric, fill_missing_columns, numeric
from frametide.operators.lags import DEFAULT_LAGS, time_lag_features
from frametide.schemas import FEATURE_COLUMNS, NUMERIC_FEATURE_INPUTS


def prepare_features(
    df: DataFrame,
    vocabulary: Sequence[str] | DataFrame | None = None,
    encoder: str = "sorted",
    order_col: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Numeric coercion, heading sin/cos, position code, ball offsets.

    Position codes come from ``vocabulary`` when one is given (the fitted
    training vocabulary, P7); otherwise from the data itself, either sorted
    (P6, ``encoder="sorted"``) or by first appearance in ``order_col`` (P8);
    ``encoder="none"`` leaves the code column out.
    """
    ball_present = has_ball_columns(df)  # decided on the raw input
    out = ensure_numeric(df, NUMERIC_FEATURE_INPUTS)
    out = direction_sin_cos(out)
    if vocabulary is not None:
        out = category_code_vocab(out, vocabulary)
    elif encoder == "none":
        pass  # codes are applied later (e.g. after a vocabulary is fitted)
    elif encoder == "first_seen":
        out = category_code_first_seen(out, order_col=order_col or "row_id")
    else:
        out = category_code_sorted(out)
    out = ball_relative(out, present=ball_present)
    return out, list(FEATURE_COLUMNS)


def select_features(
    df: DataFrame, feature_columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """P2 + P3: add absent feature columns as 0, then project to
    ``keep`` (row identity, labels) followed by the features in fixed order."""
    filled = fill_missing_columns(df, feature_columns)
    return filled.select(*keep, *feature_columns)


def transform_for_inference(
    df: DataFrame,
    feature_columns: Sequence[str] = FEATURE_COLUMNS,
    vocabulary: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """P3 with the training vocabulary applied when supplied."""
    feats, _ = prepare_features(df, vocabulary=vocabulary)
    return select_features(feats, feature_columns, keep)


def clean_features(df: DataFrame, feature_columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Keep rows whose features are all present (null and NaN are
    missing; +-inf is kept). Labels travel in the same row, so nothing can
    misalign."""
    return df.dropna(subset=list(feature_columns))


def engineer_features(
    df: DataFrame,
    vocabulary: Sequence[str] | None = None,
    lags: Sequence[int] = DEFAULT_LAGS,
    tiebreak: str | Sequence[str] | None = None,
    hot_group_rows: int | None = None,
    hot_keys: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Lag features (W5) then the model features (P9). ``hot_keys``
    (e.g. sampled from the scanned inputs) routes oversized player series
    to the split lag path without sampling ``df`` itself."""
    lagged = time_lag_features(df, lags=lags, tiebreak=tiebreak, hot_group_rows=hot_group_rows, hot_keys=hot_keys)
    return prepare_features(lagged, vocabulary=vocabulary)


LEGACY_NUMERIC = ["x", "y", "s", "a", "num_frames_output", "absolute_yardline_number"]
LEGACY_FEATURES = ["x", "y", "s", "a", "dir_sin", "dir_cos", "num_frames_output", "absolute_yardline_number", "player_pos_code"]


def xy_legacy_features(
    df: DataFrame,
    feature_columns: Sequence[str] = LEGACY_FEATURES,
    order_col: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The nine-feature path - heading sin/cos, six numeric columns and a
    first-appearance position code; no ball features."""
    out = df.withColumn("dir_rad", F.radians(numeric(df, "dir")))
    out = out.withColumns({"dir_sin": F.sin("dir_rad"), "dir_cos": F.cos("dir_rad")})
    out = out.withColumns({c: numeric(out, c) for c in LEGACY_NUMERIC})
    out = category_code_first_seen(out, order_col=order_col)
    return out.select(*keep, *feature_columns)
