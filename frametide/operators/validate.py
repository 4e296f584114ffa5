"""Prediction and artifact validation (V1-V11) and set checks.

Row-level checks are single aggregations that return report rows (no
per-batch loop and no collect of data); schema checks run at plan time on
``DataFrame.schema`` and raise :class:`ValidationError`.
"""

from __future__ import annotations

import enum
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frametide.schemas import PREDICTION_COLUMNS, ROW_ID


class ErrorType(enum.Enum):
    # The status codes of the evaluation result file.
    UNSPECIFIED = 0
    SERVER_NEVER_STARTED = 1
    SERVER_CONNECTION_FAILED = 2
    SERVER_RAISED_EXCEPTION = 3
    SERVER_MISSING_ENDPOINT = 4
    GATEWAY_RAISED_EXCEPTION = 5
    INVALID_SUBMISSION = 6
    GRPC_DEADLINE_EXCEEDED = 7


class ValidationError(Exception):
    def __init__(self, error_type: ErrorType, details: str | None = None):
        super().__init__(f"{error_type.name}: {details}")
        self.error_type = error_type
        self.details = details


# Plausible field coordinates for predictions.
X_BOUNDS = (-10.0, 130.0)
Y_BOUNDS = (-10.0, 100.0)


# ----------------------------------------------------------- plan-time checks
@dataclass(frozen=True)
class SchemaDiff:
    """How a frame's columns differ from the wanted numeric ones."""

    missing: tuple[str, ...]
    unexpected: tuple[str, ...]
    repeated: tuple[str, ...]
    not_numeric: tuple[str, ...]

    @property
    def names_differ(self) -> bool:
        return bool(self.missing or self.unexpected or self.repeated)

    def __str__(self) -> str:
        found = ((k.replace("_", " "), v) for k, v in vars(self).items() if v)
        return "; ".join(f"{k}: {', '.join(v)}" for k, v in found) or "no difference"


def schema_diff(df: DataFrame, wanted: Sequence[str], also_allowed: Sequence[str] = ()) -> SchemaDiff:
    seen = Counter(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    return SchemaDiff(
        missing=tuple(c for c in wanted if c not in seen),
        unexpected=tuple(c for c in seen if c not in wanted and c not in also_allowed),
        repeated=tuple(c for c, n in seen.items() if n > 1),
        not_numeric=tuple(c for c in wanted if c in types and not isinstance(types[c], T.NumericType)),
    )


def check_required_column(df: DataFrame, column: str = ROW_ID) -> None:
    """V3: the row id column must be present in the test rows."""
    if column not in df.columns:
        raise ValidationError(ErrorType.GATEWAY_RAISED_EXCEPTION, f"test rows without a {column!r} column: {df.columns}")


def check_columns(
    predictions: DataFrame, expected: Sequence[str] = PREDICTION_COLUMNS, id_col: str | None = None
) -> DataFrame:
    """V2 + U4: prediction columns are exactly ``expected`` (no id column, no
    duplicates); returns the predictions reordered to ``expected``
    (plus ``id_col`` first when given, which is then allowed)."""
    extra = [id_col] if id_col else []
    diff = schema_diff(predictions, expected, extra)
    if diff.names_differ:
        raise ValidationError(ErrorType.INVALID_SUBMISSION, f"prediction columns: {diff}")
    return predictions.select(*extra, *expected)


def check_numeric(predictions: DataFrame, columns: Sequence[str] = PREDICTION_COLUMNS) -> None:
    """V4: prediction columns must have numeric types."""
    diff = schema_diff(predictions, columns, predictions.columns)
    if diff.not_numeric:
        raise ValidationError(ErrorType.INVALID_SUBMISSION, f"prediction types: {diff}")


def check_union_schemas(frames: Sequence[DataFrame]) -> None:
    """U2 pre-check: same column names in the same order, types that widen."""
    kinds = [
        [(f.name, "number" if isinstance(f.dataType, T.NumericType) else f.dataType.simpleString()) for f in df.schema.fields]
        for df in frames
    ]
    for i, other in enumerate(kinds[1:], 1):
        if other != kinds[0]:
            raise ValidationError(ErrorType.INVALID_SUBMISSION, f"batch {i} has {other}, the first batch {kinds[0]}")


def concat_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of prediction batches; numeric types widen (int -> double)."""
    check_union_schemas(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------- row-level checks
def row_alignment(expected: DataFrame, predictions: DataFrame, batch: str, id_col: str = ROW_ID) -> DataFrame:
    """V1: per batch, expected ids vs predictions received for them.

    Compares id sets, not only counts: ``n_missing`` ids got no prediction,
    ``n_duplicate`` extra predictions for an expected id, ``n_extra``
    predictions for ids that were never asked for (batch is null for those).
    """
    per_id = predictions.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n_pred"))
    exp = expected.select(id_col, batch).withColumn("_expected", F.lit(True))
    joined = exp.join(per_id, id_col, "full")
    n_pred = F.coalesce(F.col("_n_pred"), F.lit(0))
    is_exp = F.coalesce(F.col("_expected"), F.lit(False))
    report = joined.groupBy(batch).agg(
        F.count_if(is_exp).alias("n_expected"),
        F.sum(n_pred).cast("long").alias("n_received"),
        F.count_if(is_exp & (n_pred == 0)).alias("n_missing"),
        F.coalesce(F.sum(F.when(is_exp & (n_pred > 1), n_pred - 1)), F.lit(0)).cast("long").alias("n_duplicate"),
        F.coalesce(F.sum(F.when(~is_exp, n_pred)), F.lit(0)).cast("long").alias("n_extra"),
    )
    aligned = (F.col("n_missing") == 0) & (F.col("n_duplicate") == 0) & (F.col("n_extra") == 0)
    return report.withColumn("aligned", aligned)


def _in_bounds(c: Column, bounds: tuple[float, float]) -> Column:
    return (c >= F.lit(bounds[0])) & (c <= F.lit(bounds[1]))


def prediction_report(
    predictions: DataFrame,
    columns: Sequence[str] = PREDICTION_COLUMNS,
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """V5 + V6 + V7 in one pass: per column the null, NaN, +-inf and
    out-of-bounds counts (NaN/inf/null are not counted as out of bounds)."""
    bounds = {"x": X_BOUNDS, "y": Y_BOUNDS} if bounds is None else bounds
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        col = F.col(c).cast("double")
        aggs += [
            F.count_if(col.isNull()).alias(f"{c}_null"),
            F.count_if(F.isnan(col)).alias(f"{c}_nan"),
            F.count_if(F.abs(col) == F.lit(float("inf"))).alias(f"{c}_inf"),
        ]
        if c in bounds:
            finite = col.isNotNull() & ~F.isnan(col) & (F.abs(col) != F.lit(float("inf")))
            aggs.append(F.count_if(finite & ~_in_bounds(col, bounds[c])).alias(f"{c}_out_of_bounds"))
    return predictions.agg(*aggs)


def submission_report(
    submission: DataFrame, test: DataFrame, columns: Sequence[str] = PREDICTION_COLUMNS, id_col: str = ROW_ID
) -> DataFrame:
    """V8: one row - expected vs delivered rows, unknown/missing ids and
    non-finite values; ``valid`` is the conjunction, every id delivered as
    often as it is expected."""
    bad = F.lit(False)
    for c in columns:
        col = F.col(c).cast("double")
        bad = bad | col.isNull() | F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    sub = submission.groupBy(id_col).agg(F.count(F.lit(1)).alias("_sub"), F.count_if(bad).alias("_bad"))
    exp = test.groupBy(id_col).agg(F.count(F.lit(1)).alias("_exp"))
    joined = exp.join(sub, id_col, "full")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    report = joined.agg(
        total("_exp").alias("n_expected"),
        total("_sub").alias("n_rows"),
        total(F.when(F.col("_sub").isNull(), F.col("_exp"))).alias("n_missing"),
        total(F.when(F.col("_exp").isNull(), F.col("_sub"))).alias("n_unexpected"),
        total("_bad").alias("n_not_finite"),
        F.count_if(~F.col("_exp").eqNullSafe(F.col("_sub"))).alias("_uneven"),
    )
    valid = (F.col("_uneven") == 0) & (F.col("n_not_finite") == 0)
    return report.withColumn("valid", valid).drop("_uneven")


def classify_failure(report: DataFrame) -> DataFrame:
    """Map an alignment report (V1) to an error code and name per batch:
    a batch without expected ids is a gateway fault, any misalignment an
    invalid submission, else no error (null)."""
    code = (
        F.when(F.col("n_expected") == 0, F.lit(ErrorType.GATEWAY_RAISED_EXCEPTION.value))
        .when(~F.col("aligned"), F.lit(ErrorType.INVALID_SUBMISSION.value))
    )
    name = (
        F.when(F.col("n_expected") == 0, F.lit(ErrorType.GATEWAY_RAISED_EXCEPTION.name))
        .when(~F.col("aligned"), F.lit(ErrorType.INVALID_SUBMISSION.name))
    )
    return report.withColumn("error_type", code).withColumn("error_name", name)


def apply_checks(df: DataFrame, checks: Iterable[tuple[str, Column]]) -> DataFrame:
    """user-supplied (name, row predicate) checks, evaluated in one pass;
    each output column counts the rows that FAIL its predicate."""
    return df.agg(*[F.count_if(~F.coalesce(pred, F.lit(False))).alias(name) for name, pred in checks])


# --------------------------------------------------------------- set checks
def week_pairing(input_weeks: DataFrame, output_weeks: DataFrame, week: str = "week") -> DataFrame:
    """Every week present on either side, flagged per side."""
    a = input_weeks.select(week).distinct().withColumn("in_inputs", F.lit(True))
    b = output_weeks.select(week).distinct().withColumn("in_outputs", F.lit(True))
    return a.join(b, week, "full").select(
        week,
        F.coalesce("in_inputs", F.lit(False)).alias("in_inputs"),
        F.coalesce("in_outputs", F.lit(False)).alias("in_outputs"),
    )


def split_files_report(pairing: DataFrame) -> DataFrame:
    """At least one input and output week and every week paired."""
    return pairing.agg(
        F.count_if("in_inputs").alias("n_input_weeks"),
        F.count_if("in_outputs").alias("n_output_weeks"),
        F.count_if(F.col("in_inputs") != F.col("in_outputs")).alias("n_unpaired"),
    ).withColumn(
        "ok", (F.col("n_input_weeks") > 0) & (F.col("n_output_weeks") > 0) & (F.col("n_unpaired") == 0)
    )


# ---------------------------------------------------------- metadata check
# Keys that a model metadata record must hold.
REQUIRED_METADATA_KEYS = ("feature_columns", "ensemble_weights", "model_files")


def metadata_report(meta_df: DataFrame, min_features: int = 5, required: Sequence[str] = REQUIRED_METADATA_KEYS) -> DataFrame:
    """V9 as predicates over metadata rows (``feature_columns`` array,
    ``weights`` map<string,double>), evaluated by Spark. A required key that
    is no column, or null, clears ``required_keys``; a missing value fails
    the predicates on it."""
    present = F.lit(True)
    for key in required:
        present = present & (F.col(key).isNotNull() if key in meta_df.columns else F.lit(False))
    feats = F.col("feature_columns")
    wsum = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda acc, v: acc + v)
    flags = {
        "features_unique": F.size(F.array_distinct(feats)) == F.size(feats),
        "enough_features": F.size(feats) >= min_features,
        "weights_positive": F.forall(F.map_values("weights"), lambda v: v > 0),
        "weights_sum_to_one": F.abs(wsum - 1.0) < 0.01,
    }
    return meta_df.select("*", present.alias("required_keys"), *[F.coalesce(c, F.lit(False)).alias(k) for k, c in flags.items()])
