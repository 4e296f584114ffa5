"""One-pass validated sink (V1, V2, V4-V6, V8 with S8).

Predictions are written once, to a staged folder, and measured while they
stream by: their number, the values that are no numbers and two 64-bit hash
sums over the ids. The expected ids are measured likewise where the test rows
are read. Equal counts and sums mean equal sets of ids, so a valid set is scored
and read once and its folder becomes the output. Anything else - also a count
that a rerun task reported twice - is settled by the exact report over the
staged rows, and a set that fails it leaves no output.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from frametide.operators.validate import ErrorType, ValidationError, check_columns, check_numeric, submission_report
from frametide.schemas import PREDICTION_COLUMNS, ROW_ID

REPORT_FIELDS = ("n_expected", "n_rows", "n_missing", "n_unexpected", "n_not_finite")


def report_details(report: dict) -> str:
    """Error details of a failed submission report: ``key=value`` pairs."""
    return ", ".join(f"{k}={report[k]}" for k in REPORT_FIELDS)


def _id_measures(id_col: str) -> list[Column]:
    sums = [F.sum(F.xxhash64(*parts).cast("decimal(38,0)")) for parts in ([F.col(id_col)], [F.lit(1), F.col(id_col)])]
    return [F.count(F.lit(1)).alias("n"), *[F.coalesce(s, F.lit(0)).alias(f"h{i}") for i, s in enumerate(sums)]]


def observe_ids(df: DataFrame, id_col: str = ROW_ID) -> tuple[DataFrame, Observation]:
    """``df`` whose ids are measured by whatever first computes it whole."""
    seen = Observation(f"ids-{uuid.uuid4().hex}")
    return df.observe(seen, *_id_measures(id_col)), seen


def _measured(seen: Observation) -> dict:
    """What was observed; nothing where the optimizer proved a part empty."""
    try:
        return seen.get
    except (Py4JJavaError, PySparkException):
        return {}


def _not_finite(columns: Sequence[str]) -> Column:
    bad = F.lit(False)
    for c in columns:
        v = F.col(c).cast("double")
        bad = bad | v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return bad


class _Folder:
    """A folder in whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def move(self, other: _Folder) -> None:
        if not self.fs.rename(self.path, other.path):
            raise OSError(f"cannot move {self.path} to {other.path}")


def write_validated(
    predictions: DataFrame,
    expected: DataFrame,
    path: str,
    expected_seen: Observation | None = None,
    id_col: str = ROW_ID,
    columns: Sequence[str] = PREDICTION_COLUMNS,
) -> dict:
    """Write (id, x, y) to ``path`` if they are valid for the ``expected`` rows
    and return the report; otherwise raise INVALID_SUBMISSION and leave what
    ``path`` held before. ``expected_seen`` (from :func:`observe_ids`, over the
    rows the predictions are computed from) saves reading ``expected`` again."""
    spark = predictions.sparkSession
    rows = check_columns(predictions, columns, id_col)
    check_numeric(rows, columns)
    received = Observation(f"received-{uuid.uuid4().hex}")
    measured = rows.observe(received, *_id_measures(id_col), F.count_if(_not_finite(columns)).alias("n_not_finite"))
    base = path.rstrip("/")
    staged = _Folder(spark, f"{base}.staged-{uuid.uuid4().hex}")
    try:
        measured.write.parquet(str(staged.path))
        got = _measured(received)
        want = _measured(expected_seen) if expected_seen is not None else expected.agg(*_id_measures(id_col)).first().asDict()
        if got and want and all(got[k] == want[k] for k in ("n", "h0", "h1")) and got["n_not_finite"] == 0:
            report = dict(zip(REPORT_FIELDS, (want["n"], got["n"], 0, 0, 0), strict=True)) | {"valid": True}
        else:
            report = submission_report(spark.read.schema(rows.schema).parquet(str(staged.path)), expected, columns, id_col).first().asDict()
        if not report["valid"]:
            raise ValidationError(ErrorType.INVALID_SUBMISSION, report_details(report))
        final, aside = _Folder(spark, base), _Folder(spark, f"{base}.replaced-{uuid.uuid4().hex}")
        if final.exists():
            final.move(aside)
        staged.move(final)
        aside.delete()
    except BaseException:
        staged.delete()
        raise
    return report
