"""Registered queries: file sources and sinks.

Each query lays fixture data out in the reference's file formats under the
session's shared checkpoint folder (one distributed write), then scans it
back with the operator under test; the oracle is the fixture view itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.functions.keys import week_from_filename
from frametide.operators import joins
from frametide.operators.validate import ValidationError
from frametide.plans.fixtures import frames_events, labels_events, test_events, test_input_events, with_views
from frametide.plans.registry import register
from frametide.session import staging_path
from frametide.sources import files, headers, sinks, validated

PERSIST_SQL = (
    "SELECT t.id, i.x, i.y FROM test_events AS t "
    "LEFT JOIN test_input_events AS i USING (game_id, play_id, nfl_id, frame_id)"
)
LABEL_WEEK_SQL = "SELECT *, CAST(substr(game_id, 2) AS INTEGER) + 1 AS week FROM labels_events"


def _labels_with_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels_events(spark, sf_dir).withColumn("week", F.substring("game_id", 2, 10).cast("int") + 1)


def _staged_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    frames = frames_events(spark, sf_dir)
    root = staging_path(spark, "weekly")
    files.write_weekly_csv(frames, f"{root}/inputs", "input")
    return frames, root


@register("scan_inputs", with_views("frames_events") + "SELECT * FROM frames_events")
def scan_inputs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + P16: weekly input CSVs scanned by glob with an explicit
    schema; week parsed from each file's name."""
    frames, root = _staged_inputs(spark, sf_dir)
    schema = frames.drop("week").schema
    return files.scan_inputs(spark, schema=schema, pattern=f"{root}/inputs/file=input_*.csv")


@register("scan_outputs", with_views("labels_events") + LABEL_WEEK_SQL)
def scan_outputs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: weekly label CSVs with week from the file name."""
    labels = _labels_with_week(spark, sf_dir)
    root = staging_path(spark, "weekly")
    files.write_weekly_csv(labels, f"{root}/outputs", "output")
    return files.scan_outputs(spark, schema=labels.drop("week").schema, pattern=f"{root}/outputs/file=output_*.csv")


@register(
    "concat_files",
    with_views("frames_events", "labels_events")
    + "SELECT * REPLACE (CAST(row_id AS DOUBLE) AS row_id, CAST(num_frames_output AS DOUBLE) AS num_frames_output, "
    "CAST(absolute_yardline_number AS DOUBLE) AS absolute_yardline_number) FROM "
    f"(SELECT * FROM frames_events UNION ALL BY NAME ({LABEL_WEEK_SQL})) AS u",
)
def concat_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input and label files concatenated by column name; columns a file
    lacks are null (integral ones reported as double, as a pandas concat)."""
    frames, root = _staged_inputs(spark, sf_dir)
    labels = _labels_with_week(spark, sf_dir)
    files.write_weekly_csv(labels, f"{root}/outputs", "output")
    a = files.scan_inputs(spark, schema=frames.drop("week").schema, pattern=f"{root}/inputs/file=input_*.csv")
    b = files.scan_outputs(spark, schema=labels.drop("week").schema, pattern=f"{root}/outputs/file=output_*.csv")
    out = a.unionByName(b, allowMissingColumns=True)
    return out.withColumns({c: F.col(c).cast("double") for c in ("row_id", "num_frames_output", "absolute_yardline_number")})


_EARLY, _SHORT = "week <= 2", "week = 3"


def _staged_unlike(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Weekly files in three layouts: weeks 1 and 2 with reversed columns, week
    3 without two of them and with one of its own, the rest as they are."""
    frames = frames_events(spark, sf_dir)
    root = staging_path(spark, "unlike")
    files.write_weekly_csv(frames.where(_EARLY).select(*reversed(frames.columns)), f"{root}/a", "input")
    files.write_weekly_csv(frames.where(_SHORT).drop("dir", "ball_land_x").withColumn("weather", F.lit("rain")), f"{root}/b", "input")
    files.write_weekly_csv(frames.where(f"NOT ({_EARLY} OR {_SHORT})"), f"{root}/c", "input")
    return frames, f"{root}/*/file=input_*.csv"


@register(
    "concat_unlike_files",
    with_views("frames_events")
    + f"SELECT * REPLACE (CASE WHEN {_SHORT} THEN NULL ELSE dir END AS dir, "
    f"CASE WHEN {_SHORT} THEN NULL ELSE ball_land_x END AS ball_land_x) FROM frames_events",
)
def concat_unlike_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + U1: weekly files whose headers differ, concatenated by column
    name; a column that a file lacks is null, unknown columns are left out."""
    frames, pattern = _staged_unlike(spark, sf_dir)
    return files.scan_inputs(spark, schema=frames.drop("week").schema, pattern=pattern)


@register(
    "concat_unlike_columns",
    with_views("frames_events")
    + f"SELECT week, count(*) AS n_rows, count(CASE WHEN NOT {_SHORT} THEN dir END) AS n_dir, count(CASE WHEN NOT {_SHORT} THEN ball_land_x END) AS n_ball, "
    + f"count(CASE WHEN {_SHORT} THEN 1 END) AS n_weather FROM frames_events GROUP BY week",
)
def concat_unlike_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 without a schema: every column of any file is kept; filled cells per week."""
    _, pattern = _staged_unlike(spark, sf_dir)
    every = headers.scan_by_name(spark, pattern, with_source=True)
    week = week_from_filename(F.col("source_file")).alias("week")
    counts = {"n_dir": "dir", "n_ball": "ball_land_x", "n_weather": "weather"}
    return every.groupBy(week).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(k) for k, c in counts.items()])


#: Texts that stand where numbers belong, by row id, in both dialects.
_SPOILED = {"x": (7, "'n/a'"), "frame_id": (11, "'12f'"), "s": (13, "'--' || row_id % 3")}


def _spoiled(frames: DataFrame) -> DataFrame:
    return frames.withColumns({c: F.expr(f"CASE WHEN row_id % {n} = 0 THEN {text} ELSE string({c}) END") for c, (n, text) in _SPOILED.items()})


_REJECTS_SQL = " UNION ALL ".join(
    f"SELECT week, '{c}' AS column_name, count(*) AS n_rows, count_if(row_id % {n} = 0) AS n_rejected, "
    f"min(CASE WHEN row_id % {n} = 0 THEN {text} END) AS example FROM frames_events GROUP BY week"
    for c, (n, text) in _SPOILED.items()
)


@register("reject_report", with_views("frames_events") + _REJECTS_SQL)
def reject_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: cells of the weekly files that are no value of their column's
    type, per week and column, with an example."""
    frames = frames_events(spark, sf_dir)
    root = staging_path(spark, "spoiled")
    files.write_weekly_csv(_spoiled(frames), f"{root}/inputs", "input")
    schema = frames.select(*_SPOILED).schema
    found = headers.reject_report(spark, f"{root}/inputs/file=input_*.csv", schema)
    week = week_from_filename(F.col("file")).alias("week")
    return found.groupBy(week, "column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"), F.min("example").alias("example"))


@register(
    "reject_report_json",
    with_views("frames_events")
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count_if(row_id % {n} = 0) AS n_rejected FROM frames_events" for c, (n, _) in _SPOILED.items()),
)
def reject_report_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable values of request rows, per key."""
    frames = frames_events(spark, sf_dir)
    path = staging_path(spark, "spoiled_requests")
    _spoiled(frames).write.mode("overwrite").json(path)
    found = headers.reject_report(spark, path, frames.select(*_SPOILED).schema, json_lines=True)
    return found.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"))


@register("scan_test_input", with_views("test_input_events") + "SELECT * FROM test_input_events")
def scan_test_input_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``test_input.csv`` read back with its schema."""
    ti = test_input_events(spark, sf_dir)
    base = staging_path(spark, "testdir")
    ti.write.mode("overwrite").option("header", True).csv(f"{base}/test_input.csv")
    return files.scan_test_input(spark, base, ti.schema)


@register("scan_gateway_csv", with_views("test_events") + "SELECT * FROM test_events")
def scan_gateway_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S6 (+ V3): ``test.csv`` and ``test_input.csv`` read as a pair,
    checking the row id column; returns the test rows."""
    t = test_events(spark, sf_dir)
    ti = test_input_events(spark, sf_dir)
    base = staging_path(spark, "testdir")
    t.write.mode("overwrite").option("header", True).csv(f"{base}/test.csv")
    ti.write.mode("overwrite").option("header", True).csv(f"{base}/test_input.csv")
    test, _ = files.scan_gateway(spark, base, t.schema, ti.schema)
    return test


@register("scan_reordered_csv", with_views("test_events") + "SELECT * FROM test_events")
def scan_reordered_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose header names the columns in another order."""
    t = test_events(spark, sf_dir)
    path = staging_path(spark, "reordered")
    t.select(*reversed(t.columns)).write.mode("overwrite").option("header", True).csv(path)
    return files.scan_csv_glob(spark, path, t.schema)


@register("scan_json_rows", with_views("frames_events") + "SELECT * FROM frames_events")
def scan_json_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request rows as JSON lines, read with an explicit schema."""
    frames = frames_events(spark, sf_dir)
    path = staging_path(spark, "requests")
    frames.write.mode("overwrite").json(path)
    return files.scan_json_rows(spark, path, frames.schema)


@register(
    "sink_submission_parquet",
    with_views("test_events", "test_input_events")
    + f"SELECT t.id, p.x, p.y FROM test_events AS t LEFT JOIN (SELECT * FROM ({PERSIST_SQL}) AS q "
    "WHERE x IS NOT NULL) AS p USING (id)",
)
def sink_submission_parquet_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + J5 + P15: predictions joined to every row id, ids first, written
    as parquet and read back."""
    preds = joins.persistence_baseline(test_events(spark, sf_dir), test_input_events(spark, sf_dir))
    path = staging_path(spark, "submission")
    sinks.write_submission_parquet(preds.where(F.col("x").isNotNull()), path, row_ids=test_events(spark, sf_dir))
    return spark.read.parquet(path)


@register(
    "sink_submission_csv",
    with_views("test_events", "test_input_events") + f"SELECT x, y FROM ({PERSIST_SQL}) AS p",
)
def sink_submission_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The external x,y CSV (header, id order) read back."""
    preds = joins.persistence_baseline(test_events(spark, sf_dir), test_input_events(spark, sf_dir))
    path = staging_path(spark, "submission_csv")
    sinks.write_submission_csv(preds, path)
    return spark.read.schema("x double, y double").option("header", True).csv(path)


_REPORT_SQL = (
    "SELECT count_if(eid IS NOT NULL) AS n_expected, count_if(s IS NOT NULL) AS n_rows, "
    "count_if(s IS NULL) AS n_missing, count_if(eid IS NULL) AS n_unexpected, "
    "count_if(s IS NOT NULL AND (x IS NULL OR isnan(x) OR abs(x) = CAST('inf' AS DOUBLE) OR y IS NULL OR isnan(y) "
    "OR abs(y) = CAST('inf' AS DOUBLE))) AS n_not_finite FROM (SELECT t.id AS eid, sub.* FROM "
    f"(SELECT id FROM test_events) AS t FULL JOIN (SELECT id, x, y, true AS s FROM ({PERSIST_SQL}) AS p) AS sub "
    "ON t.id = sub.id) AS j"
)
_VALID_SQL = "n_expected = n_rows AND n_missing = 0 AND n_unexpected = 0 AND n_not_finite = 0"


@register(
    "sink_result_json",
    with_views("test_events", "test_input_events")
    + f", r AS ({_REPORT_SQL}) SELECT {_VALID_SQL} AS Succeeded, "
    f"CASE WHEN {_VALID_SQL} THEN NULL ELSE 6 END AS ErrorType, "
    f"CASE WHEN {_VALID_SQL} THEN NULL ELSE 'INVALID_SUBMISSION' END AS ErrorName, "
    f"CASE WHEN {_VALID_SQL} THEN NULL ELSE 'n_expected=' || CAST(n_expected AS VARCHAR) || ', n_rows=' || "
    "CAST(n_rows AS VARCHAR) || ', n_missing=' || CAST(n_missing AS VARCHAR) || ', n_unexpected=' || "
    "CAST(n_unexpected AS VARCHAR) || ', n_not_finite=' || CAST(n_not_finite AS VARCHAR) END AS ErrorDetails FROM r",
)
def sink_result_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 (+ V8, V11): validate the persistence submission, write the status
    record and read it back (one row)."""
    from frametide.plans.score import validate_submission

    test = test_events(spark, sf_dir)
    preds = joins.persistence_baseline(test, test_input_events(spark, sf_dir))
    error = None
    try:
        validate_submission(preds, test)
    except ValidationError as exc:
        error = exc
    path = staging_path(spark, "result")
    sinks.write_result_json(spark, path, error)
    return spark.read.schema(sinks.RESULT).json(path)


_SINK_CASES = {
    "as_is": ("true", "x"),
    "filled": ("true", "coalesce(x, 0)"),
    "short": ("id NOT LIKE '%7'", "coalesce(x, 0)"),
}


def _sink_case_sql(case: str, keep: str, x: str) -> str:
    chosen = f"(SELECT id, {x} AS x, coalesce(y, 0) AS y FROM ({PERSIST_SQL}) AS p WHERE {keep})"
    return (
        f"SELECT '{case}' AS attempt, (SELECT count(*) FROM test_events) AS n_expected, count(*) AS n_rows, "
        "(SELECT count(*) FROM test_events) - count(*) AS n_missing, 0 AS n_unexpected, count_if(x IS NULL) AS n_not_finite "
        f"FROM {chosen} AS c"
    )


@register(
    "sink_validated",
    with_views("test_events", "test_input_events")
    + ", r AS ("
    + " UNION ALL ".join(_sink_case_sql(c, *v) for c, v in _SINK_CASES.items())
    + ") SELECT attempt, n_expected, n_rows, n_missing, CAST(n_unexpected AS BIGINT) AS n_unexpected, n_not_finite, "
    "CASE WHEN n_missing = 0 AND n_not_finite = 0 THEN n_rows ELSE 0 END AS n_published FROM r",
)
def sink_validated_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + V1, V2, V4-V6, V8: three submissions sent to the one-pass validated
    sink, as the model-free baseline gives them, with gaps filled, and with
    rows left out; what the sink counted, and the rows it then published."""
    test, seen_input = test_events(spark, sf_dir), test_input_events(spark, sf_dir)
    rows = []
    for case, (keep, x) in _SINK_CASES.items():
        measured, seen = validated.observe_ids(test)
        preds = joins.persistence_baseline(measured, seen_input).where(keep).selectExpr("id", f"{x} AS x", "coalesce(y, 0) AS y")
        path = staging_path(spark, "validated")
        try:
            report = validated.write_validated(preds, test, path, seen)
        except ValidationError as err:
            report = dict(part.split("=") for part in err.details.split(", "))
        published = files.scan_parquet_or_empty(spark, path, preds.schema).count()
        rows.append((case, *[int(report[k]) for k in validated.REPORT_FIELDS], published))
    names = ", ".join(f"{k} bigint" for k in (*validated.REPORT_FIELDS, "n_published"))
    return spark.createDataFrame(rows, f"attempt string, {names}")


@register("frame_parquet_lz4", with_views("frames_events") + "SELECT * FROM frames_events")
def frame_parquet_lz4_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame table through lz4-compressed parquet and back."""
    path = staging_path(spark, "lz4")
    sinks.write_parquet_lz4(frames_events(spark, sf_dir), path)
    return spark.read.parquet(path)



@register("scan_validation_weeks", with_views("frames_events") + "SELECT * FROM frames_events WHERE week > 3")
def scan_validation_weeks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + O7 at scale: frames stored as week-partitioned parquet; the
    validation weeks of the temporal split are read by partition pruning."""
    from frametide.sources.layout import scan_weeks, weeks_after, write_week_partitioned

    path = staging_path(spark, "by_week")
    write_week_partitioned(frames_events(spark, sf_dir), path)
    return scan_weeks(spark, path, weeks_after(3))
