"""Tracking views derived from the driver tables.

The driver provides no tracking data, so tracking-shaped views are derived
from ``events`` (correctness: small, unique ``event_id``) and ``lineitem``
(volume). Each view exists twice with the same semantics: as a Spark
DataFrame and as a DuckDB common table expression, so every registered query
has an oracle over the same whole tables.

Exactness rules followed by both sides: integer arithmetic, IEEE-exact
double ops (+, -, *, /, sqrt) and explicit casts; no engine-specific rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.schemas import FRAME_KEYS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- events view
_EVENTS_BASE_SPARK = [
    "concat('g', cast(div(day(ts) - 1, 7) AS string)) AS game_id",
    "div(user_id, 22) AS play_id",
    "user_id AS nfl_id",
    "cast((day(ts) - 1) * 24 + hour(ts) AS bigint) AS frame_id",
    "event_id AS row_id",
    "cast(div(day(ts) - 1, 7) + 1 AS int) AS week",
    "event_type AS player_position",
    "value AS x",
    "cast(get_json_object(props, '$.k') AS double) AS y",
]
_EVENTS_BASE_SQL = [
    "concat('g', CAST((day(ts) - 1) // 7 AS VARCHAR)) AS game_id",
    "user_id // 22 AS play_id",
    "user_id AS nfl_id",
    "CAST((day(ts) - 1) * 24 + hour(ts) AS BIGINT) AS frame_id",
    "event_id AS row_id",
    "CAST((day(ts) - 1) // 7 + 1 AS INTEGER) AS week",
    "event_type AS player_position",
    "value AS x",
    "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y",
]
# Second level: the same text is valid in both engines.
_TRACKING_DERIVED = [
    "y / CAST(10 AS DOUBLE) AS s",
    "CAST(row_id % 13 AS DOUBLE) AS a",
    "y * CAST(3.6 AS DOUBLE) AS dir",
    "CAST(5 + nfl_id % 10 AS BIGINT) AS num_frames_output",
    "CAST(10 + (nfl_id * 7) % 91 AS BIGINT) AS absolute_yardline_number",
    "CAST(50 AS DOUBLE) AS ball_land_x",
    "CAST(play_id % 54 AS DOUBLE) AS ball_land_y",
]
_FRAME_COLUMNS = [
    "game_id", "play_id", "nfl_id", "frame_id", "row_id", "week", "player_position",
    "x", "y",
]


def frames_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tracking frame per event: game = week of January, play = user
    bucket, player = user, frame = hour of the month, row id = event id."""
    base = table(spark, sf_dir, "events").selectExpr(*_EVENTS_BASE_SPARK)
    return base.selectExpr(*_FRAME_COLUMNS, *_TRACKING_DERIVED)


def labels_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label frames: every non-error frame, positions scaled by 0.9."""
    f = frames_events(spark, sf_dir)
    return f.where(F.col("player_position") != "error").selectExpr(
        *FRAME_KEYS, "x * CAST(0.9 AS DOUBLE) AS x", "y * CAST(0.9 AS DOUBLE) AS y"
    )


def test_input_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input frames, one per frame key (the earliest event wins). Uses an
    aggregate + semi join instead of a window so a hot key never lands in one
    window partition."""
    f = frames_events(spark, sf_dir)
    first = f.groupBy(*FRAME_KEYS).agg(F.min("row_id").alias("row_id"))
    return f.join(first.select("row_id"), "row_id", "left_semi")


def test_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to predict: every event, keyed one frame (hour) later."""
    return frames_events(spark, sf_dir).selectExpr(
        "CAST(row_id AS string) AS id", "game_id", "play_id", "nfl_id", "frame_id + 1 AS frame_id"
    )


# -------------------------------------------------------------- lineitem view
_LINEITEM_BASE = [
    "concat('s', CAST(l_suppkey AS VARCHAR)) AS game_id",
    "CAST(l_linenumber AS BIGINT) AS play_id",
    "CAST(ascii(l_returnflag) AS BIGINT) AS nfl_id",
    "l_orderkey AS frame_id",
    "l_partkey AS row_id",
    "CAST(month(l_shipdate) AS INTEGER) AS week",
    "l_linestatus AS player_position",
    "l_quantity AS x",
    "l_discount * CAST(100 AS DOUBLE) AS y",
    "l_tax * CAST(100 AS DOUBLE) AS s",
    "l_extendedprice / CAST(1000 AS DOUBLE) AS a",
    "l_discount * CAST(3600 AS DOUBLE) AS dir",
    "CAST(l_linenumber AS BIGINT) AS num_frames_output",
    "CAST(l_suppkey % 100 AS BIGINT) AS absolute_yardline_number",
    "CAST(60 AS DOUBLE) AS ball_land_x",
    "CAST(l_linenumber * 7 AS DOUBLE) AS ball_land_y",
]


def frames_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume fixture: game = supplier, play = line number, player = return
    flag, frame = order key, tie-break (row id) = part key."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *[e.replace("VARCHAR", "string") for e in _LINEITEM_BASE]
    )


def labels_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames_lineitem(spark, sf_dir)
    return f.where(F.col("player_position") == "F").selectExpr(
        *FRAME_KEYS, "x * CAST(0.9 AS DOUBLE) AS x", "y * CAST(0.9 AS DOUBLE) AS y"
    )


# ------------------------------------------------------------ SQL (DuckDB) side
SQL_VIEWS: dict[str, tuple[str, list[str]]] = {
    "frames_events": (
        "SELECT " + ", ".join(_FRAME_COLUMNS + _TRACKING_DERIVED)
        + " FROM (SELECT " + ", ".join(_EVENTS_BASE_SQL) + " FROM events) AS base",
        [],
    ),
    "labels_events": (
        "SELECT game_id, play_id, nfl_id, frame_id, x * CAST(0.9 AS DOUBLE) AS x, "
        "y * CAST(0.9 AS DOUBLE) AS y FROM frames_events WHERE player_position <> 'error'",
        ["frames_events"],
    ),
    "test_input_events": (
        "SELECT * FROM frames_events WHERE row_id IN "
        "(SELECT min(row_id) FROM frames_events GROUP BY game_id, play_id, nfl_id, frame_id)",
        ["frames_events"],
    ),
    "test_events": (
        "SELECT CAST(row_id AS VARCHAR) AS id, game_id, play_id, nfl_id, frame_id + 1 AS frame_id "
        "FROM frames_events",
        ["frames_events"],
    ),
    "frames_lineitem": ("SELECT " + ", ".join(_LINEITEM_BASE) + " FROM lineitem", []),
    "labels_lineitem": (
        "SELECT game_id, play_id, nfl_id, frame_id, x * CAST(0.9 AS DOUBLE) AS x, "
        "y * CAST(0.9 AS DOUBLE) AS y FROM frames_lineitem WHERE player_position = 'F'",
        ["frames_lineitem"],
    ),
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views (and their dependencies)."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for d in SQL_VIEWS[n][1]:
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL_VIEWS[n][0]})" for n in ordered) + "\n"


SPARK_VIEWS = {
    "frames_events": frames_events,
    "labels_events": labels_events,
    "test_input_events": test_input_events,
    "test_events": test_events,
    "frames_lineitem": frames_lineitem,
    "labels_lineitem": labels_lineitem,
}
