"""Registered queries: feature engineering core (windows, scalar features,
encoders, feature pipelines) and the flagship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.functions.encoders import (
    category_code_first_seen,
    category_code_sorted,
    category_code_vocab,
    first_seen_codes,
)
from frametide.functions.geometry import ball_relative, direction_sin_cos
from frametide.functions.numeric import numeric
from frametide.operators import features as feat
from frametide.operators import joins
from frametide.operators.lags import find_hot_joined_groups, time_lag_features
from frametide.plans import sqltext as q
from frametide.plans.fixtures import frames_events, frames_lineitem, labels_events, with_views
from frametide.plans.registry import r6, register

# Player series above this many rows take the split lag path; hot series are
# found from a key-only sample of the scanned frames.
HOT_GROUP_ROWS = 2_000_000
from frametide.schemas import FEATURE_COLUMNS, FRAME_KEYS, PLAYER_KEYS


# =============================================================== flagship
@register(
    "play_motion_summary",
    with_views("frames_events")
    + ", lagged AS (" + q.lag_sql("frames_events") + ")\n"
    "SELECT game_id, play_id, count(*) AS n_frames, count(DISTINCT nfl_id) AS n_players, "
    f"{q.r6('avg(vx_lag_1)')} AS mean_vx, {q.r6('avg(vy_lag_1)')} AS mean_vy, "
    f"{q.r6('avg(sqrt(vx_lag_1 * vx_lag_1 + vy_lag_1 * vy_lag_1))')} AS mean_speed, "
    f"{q.r6('max(sqrt(vx_lag_1 * vx_lag_1 + vy_lag_1 * vy_lag_1))')} AS max_speed, "
    f"{q.r6('avg(sqrt((x - ball_land_x) * (x - ball_land_x) + (y - ball_land_y) * (y - ball_land_y)))')} AS mean_dist_ball, "
    f"{q.r6('avg(sin(radians(dir)))')} AS mean_dir_sin "
    "FROM lagged GROUP BY game_id, play_id",
)
def play_motion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: lags 1-3 per player (W5), heading and ball features (P4,
    P5), then per-play motion summary."""
    frames = frames_events(spark, sf_dir)
    lagged = time_lag_features(frames, tiebreak="row_id", hot_group_rows=HOT_GROUP_ROWS)
    feats = ball_relative(direction_sin_cos(lagged))
    speed = F.sqrt(F.col("vx_lag_1") * F.col("vx_lag_1") + F.col("vy_lag_1") * F.col("vy_lag_1"))
    return feats.groupBy("game_id", "play_id").agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_distinct("nfl_id").alias("n_players"),
        r6(F.avg("vx_lag_1")).alias("mean_vx"),
        r6(F.avg("vy_lag_1")).alias("mean_vy"),
        r6(F.avg(speed)).alias("mean_speed"),
        r6(F.max(speed)).alias("max_speed"),
        r6(F.avg("dist_ball")).alias("mean_dist_ball"),
        r6(F.avg("dir_sin")).alias("mean_dir_sin"),
    )


# =============================================================== windows
@register(
    "time_lag_features",
    with_views("frames_events") + q.lag_sql("frames_events"),
)
def lag_features_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts, deltas, dt (zero -> 0) and velocities for lags 1-3."""
    return time_lag_features(frames_events(spark, sf_dir), tiebreak="row_id", hot_group_rows=HOT_GROUP_ROWS)


@register(
    "time_lag_features_volume",
    with_views("frames_lineitem") + q.lag_sql("frames_lineitem", lags=(2,)),
)
def lag_features_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 (lag 2) on the volume fixture."""
    return time_lag_features(frames_lineitem(spark, sf_dir), lags=(2,), tiebreak="row_id", hot_group_rows=HOT_GROUP_ROWS)


# Two thirds of the volume fixture's rows as one series; rows that tie on (frame, part, line, x, y) are equal.
_HOT_SERIES = [
    "CASE WHEN row_id % 3 <> 0 THEN 'hot' ELSE game_id END AS game_id",
    "CASE WHEN row_id % 3 <> 0 THEN CAST(0 AS BIGINT) ELSE play_id END AS play_id",
    "CASE WHEN row_id % 3 <> 0 THEN CAST(0 AS BIGINT) ELSE nfl_id END AS nfl_id",
    "play_id AS line",
    "frame_id",
    "row_id",
    "x",
    "y",
]
HOT_SERIES_ROWS = 5_000


@register(
    "time_lag_features_hot",
    with_views("frames_lineitem")
    + f", hot_series AS (SELECT {', '.join(_HOT_SERIES)} FROM frames_lineitem) "
    + q.lag_sql("hot_series", order="frame_id, row_id, line, x, y"),
)
def time_lag_features_hot_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 where one series holds two thirds of all rows: cut into slices that
    are lagged in parallel, equal to one window over the whole series."""
    rows = frames_lineitem(spark, sf_dir).selectExpr(*_HOT_SERIES)
    return time_lag_features(rows, tiebreak=["row_id", "line", "x", "y"], hot_group_rows=HOT_SERIES_ROWS, coerce=False)


# =============================================================== scalar
@register(
    "ensure_numeric",
    with_views("frames_events")
    + "SELECT e.event_id AS row_id, "
    + q.numeric_text_sql("json_extract_string(e.props, '$.k')") + " AS k_num, "
    + q.numeric_text_sql("e.event_type") + " AS type_num, "
    + q.numeric_text_sql("e.props") + " AS props_num, "
    "coalesce(CASE WHEN isnan(e.value) THEN NULL ELSE e.value END, CAST(0 AS DOUBLE)) AS value_num, "
    "coalesce(e.user_id, 0) AS user_num, CAST(0 AS DOUBLE) AS missing_num FROM events AS e",
)
def ensure_numeric_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, double and integral columns coerced; absent column -> 0."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k_text", F.get_json_object("props", "$.k"))
    return e.select(
        F.col("event_id").alias("row_id"),
        numeric(e, "k_text").alias("k_num"),
        numeric(e, "event_type").alias("type_num"),
        numeric(e, "props").alias("props_num"),
        numeric(e, "value").alias("value_num"),
        numeric(e, "user_id").alias("user_num"),
        numeric(e, "no_such_column").alias("missing_num"),
    )


@register(
    "direction_sin_cos",
    with_views("frames_events")
    + f"SELECT row_id, {q.r6('radians(dir)')} AS dir_rad, {q.r6('sin(radians(dir))')} AS dir_sin, "
    f"{q.r6('cos(radians(dir))')} AS dir_cos FROM frames_events",
)
def direction_sin_cos_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 (values rounded to 6 decimals: libm differs in the last bit)."""
    d = direction_sin_cos(frames_events(spark, sf_dir))
    return d.select("row_id", r6("dir_rad").alias("dir_rad"), r6("dir_sin").alias("dir_sin"), r6("dir_cos").alias("dir_cos"))


@register(
    "ball_relative",
    with_views("frames_events")
    + "SELECT row_id, x - ball_land_x AS dx_ball, y - ball_land_y AS dy_ball, "
    "sqrt((x - ball_land_x) * (x - ball_land_x) + (y - ball_land_y) * (y - ball_land_y)) AS dist_ball "
    "FROM frames_events",
)
def ball_relative_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: offsets and distance to the ball landing point."""
    return ball_relative(frames_events(spark, sf_dir)).select("row_id", "dx_ball", "dy_ball", "dist_ball")


@register(
    "category_code_sorted",
    with_views("frames_events")
    + ", codes AS (" + q.sorted_code_sql("frames_events") + ")\n"
    "SELECT f.row_id, f.player_position, coalesce(c.code, -1) AS player_pos_code "
    "FROM frames_events AS f LEFT JOIN codes AS c ON f.player_position = c.code_value",
)
def category_code_sorted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank among sorted distinct values."""
    return category_code_sorted(frames_events(spark, sf_dir)).select("row_id", "player_position", "player_pos_code")


@register(
    "category_code_first_seen",
    with_views("frames_events")
    + ", codes AS (" + q.first_seen_code_sql("frames_events") + ")\n"
    "SELECT f.row_id, f.player_position, coalesce(c.code, -1) AS player_pos_code "
    "FROM frames_events AS f LEFT JOIN codes AS c ON f.player_position = c.code_value",
)
def category_code_first_seen_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order of first appearance (by row id)."""
    return category_code_first_seen(frames_events(spark, sf_dir), order_col="row_id").select(
        "row_id", "player_position", "player_pos_code"
    )


_TRAIN_ROWS_SQL = (
    "SELECT f.*, l.x AS x_target, l.y AS y_target FROM frames_events AS f JOIN labels_events AS l "
    "ON f.game_id = l.game_id AND f.play_id = l.play_id AND f.nfl_id = l.nfl_id AND f.frame_id = l.frame_id"
)


@register(
    "category_code_vocab",
    with_views("frames_events", "labels_events")
    + ", train AS (" + _TRAIN_ROWS_SQL + "), vocab AS (" + q.first_seen_code_sql("train") + ")\n"
    "SELECT f.row_id, f.player_position, coalesce(v.code, -1) AS player_pos_code "
    "FROM frames_events AS f LEFT JOIN vocab AS v ON f.player_position = v.code_value",
)
def category_code_vocab_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary fitted on the training join (first-seen order) is
    applied to all frames; values never seen in training get -1."""
    frames = frames_events(spark, sf_dir)
    labels = labels_events(spark, sf_dir)
    train = joins.join_inputs_outputs(frames, labels)
    codes = first_seen_codes(train, "player_position", "row_id")
    return category_code_vocab(frames, codes).select("row_id", "player_position", "player_pos_code")


def _features_select() -> list[Column]:
    return [
        "x", "y", "s", "a",
        r6("dir_sin").alias("dir_sin"), r6("dir_cos").alias("dir_cos"),
        "num_frames_output", "absolute_yardline_number", "player_pos_code",
        "dx_ball", "dy_ball", "dist_ball",
    ]


_FEATURES_SQL_COLS = (
    f"x, y, s, a, {q.r6('dir_sin')} AS dir_sin, {q.r6('dir_cos')} AS dir_cos, num_frames_output, "
    "absolute_yardline_number, player_pos_code, dx_ball, dy_ball, dist_ball"
)


@register(
    "prepare_features",
    with_views("frames_events")
    + ", codes AS (" + q.sorted_code_sql("frames_events") + "), feats AS ("
    + q.features_sql("frames_events", "codes") + ")\n"
    f"SELECT row_id, {_FEATURES_SQL_COLS} FROM feats",
)
def prepare_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve model features (P1 + P4 + P6 + P5)."""
    df, cols = feat.prepare_features(frames_events(spark, sf_dir))
    assert cols == FEATURE_COLUMNS
    return df.select("row_id", *_features_select())


@register(
    "engineer_features",
    with_views("frames_events", "labels_events")
    + ", train AS (" + _TRAIN_ROWS_SQL + "), lagged AS ("
    + q.lag_sql("train", order="frame_id, row_id, x_target, y_target") + "), codes AS ("
    + q.sorted_code_sql("lagged") + "), feats AS (" + q.features_sql("lagged", "codes") + ")\n"
    f"SELECT row_id, x_target, y_target, vx_lag_1, vy_lag_1, dt_lag_3, {_FEATURES_SQL_COLS} FROM feats",
)
def engineer_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P18 on the training join (J1): lags over the joined rows, then P9."""
    frames = frames_events(spark, sf_dir)
    labels = labels_events(spark, sf_dir)
    train = joins.join_inputs_outputs(frames, labels)
    # Fan-out copies of one input row tie on (frame, row id); the label
    # values order them so every copy gets a well-defined lag. Oversized
    # player series are found from key counts of both sides of the join.
    hot = find_hot_joined_groups(frames, labels, FRAME_KEYS, PLAYER_KEYS, HOT_GROUP_ROWS)
    df, _ = feat.engineer_features(train, tiebreak=["row_id", "x_target", "y_target"], hot_keys=hot)
    return df.select("row_id", "x_target", "y_target", "vx_lag_1", "vy_lag_1", "dt_lag_3", *_features_select())


@register(
    "select_features",
    with_views("frames_events")
    + ", base AS (SELECT * EXCLUDE (s, a), CAST(0 AS DOUBLE) AS s, CAST(0 AS DOUBLE) AS a FROM frames_events), "
    "codes AS (" + q.sorted_code_sql("base") + "), feats AS (" + q.features_sql("base", "codes") + ")\n"
    f"SELECT row_id, {_FEATURES_SQL_COLS} FROM feats",
)
def select_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + P3: input frames lacking two feature columns (s, a) projected to
    the twelve features in fixed order; absent columns become 0."""
    frames = frames_events(spark, sf_dir).drop("s", "a")
    out = feat.transform_for_inference(frames, FEATURE_COLUMNS, keep=["row_id"])
    assert out.columns == ["row_id", *FEATURE_COLUMNS]
    return out.select("row_id", *_features_select())


@register(
    "xy_legacy_features",
    with_views("frames_events")
    + ", codes AS (" + q.first_seen_code_sql("frames_events") + ")\n"
    f"SELECT f.row_id, f.x, f.y, f.s, f.a, {q.r6('sin(radians(f.dir))')} AS dir_sin, "
    f"{q.r6('cos(radians(f.dir))')} AS dir_cos, f.num_frames_output, f.absolute_yardline_number, "
    "coalesce(c.code, -1) AS player_pos_code FROM frames_events AS f "
    "LEFT JOIN codes AS c ON f.player_position = c.code_value",
)
def xy_legacy_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine-feature path (no ball features, first-seen codes)."""
    out = feat.xy_legacy_features(frames_events(spark, sf_dir), order_col="row_id", keep=["row_id"])
    return out.select(
        "row_id", "x", "y", "s", "a", r6("dir_sin").alias("dir_sin"), r6("dir_cos").alias("dir_cos"),
        "num_frames_output", "absolute_yardline_number", "player_pos_code",
    )
