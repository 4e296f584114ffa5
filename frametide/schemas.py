"""Explicit schemas for the tracking tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Frame keys: one row per (game, play, player, frame).
FRAME_KEYS = ["game_id", "play_id", "nfl_id", "frame_id"]
# Series keys: one time series per player in a play.
PLAYER_KEYS = ["game_id", "play_id", "nfl_id"]
PLAY_KEYS = ["game_id", "play_id"]
ROW_ID = "id"
PREDICTION_COLUMNS = ["x", "y"]

TRACKING_INPUT = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("play_id", T.IntegerType()),
        T.StructField("player_to_predict", T.StringType()),
        T.StructField("nfl_id", T.IntegerType()),
        T.StructField("frame_id", T.IntegerType()),
        T.StructField("play_direction", T.StringType()),
        T.StructField("absolute_yardline_number", T.IntegerType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("player_height", T.StringType()),
        T.StructField("player_weight", T.DoubleType()),
        T.StructField("player_birth_date", T.StringType()),
        T.StructField("player_position", T.StringType()),
        T.StructField("player_side", T.StringType()),
        T.StructField("player_role", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("s", T.DoubleType()),
        T.StructField("a", T.DoubleType()),
        T.StructField("dir", T.DoubleType()),
        T.StructField("o", T.DoubleType()),
        T.StructField("num_frames_output", T.IntegerType()),
        T.StructField("ball_land_x", T.DoubleType()),
        T.StructField("ball_land_y", T.DoubleType()),
    ]
)

TRACKING_OUTPUT = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("play_id", T.IntegerType()),
        T.StructField("nfl_id", T.IntegerType()),
        T.StructField("frame_id", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

TEST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("play_id", T.IntegerType()),
        T.StructField("nfl_id", T.IntegerType()),
        T.StructField("frame_id", T.IntegerType()),
    ]
)

SUBMISSION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("Succeeded", T.BooleanType()),
        T.StructField("ErrorType", T.IntegerType()),
        T.StructField("ErrorName", T.StringType()),
        T.StructField("ErrorDetails", T.StringType()),
    ]
)

# The twelve model features, in the fixed order the models are trained on.
FEATURE_COLUMNS = [
    "x",
    "y",
    "s",
    "a",
    "dir_sin",
    "dir_cos",
    "num_frames_output",
    "absolute_yardline_number",
    "player_pos_code",
    "dx_ball",
    "dy_ball",
    "dist_ball",
]

# Columns coerced to numbers before features are built.
NUMERIC_FEATURE_INPUTS = [
    "x",
    "y",
    "s",
    "a",
    "num_frames_output",
    "absolute_yardline_number",
    "frame_id",
    "ball_land_x",
    "ball_land_y",
]
LAG_NUMERIC_INPUTS = ["frame_id", "x", "y", "s", "a"]
