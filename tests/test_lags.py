"""Lag window (W1-W5): ledger cases, brute force, skew split, plan shape."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frametide.operators.joins import join_inputs_outputs
from frametide.operators.lags import find_hot_groups, find_hot_joined_groups, lag_column_names, time_lag_features
from frametide.schemas import FRAME_KEYS, PLAYER_KEYS


def brute_force(pdf: pd.DataFrame, lags=(1, 2, 3)) -> pd.DataFrame:
    """Straightforward per-group loop (test oracle only)."""
    out = []
    for _, g in pdf.sort_values(PLAYER_KEYS + ["frame_id", "row_id"]).groupby(PLAYER_KEYS, sort=False):
        g = g.copy()
        for k in lags:
            xs, ys, fs = g["x"].shift(k), g["y"].shift(k), g["frame_id"].shift(k)
            dt = (g["frame_id"] - fs).replace(0, np.nan)
            g[f"dx_lag_{k}"] = (g["x"] - xs).fillna(0.0)
            g[f"dy_lag_{k}"] = (g["y"] - ys).fillna(0.0)
            g[f"dt_lag_{k}"] = dt.fillna(0.0)
            g[f"vx_lag_{k}"] = ((g["x"] - xs) / dt).fillna(0.0)
            g[f"vy_lag_{k}"] = ((g["y"] - ys) / dt).fillna(0.0)
        out.append(g)
    return pd.concat(out)


def _frames(spark, n=3000, groups=40, seed=3, hot_share=0.0):
    rng = np.random.default_rng(seed)
    player = rng.integers(0, groups, n)
    if hot_share:
        player[: int(n * hot_share)] = 0
    pdf = pd.DataFrame(
        {
            "game_id": "g",
            "play_id": 1,
            "nfl_id": player.astype("int64"),
            "frame_id": rng.integers(0, n // 4, n).astype("int64"),
            "row_id": np.arange(n, dtype="int64"),
            "x": rng.normal(50, 10, n).round(2),
            "y": rng.normal(25, 5, n).round(2),
        }
    )
    return pdf, spark.createDataFrame(pdf)


def _compare(spark_df, expected, lags=(1, 2, 3)):
    cols = [c for k in lags for c in lag_column_names(k) if "shift" not in c]
    got = spark_df.toPandas().sort_values("row_id").reset_index(drop=True)
    exp = expected.sort_values("row_id").reset_index(drop=True)
    for c in cols:
        np.testing.assert_array_equal(got[c].to_numpy(), exp[c].to_numpy(), err_msg=c)


def test_matches_brute_force(spark):
    pdf, df = _frames(spark)
    _compare(time_lag_features(df, tiebreak="row_id"), brute_force(pdf))


def test_hot_group_split_is_exact(spark):
    # one player holds 60 % of all rows; the split path must give the same values
    pdf, df = _frames(spark, n=4000, hot_share=0.6)
    split = time_lag_features(df.repartition(5), tiebreak="row_id", hot_group_rows=200, hot_sample_fraction=0.5)
    _compare(split, brute_force(pdf))
    assert split.count() == len(pdf)


def _fan_out(spark):
    """Series 1: one frame of 60 inputs and 150 labels; series 2: 900 frames of
    3 and 4; series 3: 300 rows that stay alone; series 4: no label."""
    left = [(1, 0)] * 60 + [(2, f) for f in range(900) for _ in range(3)] + [(3, f) for f in range(300)] + [(4, f) for f in range(9000)]
    right = [(1, 0)] * 150 + [(2, f) for f in range(900) for _ in range(4)] + [(3, f) for f in range(300)]
    schema = "game_id string, play_id bigint, nfl_id bigint, frame_id bigint, row_id bigint, x double, y double"

    def frame(rows, first):
        return spark.createDataFrame([("g", 1, p, f, first + i, (i * 37 % 101) / 4, (i * 53 % 97) / 4) for i, (p, f) in enumerate(rows)], schema)

    return frame(left, 0), frame(right, 10**6).drop("row_id")


def test_series_hot_only_after_the_join_are_found(spark):
    left, right = _fan_out(spark)
    found = lambda how: {r["nfl_id"] for r in find_hot_joined_groups(left, right, FRAME_KEYS, PLAYER_KEYS, 5000, how).collect()}
    assert found("inner") == {1, 2}
    assert found("left") == {1, 2, 4}
    assert {r["nfl_id"] for r in find_hot_groups(left.where("nfl_id < 4"), PLAYER_KEYS, 5000).collect()} == set()


def test_lags_of_series_hot_only_after_the_join_are_exact(spark):
    left, right = _fan_out(spark)
    merged = join_inputs_outputs(left, right).withColumn("row_id", F.xxhash64("row_id", "x_target", "y_target")).dropDuplicates(["row_id"]).checkpoint()
    hot = find_hot_joined_groups(left, right, FRAME_KEYS, PLAYER_KEYS, 5000)
    _compare(time_lag_features(merged, tiebreak="row_id", hot_keys=hot), brute_force(merged.toPandas()))


def test_single_row_group(spark):
    # Shifts stay null, deltas / dt / velocities are 0
    df = spark.createDataFrame([("g", 1, 7, 3, 0, 1.0, 2.0)], "game_id string, play_id int, nfl_id int, frame_id int, row_id int, x double, y double")
    r = time_lag_features(df, lags=(1,), tiebreak="row_id").first()
    assert r["x_shift_1"] is None and r["frame_shift_1"] is None
    assert (r["dx_lag_1"], r["dy_lag_1"], r["dt_lag_1"], r["vx_lag_1"], r["vy_lag_1"]) == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_duplicate_frame_guard(spark):
    # Equal frames -> dt 0 and velocity 0; dx is the plain difference
    df = spark.createDataFrame(
        [("g", 1, 7, 3, 0, 1.0, 2.0), ("g", 1, 7, 3, 1, 4.0, 2.0)],
        "game_id string, play_id int, nfl_id int, frame_id int, row_id int, x double, y double",
    )
    r = time_lag_features(df, lags=(1,), tiebreak="row_id").where("row_id = 1").first()
    assert (r["dx_lag_1"], r["dt_lag_1"], r["vx_lag_1"]) == (3.0, 0.0, 0.0)


def test_null_keys_get_no_shift(spark):
    # Keys 1, 1, null, null with x = 1..4 -> shift null, 1, null, null
    df = spark.createDataFrame(
        [(1, 0, 1.0), (1, 1, 2.0), (None, 2, 3.0), (None, 3, 4.0)], "nfl_id int, frame_id int, x double"
    ).withColumns({"game_id": F.lit("g"), "play_id": F.lit(1), "y": F.lit(0.0)})
    got = [r["x_shift_1"] for r in time_lag_features(df, lags=(1,)).orderBy("frame_id").collect()]
    assert got == [None, 1.0, None, None]


def test_permutation_invariance(spark):
    pdf, df = _frames(spark, n=1500)
    a = time_lag_features(df, tiebreak="row_id").orderBy("row_id").collect()
    shuffled = spark.createDataFrame(pdf.sample(frac=1.0, random_state=9)).repartition(6)
    b = time_lag_features(shuffled, tiebreak="row_id").orderBy("row_id").collect()
    assert a == b


def test_one_window_one_exchange(spark):
    _, df = _frames(spark, n=100)
    plan = time_lag_features(df, tiebreak="row_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 or plan.count("Window ") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("lags", [(1,), (2,), (1, 2, 3)])
def test_lag_sets(spark, lags):
    pdf, df = _frames(spark, n=800, groups=10)
    _compare(time_lag_features(df, lags=lags, tiebreak="row_id"), brute_force(pdf, lags), lags)
