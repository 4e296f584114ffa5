"""Randomised parity with the pandas semantics the pipeline is defined by:
merge on frame keys (null keys match), categorical codes, factorize."""

import numpy as np
import pandas as pd

from frametide.functions.encoders import category_code_first_seen, category_code_sorted
from frametide.operators.joins import join_inputs_outputs
from frametide.schemas import FRAME_KEYS


def _rows(df):
    return sorted(tuple("<null>" if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in df)


def test_inner_merge_with_null_keys_matches_pandas(spark):
    n = 400

    def frame(seed_shift):
        r = np.random.default_rng(11 + seed_shift)
        pdf = pd.DataFrame(
            {
                "game_id": r.choice(["g1", "g2", None], n),
                "play_id": r.integers(0, 3, n).astype("int64"),
                "nfl_id": r.integers(0, 4, n).astype("int64"),
                "frame_id": r.integers(0, 5, n).astype("int64"),
                "x": r.normal(size=n).round(3),
                "y": r.normal(size=n).round(3),
            }
        )
        return pdf

    left, right = frame(0), frame(1)
    exp = left.merge(right, on=FRAME_KEYS, how="inner", suffixes=(None, "_target"))
    schema = "game_id string, play_id long, nfl_id long, frame_id long, x double, y double"
    got = join_inputs_outputs(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), null_safe=True)
    cols = list(exp.columns)
    assert sorted(got.columns) == sorted(cols)
    assert _rows(got.select(*cols).collect()) == _rows(exp.itertuples(index=False))


def test_codes_match_pandas(spark):
    r = np.random.default_rng(5)
    values = r.choice(["WR", "CB", "TE", "SS", "QB", None, "FS", "Zz", "aa"], 500)
    pdf = pd.DataFrame({"row_id": np.arange(500, dtype="int64"), "player_position": values})
    df = spark.createDataFrame(pdf, "row_id long, player_position string")
    sorted_codes = [r["player_pos_code"] for r in category_code_sorted(df).orderBy("row_id").collect()]
    assert sorted_codes == list(pd.Categorical(pdf["player_position"]).codes)
    first_seen = [r["player_pos_code"] for r in category_code_first_seen(df, order_col="row_id").orderBy("row_id").collect()]
    assert first_seen == list(pd.factorize(pdf["player_position"])[0])
