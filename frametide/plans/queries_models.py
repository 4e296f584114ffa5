"""Registered queries: model fitting, scoring, streaming and custom
predictors (M1-M9, T1-T3, F1).

SQL cannot fit trees, so the fits return what it can state about them: the
row counts over all training rows and whether the fitted models are finite
and beat the mean. Scores are compared likewise, id by id. The registered fits
use 20 boosting rounds / trees so the whole check stays fast; the training job
itself defaults to the full settings (400 / 500 rounds).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.operators import models as M
from frametide.operators.metrics import is_finite
from frametide.operators.sampling import VALIDATION_FRACTION
from frametide.operators.udf import custom_predict, row_local_predict
from frametide.operators.validate import metadata_report
from frametide.plans import score as S
from frametide.plans.fixtures import frames_events, labels_events, test_events, test_input_events, with_views
from frametide.plans.registry import register
from frametide.plans.train import train
from frametide.schemas import FRAME_KEYS
from frametide.session import staging_path
from frametide.sources.layout import PlayStore
from frametide.streaming.play_stream import play_batches, score_stream, write_play_files

CHECK_ITERATIONS = 20


# Training rows: nothing is missing once features are coerced to numbers.
_TRAIN_SQL = (
    with_views("frames_events", "labels_events")
    + ", train AS (SELECT f.player_position, f.row_id FROM frames_events AS f "
    "JOIN labels_events AS l USING (game_id, play_id, nfl_id, frame_id))\n"
)
_FIT_SQL = _TRAIN_SQL + (
    f"SELECT count(*) AS n_clean, least(count(*), {M.MAX_TRAIN_ROWS}) AS n_sampled, "
    "true AS val_share_near, true AS all_finite, true AS beats_mean FROM train"
)


def _fit_report(spark: SparkSession, sf_dir: str, result) -> DataFrame:
    """One row on a fit: counts, the validation share within 3 points of its
    setting, finite predictions, and a lower error than the labels' mean has."""
    spread = labels_events(spark, sf_dir).agg(((F.var_pop("x") + F.var_pop("y")) / 2).alias("v")).first()["v"]
    m, c = result.metrics, result.counts
    row = {
        "n_clean": c["n_clean"],
        "n_sampled": c["n_sampled"],
        "val_share_near": abs(c["n_val"] / c["n_sampled"] - VALIDATION_FRACTION) < 0.03,
        "all_finite": bool(m["x_all_finite"] and m["y_all_finite"]),
        "beats_mean": m["combined_rmse"] ** 2 < spread,
    }
    return spark.createDataFrame([row], "n_clean bigint, n_sampled bigint, val_share_near boolean, all_finite boolean, beats_mean boolean")


def _finite_flags(scored: DataFrame) -> DataFrame:
    """id and whether x and y are numbers."""
    return scored.select("id", *[F.coalesce(is_finite(F.col(c)), F.lit(False)).alias(f"{c}_finite") for c in ("x", "y")])


def _fit(spark: SparkSession, sf_dir: str, families, weights, output_root=None):
    return train(
        spark,
        frames_events(spark, sf_dir),
        labels_events(spark, sf_dir),
        families=families,
        weights=weights,
        order_col="row_id",
        max_iter=CHECK_ITERATIONS,
        output_root=output_root,
    )


@register("fit_xy_gbt", _FIT_SQL)
def fit_xy_gbt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M5 (+ J1, W5, P9, P13, O3, O4): one boosted regressor per axis,
    evaluated on the held-out rows; one report row."""
    result = _fit(spark, sf_dir, {"gbt": M.SINGLE_PARAMS}, {"gbt": 1.0})
    return _fit_report(spark, sf_dir, result)


_ENSEMBLES: dict[tuple[str, str], object] = {}


def _ensemble(spark: SparkSession, sf_dir: str):
    """The ensemble trained on ``sf_dir`` and saved, once per Spark
    application; the ensemble, pipeline and scoring queries share it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ENSEMBLES:
        _ENSEMBLES[key] = _fit(spark, sf_dir, M.ENSEMBLE_PARAMS, M.DEFAULT_WEIGHTS, output_root=staging_path(spark, "models"))
    return _ENSEMBLES[key]


@register("fit_xy_ensemble", _FIT_SQL)
def fit_xy_ensemble_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M4 + M5: boosted and forest families per axis, blended 0.5/0.5; one
    report row on the blend."""
    return _fit_report(spark, sf_dir, _ensemble(spark, sf_dir))


@register(
    "train_pipeline",
    _TRAIN_SQL
    + "SELECT 12 AS n_features, 'a,b' AS families, CAST(0.5 AS DOUBLE) AS weight_a, CAST(0.5 AS DOUBLE) AS weight_b, "
    "string_agg(player_position, ',' ORDER BY first_row, player_position) AS positions "
    "FROM (SELECT player_position, min(row_id) AS first_row FROM train WHERE player_position IS NOT NULL GROUP BY 1) AS p",
)
def train_pipeline_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M6 + S11: the whole training job, saved as a versioned bundle;
    returns what the stored metadata record says of features, families,
    weights and the position vocabulary (in order of first appearance)."""
    meta = spark.read.json(f"{_ensemble(spark, sf_dir).path}/metadata")
    return meta.select(
        F.size("feature_columns").alias("n_features"),
        F.concat_ws(",", "families").alias("families"),
        F.col("ensemble_weights.a").alias("weight_a"),
        F.col("ensemble_weights.b").alias("weight_b"),
        F.concat_ws(",", "player_position_values").alias("positions"),
    )


def _saved_model_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of the saved ensemble (see :func:`_ensemble`)."""
    return _ensemble(spark, sf_dir).path


def _saved_bundle(spark: SparkSession, sf_dir: str) -> M.ModelBundle:
    return M.load_bundle(spark, _saved_model_path(spark, sf_dir))


@register(
    "score_test",
    with_views("test_events") + "SELECT id, true AS x_finite, true AS y_finite FROM test_events",
)
def score_test_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M7 + M3 + M4: a saved ensemble loaded once and applied to every
    test row; per id whether x and y are finite."""
    bundle = _saved_bundle(spark, sf_dir)
    return _finite_flags(S.score_test(test_events(spark, sf_dir), test_input_events(spark, sf_dir), bundle))


@register(
    "score_stream",
    with_views("test_events") + "SELECT id, true AS x_finite, true AS y_finite, true AS as_batch FROM test_events",
)
def score_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test files (whole plays per file) streamed with availableNow,
    each micro-batch scored against the stored frames of its plays, validated and appended; per id of the sink whether x and y are finite
    and equal to the batch score."""
    bundle = _saved_bundle(spark, sf_dir)
    test = test_events(spark, sf_dir)
    root = staging_path(spark, "stream")
    write_play_files(test, f"{root}/source", files_per_batch=8)
    store = PlayStore(f"{root}/inputs", buckets=32).write(test_input_events(spark, sf_dir))
    score_stream(
        spark, f"{root}/source", test.schema, store, bundle,
        f"{root}/sink", f"{root}/checkpoint", max_files_per_trigger=2,
    )
    sink = spark.read.parquet(f"{root}/sink")
    batch = S.score_test(test, test_input_events(spark, sf_dir), bundle).select("id", F.col("x").alias("bx"), F.col("y").alias("by"))
    same = sink.join(batch, "id", "left").select("id", (F.col("x").eqNullSafe(F.col("bx")) & F.col("y").eqNullSafe(F.col("by"))).alias("as_batch"))
    return _finite_flags(sink).join(same, "id")


@register(
    "score_request",
    with_views("frames_events") + "SELECT CAST(row_id AS VARCHAR) AS id, true AS x_finite, true AS y_finite FROM frames_events",
)
def score_request_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + S7 + M7: request rows (JSON lines, with ids) scored with a model
    loaded by path; per id whether x and y are finite."""
    path = staging_path(spark, "requests")
    frames_events(spark, sf_dir).withColumn("id", F.col("row_id").cast("string")).write.mode("overwrite").json(path)
    return _finite_flags(S.score_request(spark, path, _saved_model_path(spark, sf_dir)))


@register(
    "play_batches",
    with_views("test_events")
    + "SELECT t.*, t.game_id || '_' || CAST(t.play_id AS VARCHAR) AS unique_play_id, o.batch_index FROM test_events AS t "
    "JOIN (SELECT k, CAST(row_number() OVER (ORDER BY first_order, k) - 1 AS INTEGER) AS batch_index FROM "
    "(SELECT game_id || '_' || CAST(play_id AS VARCHAR) AS k, min(id) AS first_order FROM test_events GROUP BY 1) AS d) AS o "
    "ON t.game_id || '_' || CAST(t.play_id AS VARCHAR) = o.k",
)
def play_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row tagged with its play batch and the batch order."""
    return play_batches(test_events(spark, sf_dir), "id")


def persistence_per_play(test_rows: pd.DataFrame, input_rows: pd.DataFrame) -> pd.DataFrame:
    """Example per-play predictor: each player stays where the matching
    input frame has them (NaN when there is none)."""
    keys = [k for k in FRAME_KEYS if k in test_rows.columns and k in input_rows.columns]
    merged = test_rows.merge(input_rows[keys + ["x", "y"]], on=keys, how="left")
    return merged[["x", "y"]]


@register(
    "custom_predict",
    with_views("test_events", "test_input_events")
    + "SELECT t.id, i.x, i.y FROM test_events AS t LEFT JOIN test_input_events AS i USING (game_id, play_id, nfl_id, frame_id)",
)
def custom_predict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a user predictor called once per play on (test rows, input
    frames) through cogrouped Arrow batches."""
    return custom_predict(test_events(spark, sf_dir), test_input_events(spark, sf_dir), persistence_per_play, allow_missing=True)


@register(
    "check_metadata",
    _TRAIN_SQL
    + "SELECT 12 AS n_features, CAST(count(DISTINCT player_position) AS INTEGER) AS n_positions, true AS required_keys, "
    "true AS features_unique, true AS enough_features, true AS weights_positive, true AS weights_sum_to_one FROM train",
)
def check_metadata_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: the stored metadata of a trained bundle checked by Spark
    predicates (required keys, unique features, enough features, positive
    weights summing to one)."""
    meta = spark.read.json(f"{_saved_model_path(spark, sf_dir)}/metadata")
    names = meta.select("ensemble_weights.*").columns
    weights = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"ensemble_weights.{n}") for n in names]))
    report = metadata_report(meta.withColumn("weights", weights))
    flags = ["required_keys", "features_unique", "enough_features", "weights_positive", "weights_sum_to_one"]
    sizes = [F.size("feature_columns").alias("n_features"), F.size("player_position_values").alias("n_positions")]
    return report.select(*sizes, *flags)


def shifted_frame(rows: pd.DataFrame) -> pd.DataFrame:
    """Example row-local predictor: half a yard along each axis."""
    return pd.DataFrame({"x": rows["x"] + 0.5, "y": rows["y"] + 0.5})


@register(
    "row_local_predict",
    with_views("test_input_events")
    + "SELECT CAST(row_id AS VARCHAR) AS id, x + CAST(0.5 AS DOUBLE) AS x, y + CAST(0.5 AS DOUBLE) AS y FROM test_input_events",
)
def row_local_predict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 without play context: a user predictor over Arrow batches."""
    rows = test_input_events(spark, sf_dir).selectExpr("cast(row_id as string) as id", "x", "y")
    return row_local_predict(rows, shifted_frame, allow_missing=True)
