"""Registered queries: keys and names, joins, aggregations, ordering and
splits, set operations and validation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.functions.keys import play_key, version_name_class, week_from_filename
from frametide.operators import features as feat
from frametide.operators import joins, metrics, sampling, validate
from frametide.operators.blend import blend_weighted
from frametide.operators.sampling import SPLIT_SEED_STEP
from frametide.plans import sqltext as q
from frametide.plans.fixtures import (
    frames_events,
    frames_lineitem,
    labels_events,
    test_events,
    test_input_events,
    with_views,
)
from frametide.plans.registry import r6, register
from frametide.schemas import FRAME_KEYS, PLAY_KEYS

PLAY_KEY_SQL = "game_id || '_' || CAST(play_id AS VARCHAR)"
TRAIN_SQL = (
    "SELECT f.*, l.x AS x_target, l.y AS y_target FROM frames_events AS f JOIN labels_events AS l "
    "USING (game_id, play_id, nfl_id, frame_id)"
)
# Persistence predictions for every test row (null when no input frame).
PERSIST_SQL = (
    "SELECT t.id, t.game_id, t.play_id, i.x, i.y FROM test_events AS t "
    "LEFT JOIN test_input_events AS i USING (game_id, play_id, nfl_id, frame_id)"
)
# Two model outputs and their blend on the training rows.
SCORED_SQL = (
    "SELECT row_id, game_id, play_id, x_target, y_target, x AS a_x, y AS a_y, "
    "x * CAST(0.95 AS DOUBLE) + CAST(1 AS DOUBLE) AS b_x, y * CAST(0.95 AS DOUBLE) + CAST(1 AS DOUBLE) AS b_y, "
    "CAST(0.5 AS DOUBLE) * x + CAST(0.5 AS DOUBLE) * (x * CAST(0.95 AS DOUBLE) + CAST(1 AS DOUBLE)) AS ens_x, "
    "CAST(0.5 AS DOUBLE) * y + CAST(0.5 AS DOUBLE) * (y * CAST(0.95 AS DOUBLE) + CAST(1 AS DOUBLE)) AS ens_y "
    "FROM train"
)


# Integral input columns that are null for test rows without an input frame;
# reported as double (a missing number), as a pandas left merge does.
OUTER_INTS = ["row_id", "week", "num_frames_output", "absolute_yardline_number"]
OUTER_INTS_SQL = "REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in OUTER_INTS) + ")"


def _outer_ints_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in OUTER_INTS if c in df.columns})


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_inputs_outputs(frames_events(spark, sf_dir), labels_events(spark, sf_dir))


def _persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = test_events(spark, sf_dir)
    i = test_input_events(spark, sf_dir)
    return joins.join_test_features(t, i.select(*FRAME_KEYS, "x", "y")).select("id", "game_id", "play_id", "x", "y")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _train(spark, sf_dir)
    models = train.select(
        "row_id", "game_id", "play_id", "x_target", "y_target",
        F.col("x").alias("a_x"), F.col("y").alias("a_y"),
        (F.col("x") * F.lit(0.95) + F.lit(1.0)).alias("b_x"),
        (F.col("y") * F.lit(0.95) + F.lit(1.0)).alias("b_y"),
    )
    return models.withColumns(
        {"ens_x": blend_weighted({"a_x": 0.5, "b_x": 0.5}), "ens_y": blend_weighted({"a_y": 0.5, "b_y": 0.5})}
    )


# ====================================================================== keys
@register(
    "play_key",
    with_views("frames_events") + f"SELECT row_id, {PLAY_KEY_SQL} AS unique_play_id FROM frames_events",
)
def play_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: game and play joined by '_'."""
    return frames_events(spark, sf_dir).select("row_id", play_key().alias("unique_play_id"))


@register(
    "filter_play",
    with_views("frames_events")
    + f"SELECT * FROM frames_events WHERE {PLAY_KEY_SQL} = "
    f"(SELECT {PLAY_KEY_SQL} FROM frames_events ORDER BY row_id LIMIT 1)",
)
def filter_play_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + P11 + P12: rows of one play (the first to appear), selected by
    its key and with the helper key dropped again."""
    frames = frames_events(spark, sf_dir)
    first = frames.orderBy("row_id").select(play_key().alias("k")).first()["k"]
    keyed = joins.play_batches(frames)
    return keyed.where(F.col("unique_play_id") == F.lit(first)).drop("unique_play_id")


_FILE_NAMES_SQL = (
    "SELECT DISTINCT 'input_2023_w' || lpad(CAST(week AS VARCHAR), 2, '0') || '.csv' AS file_name FROM frames_events"
)


@register(
    "week_from_filename",
    with_views("frames_events")
    + f"SELECT file_name, TRY_CAST(regexp_extract(file_name, '_w(\\d+)', 1) AS INTEGER) AS week FROM ({_FILE_NAMES_SQL}) AS n",
)
def week_from_filename_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week number parsed from weekly file names."""
    names = frames_events(spark, sf_dir).select(
        F.concat(F.lit("input_2023_w"), F.lpad(F.col("week").cast("string"), 2, "0"), F.lit(".csv")).alias("file_name")
    ).distinct()
    return names.select("file_name", week_from_filename(F.col("file_name")).alias("week"))


_VERSION_NAMES_SQL = (
    "SELECT event_id AS row_id, CASE WHEN event_type = 'error' THEN 'scratch-' || strftime(ts, '%Y%m%d') "
    "ELSE 'track-model-v' || strftime(ts, '%Y%m%d') || CASE event_type "
    "WHEN 'view' THEN '-' || strftime(ts, '%H%M%S') WHEN 'click' THEN '-' || strftime(ts, '%H%M') "
    "WHEN 'purchase' THEN '-' || strftime(ts, '%H%M%S') || '-extra' ELSE '' END END AS name FROM events"
)


@register(
    "version_name_match",
    f"WITH names AS ({_VERSION_NAMES_SQL}) SELECT row_id, name, CASE WHEN contains(name, 'model-v') THEN "
    "CASE WHEN len(string_split(name, '-')) >= 4 AND regexp_full_match(string_split(name, '-')[4], '[0-9]{6}') "
    "THEN 'new' ELSE 'old' END END AS name_class FROM names",
)
def version_name_match_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact names (one per event, stamped with its time) classified
    as full-timestamp ('new') or older patterns ('old')."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    suffix = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("-"), F.date_format("ts", "HHmmss")))
        .when(F.col("event_type") == "click", F.concat(F.lit("-"), F.date_format("ts", "HHmm")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("-"), F.date_format("ts", "HHmmss"), F.lit("-extra")))
        .otherwise(F.lit(""))
    )
    day = F.date_format("ts", "yyyyMMdd")
    name = F.when(F.col("event_type") == "error", F.concat(F.lit("scratch-"), day)).otherwise(
        F.concat(F.lit("track-model-v"), day, suffix)
    )
    named = e.select(F.col("event_id").alias("row_id"), name.alias("name"))
    return named.withColumn("name_class", version_name_class(F.col("name"), "model-v"))


_ARTIFACTS_SQL = "SELECT event_type, 'track_ensemble_v' || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM events"


@register(
    "latest_version",
    f"WITH a AS ({_ARTIFACTS_SQL}) SELECT event_type, max(name) AS latest FROM a "
    "WHERE regexp_matches(name, '^track_ensemble_v[0-9]{8}_[0-9]{6}$') GROUP BY event_type",
)
def latest_version_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest timestamped artifact name per producer."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    a = e.select("event_type", F.concat(F.lit("track_ensemble_v"), F.date_format("ts", "yyyyMMdd_HHmmss")).alias("name"))
    return sampling.latest_version(a, "name", r"^track_ensemble_v[0-9]{8}_[0-9]{6}$", ["event_type"])


# ===================================================================== joins
@register("join_inputs_outputs", with_views("frames_events", "labels_events") + TRAIN_SQL)
def join_inputs_outputs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P14: inputs inner-join labels on the frame keys, labels suffixed
    ``_target`` (duplicate keys fan out)."""
    return _train(spark, sf_dir)


@register(
    "join_test_features",
    with_views("test_events", "test_input_events")
    + f"SELECT * {OUTER_INTS_SQL} FROM test_events AS t LEFT JOIN test_input_events AS i "
    "USING (game_id, play_id, nfl_id, frame_id)",
)
def join_test_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows left-joined to their input frames (integral input
    columns as double: null where no frame matched)."""
    return _outer_ints_as_double(joins.join_test_features(test_events(spark, sf_dir), test_input_events(spark, sf_dir)))


@register(
    "join_head_sample",
    with_views("test_events", "test_input_events")
    + f"SELECT * {OUTER_INTS_SQL} FROM (SELECT * FROM test_events ORDER BY id LIMIT 50) AS a "
    "LEFT JOIN (SELECT * FROM test_input_events ORDER BY row_id LIMIT 200) AS b "
    "USING (game_id, play_id, nfl_id, frame_id)",
)
def join_head_sample_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + O2: first 50 test rows left-joined with the first 200 input rows."""
    return _outer_ints_as_double(
        joins.join_head_sample(test_events(spark, sf_dir), test_input_events(spark, sf_dir), ["id"], ["row_id"], 50, 200)
    )


@register(
    "semi_join_plays",
    with_views("test_events", "test_input_events", "frames_events")
    + "SELECT * FROM frames_events AS f WHERE EXISTS (SELECT 1 FROM test_events AS t WHERE t.game_id = f.game_id "
    "AND t.play_id = f.play_id AND NOT EXISTS (SELECT 1 FROM test_input_events AS i WHERE i.game_id = t.game_id "
    "AND i.play_id = t.play_id AND i.nfl_id = t.nfl_id AND i.frame_id = t.frame_id))",
)
def semi_join_plays_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 (+ J7): frames of the plays that have at least one test row
    without an input frame."""
    gaps = joins.unmatched_keys(test_events(spark, sf_dir), test_input_events(spark, sf_dir))
    return joins.semi_join_plays(frames_events(spark, sf_dir), gaps, PLAY_KEYS)


@register(
    "attach_row_ids",
    with_views("test_events", "test_input_events")
    + f"SELECT t.id, p.x, p.y FROM test_events AS t LEFT JOIN (SELECT id, x, y FROM ({PERSIST_SQL}) AS pp "
    "WHERE x IS NOT NULL) AS p USING (id)",
)
def attach_row_ids_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + P15: predictions (only where an input frame exists) keyed back to
    every expected id, id first."""
    preds = _persist(spark, sf_dir).where(F.col("x").isNotNull()).select("id", "x", "y")
    return joins.attach_row_ids(preds, test_events(spark, sf_dir))


@register(
    "persistence_baseline",
    with_views("test_events", "test_input_events") + f"SELECT id, x, y FROM ({PERSIST_SQL}) AS p",
)
def persistence_baseline_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the position in the matching input frame."""
    return joins.persistence_baseline(test_events(spark, sf_dir), test_input_events(spark, sf_dir))


@register(
    "unmatched_keys",
    with_views("test_events", "test_input_events")
    + "SELECT * FROM test_events AS t WHERE NOT EXISTS (SELECT 1 FROM test_input_events AS i WHERE "
    "i.game_id = t.game_id AND i.play_id = t.play_id AND i.nfl_id = t.nfl_id AND i.frame_id = t.frame_id)",
)
def unmatched_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with no input frame."""
    return joins.unmatched_keys(test_events(spark, sf_dir), test_input_events(spark, sf_dir))


# ============================================================== aggregations
@register(
    "row_counts",
    with_views("frames_events", "labels_events")
    + f", train AS ({TRAIN_SQL}) SELECT 'inputs' AS \"table\", count(*) AS n_rows FROM frames_events "
    "UNION ALL SELECT 'outputs', count(*) FROM labels_events UNION ALL SELECT 'merged', count(*) FROM train",
)
def row_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: input, label and merged row counts."""
    return metrics.row_counts(
        {"inputs": frames_events(spark, sf_dir), "outputs": labels_events(spark, sf_dir), "merged": _train(spark, sf_dir)}
    )


@register(
    "rmse_xy",
    with_views("frames_events", "labels_events")
    + f", train AS ({TRAIN_SQL}), m AS (SELECT {q.mse('x', 'x_target')} AS mx, {q.mse('y', 'y_target')} AS my FROM train) "
    f"SELECT {q.r6('sqrt(mx)')} AS rmse_x, {q.r6('sqrt(my)')} AS rmse_y, "
    f"{q.r6('sqrt((mx + my) / 2)')} AS combined_rmse FROM m",
)
def rmse_xy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + A3: RMSE of the persistence prediction against the labels."""
    out = metrics.rmse_xy(_train(spark, sf_dir), "x", "y", "x_target", "y_target")
    return out.select(*[r6(c).alias(c) for c in out.columns])


_BY_MODEL_SQL_COLS = ", ".join(
    f"{q.r6(f'sqrt({q.mse(f'{m}_{a}', f'{a}_target')})')} AS {n}_rmse_{a}"
    for m, n in (("a", "a"), ("b", "b"), ("ens", "ensemble"))
    for a in ("x", "y")
)


@register(
    "rmse_by_model",
    with_views("frames_events", "labels_events")
    + f", train AS ({TRAIN_SQL}), scored AS ({SCORED_SQL}) SELECT {_BY_MODEL_SQL_COLS}, "
    f"{q.r6('sqrt(((' + q.mse('ens_x', 'x_target') + ') + (' + q.mse('ens_y', 'y_target') + ')) / 2)')} "
    "AS combined_rmse FROM scored",
)
def rmse_by_model_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + M4: per-model and blended RMSE per axis plus combined (7 metrics)."""
    scored = _scored(spark, sf_dir)
    out = metrics.rmse_by_model(
        scored, {"a": ("a_x", "a_y"), "b": ("b_x", "b_y"), "ensemble": ("ens_x", "ens_y")}, "x_target", "y_target", "ensemble"
    )
    return out.select(*[r6(c).alias(c) for c in out.columns])


@register(
    "prediction_summary",
    with_views("frames_events", "labels_events")
    + f", train AS ({TRAIN_SQL}), scored AS ({SCORED_SQL}) SELECT min(ens_x) AS ens_x_min, max(ens_x) AS ens_x_max, "
    f"{q.r6('avg(ens_x)')} AS ens_x_mean, min(ens_y) AS ens_y_min, max(ens_y) AS ens_y_max, "
    f"{q.r6('avg(ens_y)')} AS ens_y_mean FROM scored",
)
def prediction_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: min, max, mean of the blended predictions."""
    out = metrics.prediction_summary(_scored(spark, sf_dir), ["ens_x", "ens_y"])
    return out.select(*[r6(c).alias(c) if c.endswith("_mean") else F.col(c) for c in out.columns])


@register(
    "finite_check",
    with_views("test_events", "test_input_events")
    + f", p AS ({PERSIST_SQL}) SELECT coalesce(bool_or(x IS NULL OR isnan(x)), false) AS x_any_nan, "
    "coalesce(bool_and(coalesce(isfinite(x), false)), true) AS x_all_finite, "
    "coalesce(bool_or(y IS NULL OR isnan(y)), false) AS y_any_nan, "
    "coalesce(bool_and(coalesce(isfinite(y), false)), true) AS y_all_finite FROM p",
)
def finite_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and finiteness flags of the persistence predictions (rows
    without an input frame have null predictions, which count as NaN)."""
    return metrics.finite_check(_persist(spark, sf_dir), ["x", "y"])


@register(
    "distinct_positions",
    with_views("frames_events")
    + "SELECT player_position, first_order, CAST(row_number() OVER (ORDER BY first_order, player_position) - 1 AS INTEGER) "
    "AS ordinal FROM (SELECT player_position, min(row_id) AS first_order FROM frames_events "
    "WHERE player_position IS NOT NULL GROUP BY player_position) AS d",
)
def distinct_positions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in first-appearance order."""
    return metrics.distinct_in_order(frames_events(spark, sf_dir), "player_position", "row_id")


@register(
    "distinct_plays",
    with_views("frames_events")
    + "SELECT unique_play_id, first_order, CAST(row_number() OVER (ORDER BY first_order, unique_play_id) - 1 AS INTEGER) "
    f"AS batch_index FROM (SELECT {PLAY_KEY_SQL} AS unique_play_id, min(row_id) AS first_order FROM frames_events "
    "GROUP BY 1) AS d",
)
def distinct_plays_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play keys in first-appearance order (the batch order)."""
    return metrics.distinct_plays(frames_events(spark, sf_dir), "row_id")


_RAW_FEATURES = ["x", "y", "s", "a", "dir"]
_RAW_NOT_MISSING = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _RAW_FEATURES)


@register(
    "clean_features",
    with_views("test_events", "test_input_events")
    + "SELECT * FROM (SELECT * FROM test_events AS t LEFT JOIN test_input_events AS i "
    f"USING (game_id, play_id, nfl_id, frame_id)) AS j WHERE {_RAW_NOT_MISSING}",
)
def clean_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows whose (uncoerced) input features are all present."""
    joined = joins.join_test_features(test_events(spark, sf_dir), test_input_events(spark, sf_dir))
    return feat.clean_features(joined, _RAW_FEATURES)


@register(
    "rows_removed",
    with_views("test_events", "test_input_events")
    + "SELECT count(*) AS rows_before, count_if(" + _RAW_NOT_MISSING + ") AS rows_after, "
    f"count(*) - count_if({_RAW_NOT_MISSING}) AS rows_removed FROM test_events AS t "
    "LEFT JOIN test_input_events AS i USING (game_id, play_id, nfl_id, frame_id)",
)
def rows_removed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before/after cleaning, one pass."""
    joined = joins.join_test_features(test_events(spark, sf_dir), test_input_events(spark, sf_dir))
    return metrics.rows_removed(joined, _RAW_FEATURES)


@register(
    "batch_row_counts",
    with_views("test_events", "test_input_events")
    + f", p AS ({PERSIST_SQL}), e AS (SELECT {PLAY_KEY_SQL} AS unique_play_id, count(*) AS n_expected "
    f"FROM test_events GROUP BY 1), r AS (SELECT {PLAY_KEY_SQL} AS unique_play_id, count(*) AS n_received "
    "FROM p WHERE x IS NOT NULL GROUP BY 1) SELECT coalesce(e.unique_play_id, r.unique_play_id) AS unique_play_id, "
    "coalesce(n_expected, 0) AS n_expected, coalesce(n_received, 0) AS n_received FROM e FULL JOIN r "
    "ON e.unique_play_id = r.unique_play_id",
)
def batch_row_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: expected vs received prediction rows per play."""
    expected = joins.play_batches(test_events(spark, sf_dir))
    received = joins.play_batches(_persist(spark, sf_dir).where(F.col("x").isNotNull()))
    return metrics.batch_row_counts(expected, received)


# ====================================================== ordering and splits
@register(
    "sort_frames",
    with_views("frames_events") + "SELECT * FROM frames_events ORDER BY game_id, play_id, nfl_id, frame_id, row_id",
)
def sort_frames_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: frames in series order."""
    return sampling.sort_frames(frames_events(spark, sf_dir), ["game_id", "play_id", "nfl_id"], "frame_id", ["row_id"])


@register(
    "head_n",
    with_views("frames_events")
    + "SELECT * FROM frames_events ORDER BY game_id, play_id, nfl_id, frame_id, row_id LIMIT 200",
)
def head_n_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the first 200 frames in series order (the limit is the operator)."""
    return sampling.head_n(frames_events(spark, sf_dir), 200, ["game_id", "play_id", "nfl_id", "frame_id", "row_id"])


_LI_KEYS = ["game_id", "play_id", "nfl_id", "frame_id", "row_id"]


@register(
    "sample_exact_n",
    with_views("frames_lineitem")
    + f"SELECT * FROM frames_lineitem ORDER BY {q.md5_key_sql(_LI_KEYS, 42)}, {', '.join(_LI_KEYS)} LIMIT 5000",
)
def sample_exact_n_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: exactly 5000 rows without replacement, seed 42 (the sample size is
    the operator's parameter)."""
    return sampling.sample_exact_n(frames_lineitem(spark, sf_dir), 5000, _LI_KEYS, seed=42)


_SAMPLE_ROWS, _SPLIT_SEED = 20_000, 42 + SPLIT_SEED_STEP


@register(
    "sample_then_split",
    with_views("frames_lineitem")
    + f"SELECT {', '.join(_LI_KEYS)}, substr({q.md5_key_sql(_LI_KEYS, _SPLIT_SEED)}, 1, 4) < '2666' AS is_val FROM "
    f"(SELECT * FROM frames_lineitem ORDER BY {q.md5_key_sql(_LI_KEYS, 42)}, {', '.join(_LI_KEYS)} LIMIT {_SAMPLE_ROWS}) AS s",
)
def sample_then_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 then O4 as the training job runs them: an exact sample, split by a
    hash of its own, so the share doesn't depend on the sample's."""
    rows = sampling.sample_exact_n(frames_lineitem(spark, sf_dir), _SAMPLE_ROWS, _LI_KEYS, seed=42)
    return sampling.train_val_split(rows, _LI_KEYS, 0.15, _SPLIT_SEED).select(*_LI_KEYS, "is_val")


@register(
    "train_val_split",
    with_views("frames_lineitem")
    + f"SELECT {', '.join(_LI_KEYS)}, substr({q.md5_key_sql(_LI_KEYS)}, 1, 4) < '2666' AS is_val FROM frames_lineitem",
)
def train_val_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 % validation flag by key hash."""
    return sampling.train_val_split(frames_lineitem(spark, sf_dir), _LI_KEYS, 0.15).select(*_LI_KEYS, "is_val")


@register(
    "group_split",
    with_views("frames_events")
    + f"SELECT row_id, game_id, play_id, substr({q.md5_key_sql(['game_id', 'play_id'])}, 1, 4) < '2666' AS is_val "
    "FROM frames_events",
)
def group_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole plays go to one side of the split."""
    return sampling.group_split(frames_events(spark, sf_dir)).select("row_id", "game_id", "play_id", "is_val")


@register(
    "temporal_split",
    with_views("frames_events") + "SELECT row_id, week, week > 3 AS is_val FROM frames_events",
)
def temporal_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks 1-3 train, later weeks validate."""
    return sampling.temporal_split(frames_events(spark, sf_dir), 3).select("row_id", "week", "is_val")


# ========================================================== set operations
@register(
    "concat_batches",
    with_views("test_events", "test_input_events")
    + f", p AS ({PERSIST_SQL}) SELECT id, CAST(CAST(floor(x) AS BIGINT) AS DOUBLE) AS x, y FROM p "
    "WHERE x IS NOT NULL AND game_id = 'g0' UNION ALL SELECT id, x, y FROM p WHERE x IS NOT NULL AND game_id <> 'g0'",
)
def concat_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-game prediction batches, the first game's x integral, unioned
    (the integral batch widens to double)."""
    p = _persist(spark, sf_dir).where(F.col("x").isNotNull())
    ints = p.where(F.col("game_id") == "g0").select("id", F.floor("x").cast("long").alias("x"), "y")
    floats = p.where(F.col("game_id") != "g0").select("id", "x", "y")
    return validate.concat_batches([ints, floats])


_WEEKS_SQL = (
    "SELECT coalesce(a.week, b.week) AS week, a.week IS NOT NULL AS in_inputs, b.week IS NOT NULL AS in_outputs "
    "FROM (SELECT DISTINCT week FROM frames_events) AS a FULL JOIN "
    "(SELECT DISTINCT CAST(substr(game_id, 2) AS INTEGER) + 1 AS week FROM labels_events) AS b ON a.week = b.week"
)


def _week_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_weeks = labels_events(spark, sf_dir).select(
        (F.substring("game_id", 2, 10).cast("int") + 1).alias("week")
    )
    return validate.week_pairing(frames_events(spark, sf_dir), out_weeks)


@register("week_pairing", with_views("frames_events", "labels_events") + _WEEKS_SQL)
def week_pairing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks present in the inputs vs the labels."""
    return _week_pairing(spark, sf_dir)


@register(
    "check_split_files",
    with_views("frames_events", "labels_events")
    + f", w AS ({_WEEKS_SQL}) SELECT count_if(in_inputs) AS n_input_weeks, count_if(in_outputs) AS n_output_weeks, "
    "count_if(in_inputs <> in_outputs) AS n_unpaired, count_if(in_inputs) > 0 AND count_if(in_outputs) > 0 "
    "AND count_if(in_inputs <> in_outputs) = 0 AS ok FROM w",
)
def check_split_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input and label weeks exist and pair up."""
    return validate.split_files_report(_week_pairing(spark, sf_dir))


# ================================================================ validation
_ALIGN_SQL = (
    f", p AS ({PERSIST_SQL}), preds AS (SELECT id, count(*) AS n_pred FROM p WHERE x IS NOT NULL GROUP BY id), "
    f"e AS (SELECT id, {PLAY_KEY_SQL} AS unique_play_id FROM test_events), "
    "j AS (SELECT e.unique_play_id, e.id IS NOT NULL AS is_exp, coalesce(preds.n_pred, 0) AS n_pred "
    "FROM e FULL JOIN preds ON e.id = preds.id), "
    "r AS (SELECT unique_play_id, count_if(is_exp) AS n_expected, CAST(sum(n_pred) AS BIGINT) AS n_received, "
    "count_if(is_exp AND n_pred = 0) AS n_missing, "
    "CAST(coalesce(sum(CASE WHEN is_exp AND n_pred > 1 THEN n_pred - 1 END), 0) AS BIGINT) AS n_duplicate, "
    "CAST(coalesce(sum(CASE WHEN NOT is_exp THEN n_pred END), 0) AS BIGINT) AS n_extra FROM j GROUP BY unique_play_id), "
    "ra AS (SELECT *, n_missing = 0 AND n_duplicate = 0 AND n_extra = 0 AS aligned FROM r) "
)


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = joins.play_batches(test_events(spark, sf_dir))
    preds = _persist(spark, sf_dir).where(F.col("x").isNotNull()).select("id", "x", "y")
    return validate.row_alignment(expected, preds, "unique_play_id")


@register("check_row_alignment", with_views("test_events", "test_input_events") + _ALIGN_SQL + "SELECT * FROM ra")
def check_row_alignment_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: per play, expected ids vs predictions delivered for them."""
    return _alignment(spark, sf_dir)


@register(
    "classify_failure",
    with_views("test_events", "test_input_events")
    + _ALIGN_SQL
    + "SELECT *, CASE WHEN n_expected = 0 THEN 5 WHEN NOT aligned THEN 6 END AS error_type, "
    "CASE WHEN n_expected = 0 THEN 'GATEWAY_RAISED_EXCEPTION' WHEN NOT aligned THEN 'INVALID_SUBMISSION' END "
    "AS error_name FROM ra",
)
def classify_failure_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error code and name per play from the alignment report."""
    return validate.classify_failure(_alignment(spark, sf_dir))


def _report_sql(src: str, col: str, lo: float, hi: float) -> str:
    finite = f"{col} IS NOT NULL AND NOT isnan({col}) AND abs({col}) <> CAST('inf' AS DOUBLE)"
    return (
        f"count_if({col} IS NULL) AS {col}_null, count_if(isnan({col})) AS {col}_nan, "
        f"count_if(abs({col}) = CAST('inf' AS DOUBLE)) AS {col}_inf, "
        f"count_if({finite} AND NOT ({col} >= {lo} AND {col} <= {hi})) AS {col}_out_of_bounds"
    )


@register(
    "check_predictions",
    with_views("frames_events", "labels_events")
    + f", train AS ({TRAIN_SQL}), scored AS ({SCORED_SQL}), p AS (SELECT ens_x AS x, ens_y AS y FROM scored) "
    f"SELECT count(*) AS n_rows, {_report_sql('p', 'x', -10.0, 130.0)}, {_report_sql('p', 'y', -10.0, 100.0)} FROM p",
)
def check_predictions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 + V6 + V7: null, NaN, infinite and out-of-field counts of blended
    predictions."""
    p = _scored(spark, sf_dir).select(F.col("ens_x").alias("x"), F.col("ens_y").alias("y"))
    return validate.prediction_report(p)


@register(
    "check_submission",
    with_views("test_events", "test_input_events")
    + f", p AS ({PERSIST_SQL}), sub AS (SELECT id, x, y, true AS s FROM p), "
    "j AS (SELECT t.id AS eid, sub.* FROM (SELECT id FROM test_events) AS t FULL JOIN sub ON t.id = sub.id) "
    "SELECT count_if(eid IS NOT NULL) AS n_expected, count_if(s IS NOT NULL) AS n_rows, "
    "count_if(s IS NULL) AS n_missing, count_if(eid IS NULL) AS n_unexpected, "
    "count_if(s IS NOT NULL AND (x IS NULL OR isnan(x) OR abs(x) = CAST('inf' AS DOUBLE) OR y IS NULL OR isnan(y) "
    "OR abs(y) = CAST('inf' AS DOUBLE))) AS n_not_finite, "
    "count_if(eid IS NOT NULL) = count_if(s IS NOT NULL) AND count_if(s IS NULL) = 0 AND count_if(eid IS NULL) = 0 "
    "AND count_if(s IS NOT NULL AND (x IS NULL OR isnan(x) OR abs(x) = CAST('inf' AS DOUBLE) OR y IS NULL OR isnan(y) "
    "OR abs(y) = CAST('inf' AS DOUBLE))) = 0 AS valid FROM j",
)
def check_submission_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: the persistence submission checked against all test ids (rows
    without an input frame carry null predictions and are reported)."""
    sub = _persist(spark, sf_dir).select("id", "x", "y")
    return validate.submission_report(sub, test_events(spark, sf_dir))


@register(
    "custom_checks",
    with_views("test_events", "test_input_events")
    + f", p AS ({PERSIST_SQL}) SELECT count_if(NOT coalesce(x >= 0 AND x <= 120, false)) AS x_in_field, "
    "count_if(NOT coalesce(y >= 0 AND y <= 53.3, false)) AS y_in_field, "
    "count_if(NOT coalesce(x IS NOT NULL, false)) AS has_prediction FROM p",
)
def custom_checks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user-supplied row predicates, failures counted in one pass."""
    p = _persist(spark, sf_dir)
    return validate.apply_checks(
        p,
        [
            ("x_in_field", F.col("x").between(0, 120)),
            ("y_in_field", F.col("y").between(0, 53.3)),
            ("has_prediction", F.col("x").isNotNull()),
        ],
    )


@register(
    "check_columns",
    with_views("test_events", "test_input_events") + f"SELECT x, y FROM ({PERSIST_SQL}) AS p",
)
def check_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 + V4 + U4: prediction columns checked at plan time (exactly x and
    y, numeric, no id) and returned in the expected order."""
    preds = _persist(spark, sf_dir).select("y", "x")
    checked = validate.check_columns(preds)
    validate.check_numeric(checked)
    return checked
