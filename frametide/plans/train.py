"""Training job (M8): scan -> join -> features -> clean -> sample -> split ->
fit -> evaluate -> save, as one Spark application."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.functions.encoders import category_code_vocab
from frametide.operators import models as M
from frametide.operators.features import clean_features, prepare_features, select_features
from frametide.operators.lags import find_hot_joined_groups, lag_column_names, time_lag_features
from frametide.operators.joins import join_inputs_outputs
from frametide.operators.sampling import (
    PREFIX_DIGITS,
    SPLIT_SEED_STEP,
    VALIDATION_FRACTION,
    key_hash,
    sample_from_histogram,
    train_val_split,
)
from frametide.schemas import FEATURE_COLUMNS, FRAME_KEYS, PLAYER_KEYS


@dataclass
class TrainResult:
    bundle: M.ModelBundle
    metrics: dict
    counts: dict
    path: str | None


CODE_COLUMN = "player_pos_code"
POSITION_COLUMN = "player_position"
# Player series larger than this are lagged on the split path (see lags.py).
HOT_GROUP_ROWS = 2_000_000


def uses_lag_features(feature_columns: Sequence[str]) -> bool:
    names = {n for lag in range(1, 64) for n in lag_column_names(lag)}
    return any(c in names for c in feature_columns)


def lag_stage(
    merged: DataFrame,
    left: DataFrame,
    right: DataFrame,
    tiebreak: Sequence[str],
    hot_group_rows: int | None = HOT_GROUP_ROWS,
    keys: Sequence[str] = FRAME_KEYS,
    how: str = "inner",
) -> DataFrame:
    """W5 over the joined rows of ``left`` and ``right``. Player series that
    are hot after the join's fan-out are found from key counts of both sides
    (key-only scans, not a second run of the join) and lagged on the split path."""
    hot = find_hot_joined_groups(left, right, keys, PLAYER_KEYS, hot_group_rows, how) if hot_group_rows else None
    return time_lag_features(merged, tiebreak=list(tiebreak), hot_keys=hot)


def build_training_rows(
    inputs: DataFrame,
    outputs: DataFrame,
    vocabulary: Sequence[str] | None,
    tiebreak: Sequence[str] = (),
    feature_columns: Sequence[str] = FEATURE_COLUMNS,
    hot_group_rows: int | None = HOT_GROUP_ROWS,
    encode: bool = True,
) -> DataFrame:
    """J1 -> (W5) -> P9 -> P13: one row per training example carrying its
    keys, features and both labels (nothing is aligned by position).

    The join is left to AQE: a label side measured small is broadcast,
    otherwise a sort-merge join whose skewed partitions AQE splits. The lag
    window is only planned when the feature list uses lag columns (the
    default twelve features do not). With ``encode=False`` the position code
    is left out and ``player_position`` kept, for coding after a vocabulary
    has been fitted on these rows."""
    merged = join_inputs_outputs(inputs, outputs)
    if uses_lag_features(feature_columns):
        merged = lag_stage(merged, inputs, outputs, [*tiebreak, "x_target", "y_target"], hot_group_rows)
    keep = [*FRAME_KEYS, *tiebreak, "x_target", "y_target"]
    if encode:
        feats, _ = prepare_features(merged, vocabulary=vocabulary)
        return clean_features(select_features(feats, feature_columns, keep), feature_columns)
    feats, _ = prepare_features(merged, encoder="none")
    uncoded = [c for c in feature_columns if c != CODE_COLUMN]
    position = [POSITION_COLUMN] if POSITION_COLUMN in feats.columns else []
    return clean_features(select_features(feats, uncoded, [*keep, *position]), uncoded)


def profile_rows(
    rows: DataFrame, sample_keys: Sequence[str], seed: int, order_col: str | None
) -> tuple[list[tuple[str, int]], list[str] | None]:
    """One aggregation pass over the training rows (grouping sets, i.e. one
    Expand + partial aggregation) giving both the sample-hash prefix
    histogram and the position vocabulary: first-appearance order by
    ``order_col`` when given, else sorted. At most 65 536 prefix rows and the
    distinct positions, which the model record lists, reach the driver."""
    hashed = rows.withColumn("_prefix", F.substring(key_hash(sample_keys, seed), 1, PREFIX_DIGITS))
    has_position = POSITION_COLUMN in rows.columns
    if not has_position:
        hashed = hashed.withColumn(POSITION_COLUMN, F.lit(None).cast("string"))
    first = F.min(order_col) if order_col else F.lit(None).cast("long")
    stats = hashed.groupingSets([["_prefix"], [POSITION_COLUMN]], "_prefix", POSITION_COLUMN).agg(
        F.count(F.lit(1)).alias("n"), first.alias("first"), F.grouping_id().alias("g")
    )
    collected = stats.collect()
    hist = sorted((r["_prefix"], r["n"]) for r in collected if r["g"] == 1)
    positions = [r for r in collected if r["g"] == 2 and r[POSITION_COLUMN] is not None]
    if not has_position:
        return hist, None
    if order_col:
        vocab = [r[POSITION_COLUMN] for r in sorted(positions, key=lambda r: (r["first"], r[POSITION_COLUMN]))]
    else:
        vocab = sorted(r[POSITION_COLUMN] for r in positions)
    return hist, vocab


def train(
    spark: SparkSession,
    inputs: DataFrame,
    outputs: DataFrame,
    families: Mapping[str, Mapping] = M.ENSEMBLE_PARAMS,
    weights: Mapping[str, float] | None = None,
    max_rows: int = M.MAX_TRAIN_ROWS,
    test_size: float = VALIDATION_FRACTION,
    seed: int = M.SEED,
    order_col: str | None = None,
    feature_columns: Sequence[str] = FEATURE_COLUMNS,
    output_root: str | None = None,
    max_iter: int | None = None,
    hot_group_rows: int | None = HOT_GROUP_ROWS,
) -> TrainResult:
    """M8. ``order_col`` (a row id of the inputs) makes the position
    vocabulary first-appearance ordered; without it the vocabulary is sorted.
    The vocabulary is fitted on the training rows, stored with the model and
    used at scoring. The join and feature plan runs exactly twice: one
    profiling aggregation and one checkpointed sample."""
    tiebreak = [order_col] if order_col else []
    rows = build_training_rows(inputs, outputs, None, tiebreak, feature_columns, hot_group_rows, encode=False)
    sample_keys = [*FRAME_KEYS, *tiebreak, "x_target", "y_target"]
    # Pass 1: one aggregation yields the row count, the sample's hash histogram
    # and the position vocabulary. Pass 2 settles the rows up to the boundary
    # bucket; what is left of it is cut off from there.
    hist, vocab = profile_rows(rows, sample_keys, seed, order_col)
    sampled, n_clean = sample_from_histogram(rows, hist, max_rows, sample_keys, seed, settle=True)
    if CODE_COLUMN in feature_columns:
        sampled = category_code_vocab(sampled, vocab or [])
    sampled = sampled.select(*sample_keys, *feature_columns)
    counts = {"n_clean": n_clean}
    # The sampled, split rows are materialised once in the shared checkpoint
    # folder: fitting and evaluation read them without re-running the join
    # and the sample, and a lost executor does not trigger that either.
    # The split hashes with a seed of its own: the sample is the low end of
    # its hash order, so the same hash would put all of it on one side. A sample
    # of few rows may lie in few partitions; fitting wants it spread out.
    spread = sampled.repartition(max(1, inputs.sparkSession.sparkContext.defaultParallelism))
    split = M.durable(train_val_split(spread, sample_keys, test_size=test_size, seed=seed + SPLIT_SEED_STEP))
    if weights is None and set(families) == set(M.DEFAULT_WEIGHTS):
        weights = M.DEFAULT_WEIGHTS
    bundle = M.fit_models(split, families, feature_columns, "is_val", weights, vocab, max_iter)
    val = split.where(F.col("is_val"))
    metrics = M.evaluate(bundle, val)
    bundle.metrics = {k: v for k, v in metrics.items() if k.endswith("_rmse_x") or k.endswith("_rmse_y") or k == "combined_rmse"}
    counts.update({"n_sampled": min(max_rows, counts["n_clean"]), "n_val": metrics.get("n_val")})
    path = M.save_bundle(spark, bundle, output_root) if output_root else None
    return TrainResult(bundle, metrics, counts, path)


def main(argv: Sequence[str] | None = None) -> None:
    from frametide.session import build_session
    from frametide.sources.files import scan_inputs, scan_outputs

    ap = argparse.ArgumentParser(description="Train the x/y ensemble")
    ap.add_argument("--train-dir", default="train")
    ap.add_argument("--output", default="models")
    ap.add_argument("--max-rows", type=int, default=M.MAX_TRAIN_ROWS)
    ap.add_argument("--weight-a", type=float, default=0.5)
    ap.add_argument("--weight-b", type=float, default=0.5)
    ap.add_argument("--single", action="store_true", help="one boosted model per axis instead of the ensemble")
    args = ap.parse_args(argv)
    spark = build_session()
    families = {"gbt": M.SINGLE_PARAMS} if args.single else M.ENSEMBLE_PARAMS
    weights = {"gbt": 1.0} if args.single else {"a": args.weight_a, "b": args.weight_b}
    result = train(
        spark, scan_inputs(spark, args.train_dir), scan_outputs(spark, args.train_dir),
        families, weights, args.max_rows, output_root=args.output,
    )
    print({"path": result.path, **result.bundle.metrics})


if __name__ == "__main__":
    main()
