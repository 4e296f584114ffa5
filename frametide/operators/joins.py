"""Key joins (J1-J7) and right-side suffixing.

All joins are equi-joins planned by Catalyst. No explicit broadcast of a side
whose size grows with the data: AQE converts a join to broadcast at runtime
only when the measured side is below the threshold, and splits skewed
partitions of sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.functions.keys import play_key
from frametide.schemas import FRAME_KEYS, PLAY_KEYS, ROW_ID


def suffix_collisions(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Rename right-hand non-key columns that also exist on the left."""
    renames = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c not in keys}
    return right.withColumnsRenamed(renames) if renames else right


def key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    suffix: str = "_right",
    null_safe: bool = False,
) -> DataFrame:
    """Join on ``keys`` with pandas-merge column semantics: one copy of each
    key (left's values), colliding right columns suffixed.

    ``null_safe=True`` also matches null keys with null keys."""
    right = suffix_collisions(left, right, keys, suffix)
    if not null_safe:
        return left.join(right, list(keys), how)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def join_inputs_outputs(
    inputs: DataFrame,
    outputs: DataFrame,
    keys: Sequence[str] = FRAME_KEYS,
    null_safe: bool = False,
    cluster_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Inputs inner-join labels on the frame keys; label columns that
    collide get ``_target``. Duplicate label keys fan out (no silent dedupe).

    ``cluster_keys`` (e.g. the player keys) hash-partitions both sides on a
    subset of the join keys first, so a following per-player window reuses
    the join's partitioning instead of shuffling again (two shuffles instead
    of three; needs spark.sql.requireAllClusterKeysForCoPartition=false).
    The trade-off: a user-requested repartition cannot be split by AQE's
    skew handling, so the jobs leave it off and let AQE plan the join.
    """
    if cluster_keys:
        inputs = inputs.repartition(*cluster_keys)
        outputs = outputs.repartition(*cluster_keys)
    return key_join(inputs, outputs, keys, "inner", "_target", null_safe)


def join_test_features(
    test: DataFrame, test_input: DataFrame, keys: Sequence[str] = FRAME_KEYS, suffix: str = "_in"
) -> DataFrame:
    """Test left-join test_input on whichever frame keys both carry; a
    copy of ``test`` when they share none."""
    shared = [k for k in keys if k in test.columns and k in test_input.columns]
    if not shared:
        return test
    return key_join(test, test_input, shared, "left", suffix)


def join_head_sample(
    left: DataFrame,
    right: DataFrame,
    order_left: Sequence[str],
    order_right: Sequence[str],
    n_left: int = 50,
    n_right: int = 200,
    keys: Sequence[str] = FRAME_KEYS,
) -> DataFrame:
    """Left join of the first ``n_left`` rows of ``left`` with the first
    ``n_right`` rows of ``right`` (first = smallest ``order_*``)."""
    a = left.orderBy(*order_left).limit(n_left)
    b = right.orderBy(*order_right).limit(n_right)
    return key_join(a, b, keys, "left", "_right")


def semi_join_plays(frames: DataFrame, test: DataFrame, keys: Sequence[str] = PLAY_KEYS) -> DataFrame:
    """Frames of plays that occur in ``test`` (a left-semi join; the
    distinct play set is tiny after partial aggregation)."""
    return frames.join(test.select(*keys).distinct(), list(keys), "left_semi")


def attach_row_ids(predictions: DataFrame, ids: DataFrame, id_col: str = ROW_ID) -> DataFrame:
    """J5 + P15: predictions keyed by id joined to the expected ids, id first.
    Ids without a prediction keep null predictions (reported by validation)."""
    rest = [c for c in predictions.columns if c != id_col]
    return ids.select(id_col).join(predictions, id_col, "left").select(id_col, *rest)


def persistence_baseline(test: DataFrame, test_input: DataFrame, keys: Sequence[str] = FRAME_KEYS) -> DataFrame:
    """Predict the position the player has in the matching input frame."""
    joined = join_test_features(test, test_input.select(*keys, "x", "y"), keys)
    return joined.select(ROW_ID, "x", "y")


def unmatched_keys(test: DataFrame, test_input: DataFrame, keys: Sequence[str] = FRAME_KEYS) -> DataFrame:
    """Test rows without any input frame (left anti join)."""
    return test.join(test_input.select(*keys), list(keys), "left_anti")


def play_batches(df: DataFrame, keys: Sequence[str] = PLAY_KEYS, out: str = "unique_play_id") -> DataFrame:
    """T1 (batch form): tag each row with its play key; consumers group or
    partition on it rather than looping over plays."""
    return df.withColumn(out, play_key(*keys))


__all__ = [
    "attach_row_ids",
    "join_head_sample",
    "join_inputs_outputs",
    "join_test_features",
    "key_join",
    "persistence_baseline",
    "play_batches",
    "semi_join_plays",
    "suffix_collisions",
    "unmatched_keys",
]
