"""Per-player lag, delta and velocity features.

All lags share one window specification, so Catalyst plans a single
Exchange(hash on the group keys) + Sort + Window for every lag column.

Groups are normally player-in-play series (tens of frames). Because a single
group may still hold a large share of the rows, ``hot_group_rows`` enables a
split path: groups above that size (found from a sample) are cut into ordered
range slices processed in parallel, and only the first ``max(lags)`` rows of
each slice are recomputed from a small boundary set (<= 2*max(lags) rows per
slice). No task ever holds a whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frametide.session import checkpoint_dir
from frametide.functions.numeric import ensure_numeric
from frametide.schemas import LAG_NUMERIC_INPUTS, PLAYER_KEYS

DEFAULT_LAGS = (1, 2, 3)


def lag_column_names(lag: int) -> list[str]:
    return [
        f"x_shift_{lag}",
        f"y_shift_{lag}",
        f"frame_shift_{lag}",
        f"dx_lag_{lag}",
        f"dy_lag_{lag}",
        f"dt_lag_{lag}",
        f"vx_lag_{lag}",
        f"vy_lag_{lag}",
    ]


def _shift_exprs(window, keys: Sequence[str], lags: Sequence[int], x: str, y: str, frame: str) -> dict[str, Column]:
    """One window expression per (column, lag) - nine for lags 1-3.
    Rows whose group key has a null get null shifts (a null key is not a
    group)."""
    keys_present = F.lit(True)
    for k in keys:
        keys_present = keys_present & F.col(k).isNotNull()
    out: dict[str, Column] = {}
    for lag in lags:
        out[f"x_shift_{lag}"] = F.when(keys_present, F.lag(x, lag).over(window))
        out[f"y_shift_{lag}"] = F.when(keys_present, F.lag(y, lag).over(window))
        # Double like the other shifts (a missing shift is a missing number).
        out[f"frame_shift_{lag}"] = F.when(keys_present, F.lag(frame, lag).over(window)).cast("double")
    return out


def _delta_exprs(lags: Sequence[int], x: str, y: str, frame: str) -> dict[str, Column]:
    """W2-W4 from the shift columns (a plain projection after the window)."""
    out: dict[str, Column] = {}
    for lag in lags:
        dx = F.col(x) - F.col(f"x_shift_{lag}")
        dy = F.col(y) - F.col(f"y_shift_{lag}")
        # A zero frame delta (duplicate frame) is treated as unknown, so the
        # velocity is 0 rather than a division by zero (ANSI mode raises).
        dt = F.nullif((F.col(frame) - F.col(f"frame_shift_{lag}")).cast("double"), F.lit(0.0))
        out[f"dx_lag_{lag}"] = F.coalesce(dx, F.lit(0.0))
        out[f"dy_lag_{lag}"] = F.coalesce(dy, F.lit(0.0))
        out[f"dt_lag_{lag}"] = F.coalesce(dt, F.lit(0.0))
        out[f"vx_lag_{lag}"] = F.coalesce(dx / dt, F.lit(0.0))
        out[f"vy_lag_{lag}"] = F.coalesce(dy / dt, F.lit(0.0))
    return out


def _with_lags(df: DataFrame, partition: Sequence[str], order: Sequence[str], keys, lags, x, y, frame):
    window = Window.partitionBy(*partition).orderBy(*order)
    shifted = df.select("*", *[c.alias(n) for n, c in _shift_exprs(window, keys, lags, x, y, frame).items()])
    derived = shifted.select("*", *[c.alias(n) for n, c in _delta_exprs(lags, x, y, frame).items()])
    return derived.select(*df.columns, *[n for lag in lags for n in lag_column_names(lag)])


# Expected sampled rows of a group exactly at the hot threshold: enough to
# separate hot groups from ordinary ones (relative noise ~ 1/sqrt(2000)).
HOT_SAMPLE_ROWS = 2000


def find_hot_groups(
    df: DataFrame, keys: Sequence[str], hot_group_rows: int, sample_fraction: float | None = None, seed: int = 7
) -> DataFrame:
    """Group keys whose estimated size exceeds ``hot_group_rows``.

    Estimated from a Bernoulli sample of the key columns only; by default
    the fraction is HOT_SAMPLE_ROWS / hot_group_rows, so the aggregation
    stays tiny however large the input is. A group flagged by mistake is
    still processed exactly, so the estimate only steers cost, never results.
    """
    if sample_fraction is None:
        sample_fraction = min(1.0, HOT_SAMPLE_ROWS / hot_group_rows)
    threshold = max(1.0, hot_group_rows * sample_fraction)
    return (
        df.select(*keys)
        .sample(fraction=sample_fraction, seed=seed)
        .groupBy(*keys)
        .agg(F.count("*").alias("_sampled"))
        .where(F.col("_sampled") >= threshold)
        .select(*keys)
    )


# Expected sampled rows of a join key at the heavy threshold below.
HEAVY_SAMPLE_ROWS = 64
_HASH_RANGE = 1 << 20


def find_hot_joined_groups(
    left: DataFrame,
    right: DataFrame,
    join_keys: Sequence[str],
    keys: Sequence[str],
    hot_group_rows: int,
    how: str = "inner",
    seed: int = 7,
) -> DataFrame:
    """Group keys (a subset of ``join_keys``) whose size after
    ``left`` join ``right`` is estimated above ``hot_group_rows``, without
    running the join: a join key's rows are its rows on the left times those
    on the right (at least one for a left join).

    A product of hot_group_rows needs sqrt(hot_group_rows) rows on one side,
    so join keys of half that many rows on a side, found by a sample of the
    key columns, are counted exactly on both sides. Of the others both sides
    count the same share, chosen by a hash of the join key. A group flagged
    by mistake, or missed, changes cost and not results."""
    join_keys, keys = list(join_keys), list(keys)
    heavy_rows = max(1, int(hot_group_rows**0.5) // 2)
    fraction = min(1.0, HEAVY_SAMPLE_ROWS / heavy_rows)
    heavy = find_hot_groups(left, join_keys, heavy_rows, fraction, seed).unionByName(
        find_hot_groups(right, join_keys, heavy_rows, fraction, seed + 1)
    )
    # Four plans read it; it holds at most a key per heavy_rows / 2 rows or so.
    checkpoint_dir(left.sparkSession)
    heavy = heavy.distinct().checkpoint()
    share = min(1.0, HOT_SAMPLE_ROWS / hot_group_rows)
    hashed = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in join_keys]), F.lit(_HASH_RANGE))
    chosen = hashed < int(share * _HASH_RANGE)

    def products(pick) -> DataFrame:
        counts = [pick(df.select(*join_keys)).groupBy(*join_keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
        return counts[0].join(counts[1], join_keys, how).select(*keys, (F.col("_l") * F.coalesce("_r", F.lit(1))).alias("_n"))

    exact = products(lambda df: df.join(heavy, join_keys, "left_semi"))
    others = products(lambda df: df.where(chosen).join(heavy, join_keys, "left_anti")).select(*keys, (F.col("_n") / share).alias("_n"))
    sizes = exact.withColumn("_n", F.col("_n").cast("double")).unionByName(others).groupBy(*keys).agg(F.sum("_n").alias("_n"))
    return sizes.where(F.col("_n") >= hot_group_rows).select(*keys)


def _split_hot_lags(hot: DataFrame, keys, order, lags, x, y, frame) -> DataFrame:
    depth = max(lags)
    # Range partitioning on the full ordering cuts each hot group into
    # contiguous, ordered slices (equal sort keys never straddle two slices).
    sliced = hot.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id())
    segment = Window.partitionBy(*keys, "_slice")
    ordered = segment.orderBy(*order)
    # Position, slice size and all shifts in one pass over each sorted slice:
    # the same Window node sees one row order, so positions and shifts agree
    # even among rows that tie on the ordering.
    shifts = _shift_exprs(ordered, keys, lags, x, y, frame)
    inner = sliced.select(
        "*",
        F.row_number().over(ordered).alias("_pos"),
        F.count(F.lit(1)).over(segment).alias("_seg_n"),
        *[c.alias(n) for n, c in shifts.items()],
    )
    # Slices come from sampled bounds: both branches must read the same ones.
    checkpoint_dir(hot.sparkSession)
    inner = inner.checkpoint()
    body = inner.where(F.col("_pos") > depth).select(
        *sliced.columns, "_pos", *shifts, *[c.alias(n) for n, c in _delta_exprs(lags, x, y, frame).items()]
    )
    # The first `depth` rows of a slice need up to `depth` predecessors, which
    # are the head rows of the slice or tail rows of earlier slices.
    boundary = inner.where((F.col("_pos") <= depth) | (F.col("_pos") > F.col("_seg_n") - depth)).select(
        *sliced.columns, "_pos"
    )
    fixed = _with_lags(boundary, keys, [*order, "_slice", "_pos"], keys, lags, x, y, frame).where(
        F.col("_pos") <= depth
    )
    return body.unionByName(fixed).drop("_slice", "_pos")


def time_lag_features(
    df: DataFrame,
    group_keys: Sequence[str] | None = None,
    lags: Sequence[int] = DEFAULT_LAGS,
    tiebreak: str | Sequence[str] | None = None,
    x: str = "x",
    y: str = "y",
    frame: str = "frame_id",
    coerce: bool = True,
    hot_group_rows: int | None = None,
    hot_sample_fraction: float | None = None,
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """x/y/frame shifts, deltas, frame deltas and velocities per lag.

    ``tiebreak`` orders rows that share a frame (duplicate frames); without it
    their relative order is unspecified. ``hot_group_rows`` switches on the
    split path for oversized groups (see module docstring); ``hot_keys`` can
    pass a precomputed table of hot group keys instead.
    """
    keys = list(group_keys or PLAYER_KEYS)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    order = [frame, *ties]
    if coerce:
        df = ensure_numeric(df, [frame, x, y, *[c for c in LAG_NUMERIC_INPUTS if c not in ("frame_id", "x", "y")]])
    if hot_group_rows is None and hot_keys is None:
        return _with_lags(df, keys, order, keys, lags, x, y, frame)

    if hot_keys is None:
        hot_keys = find_hot_groups(df, keys, hot_group_rows, hot_sample_fraction)
    # At most (sampled rows / threshold) keys: a bounded, tiny table.
    hot_list = hot_keys.limit(100_001).collect()
    if not hot_list:
        return _with_lags(df, keys, order, keys, lags, x, y, frame)
    if len(hot_list) <= 100_000:
        # The collected list itself is the broadcast side: proven small.
        key_schema = hot_keys.select(*keys).schema
        flags = F.broadcast(
            df.sparkSession.createDataFrame(hot_list, key_schema).withColumn("_hot", F.lit(True))
        )
    else:
        flags = hot_keys.withColumn("_hot", F.lit(True))
    flagged = df.join(flags, keys, "left")
    cold = flagged.where(F.col("_hot").isNull()).drop("_hot")
    hot = flagged.where(F.col("_hot")).drop("_hot")
    cold_out = _with_lags(cold, keys, order, keys, lags, x, y, frame)
    hot_out = _split_hot_lags(hot, keys, order, lags, x, y, frame)
    columns = df.columns + [n for lag in lags for n in lag_column_names(lag)]
    return cold_out.unionByName(hot_out).select(*columns)
