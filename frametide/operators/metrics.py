"""Aggregations (A1-A10). Each report is one ``agg`` (partial aggregation on
the map side, a single tiny final stage)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frametide.functions.encoders import first_seen_table, lazy_index
from frametide.functions.keys import play_key


def _sq(pred: str, truth: str) -> Column:
    d = F.col(pred) - F.col(truth)
    return d * d


def mse(pred: str, truth: str) -> Column:
    """Mean squared error over all rows; null when any row lacks its
    prediction or truth (``avg`` alone would leave such rows out unseen)."""
    err = _sq(pred, truth)
    return F.when(F.count(err) == F.count(F.lit(1)), F.avg(err))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A1: (table, n_rows) for each named DataFrame, as one union."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rmse_xy(df: DataFrame, px: str, py: str, tx: str, ty: str) -> DataFrame:
    """A2 + A3: RMSE per axis and the combined sqrt((mse_x + mse_y) / 2);
    null where a prediction is missing."""
    means = df.agg(mse(px, tx).alias("mse_x"), mse(py, ty).alias("mse_y"))
    return means.select(
        F.sqrt("mse_x").alias("rmse_x"),
        F.sqrt("mse_y").alias("rmse_y"),
        F.sqrt((F.col("mse_x") + F.col("mse_y")) / 2).alias("combined_rmse"),
    )


def rmse_by_model(
    df: DataFrame, models: Mapping[str, tuple[str, str]], tx: str, ty: str, combined: str | None = None
) -> DataFrame:
    """A4: ``<model>_rmse_x`` / ``<model>_rmse_y`` for every model (name ->
    (pred_x, pred_y)) plus ``combined_rmse`` of model ``combined``, in one pass;
    null where a prediction is missing."""
    aggs = []
    for name, (px, py) in models.items():
        aggs += [mse(px, tx).alias(f"{name}_mse_x"), mse(py, ty).alias(f"{name}_mse_y")]
    means = df.agg(*aggs)
    cols = []
    for name in models:
        cols += [F.sqrt(f"{name}_mse_x").alias(f"{name}_rmse_x"), F.sqrt(f"{name}_mse_y").alias(f"{name}_rmse_y")]
    if combined:
        cols.append(F.sqrt((F.col(f"{combined}_mse_x") + F.col(f"{combined}_mse_y")) / 2).alias("combined_rmse"))
    return means.select(*cols)


def prediction_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A5: min, max, mean of each prediction column."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean")]
    return df.agg(*aggs)


def is_finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def finite_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, any NaN and all finite; a missing value is a NaN."""
    aggs = []
    for c in columns:
        col = F.col(c)
        aggs += [
            F.coalesce(F.bool_or(col.isNull() | F.isnan(col)), F.lit(False)).alias(f"{c}_any_nan"),
            F.coalesce(F.every(F.coalesce(is_finite(col), F.lit(False))), F.lit(True)).alias(f"{c}_all_finite"),
        ]
    return df.agg(*aggs)


def distinct_in_order(df: DataFrame, col: str, order_col: str, out: str = "ordinal") -> DataFrame:
    """Distinct non-null values with their first ``order_col`` and their
    0-based rank in first-appearance order. Ranked over the distinct set only
    (already reduced by partial aggregation), bucket by bucket, as part of
    the plan."""
    indexed = lazy_index(first_seen_table(df, col, order_col), ["first_order", col], out)
    return indexed.withColumn(out, F.col(out).cast("int"))


def distinct_plays(df: DataFrame, order_col: str, game: str = "game_id", play: str = "play_id") -> DataFrame:
    """Distinct play keys in first-appearance order."""
    keyed = df.withColumn("unique_play_id", play_key(game, play))
    return distinct_in_order(keyed, "unique_play_id", order_col, "batch_index")


def rows_removed(df: DataFrame, feature_columns: Sequence[str]) -> DataFrame:
    """Rows before and after dropping rows with a missing feature, one pass."""
    keep = F.lit(True)
    for c in feature_columns:
        col = F.col(c)
        keep = keep & col.isNotNull() & ~F.isnan(col.cast("double"))
    return df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after")
    )


def batch_row_counts(expected: DataFrame, received: DataFrame, key: str = "unique_play_id") -> DataFrame:
    """A10: expected vs received rows per batch (full outer join of two
    per-batch counts; both sides are one row per batch)."""
    e = expected.groupBy(key).agg(F.count(F.lit(1)).alias("n_expected"))
    r = received.groupBy(key).agg(F.count(F.lit(1)).alias("n_received"))
    return e.join(r, key, "full").select(
        key,
        F.coalesce("n_expected", F.lit(0)).alias("n_expected"),
        F.coalesce("n_received", F.lit(0)).alias("n_received"),
    )
