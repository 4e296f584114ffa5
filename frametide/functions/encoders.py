"""Categorical codes (P6, P7, P8) and vocabulary fitting.

Codes are a relation: (value, code) over the distinct values, ranked inside
the same plan and joined back, so building a query starts no job and any number
of values is coded. The distinct branch reads the coded column alone. Whether
the code table is broadcast is left to its measured size (AQE); a value that
holds many rows is split by AQE's skew join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frametide.session import checkpoint_dir

#: A vocabulary of so many values is searched as a literal array; a longer one
#: is a relation whose known size decides on its broadcast.
LITERAL_VALUES = 64

#: Rows of one bucket of an ordering column lie within so many (bits of) values.
BUCKET_BITS = 16


def vocab_code(col: Column | str, vocabulary: Sequence[str]) -> Column:
    """Position of the value in ``vocabulary`` (0-based); unseen/null -> -1."""
    c = F.col(col) if isinstance(col, str) else col
    if not vocabulary:
        return F.lit(-1)
    vocab = F.array(*[F.lit(v) for v in vocabulary])
    return F.coalesce((F.array_position(vocab, c.cast("string")) - 1).cast("int"), F.lit(-1))


def _distinct(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias(col)).distinct()


def fit_sorted_vocabulary(df: DataFrame, col: str) -> list[str]:
    """Distinct non-null values in ascending (code point) order, as the model
    record lists them."""
    return [r[col] for r in _distinct(df, col).orderBy(col).collect()]


def first_seen_table(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """(value, first_order) per distinct non-null value; partial aggregation
    shrinks each map task to its distinct values before the shuffle."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).cast("string").alias(col))
        .agg(F.min(order_col).alias("first_order"))
    )


def fit_first_seen_vocabulary(df: DataFrame, col: str, order_col: str) -> list[str]:
    """Distinct non-null values in order of first appearance by ``order_col``
    (ties broken by value), as the model record lists them."""
    return [r[col] for r in first_seen_table(df, col, order_col).orderBy("first_order", col).collect()]


def _bucket(df: DataFrame, col: str) -> Column:
    """A coarse value that never falls while ``col`` rises: what ranks are
    counted by before they are counted within."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        return F.substring(col, 1, 2)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.shiftright(F.col(col).cast("long"), BUCKET_BITS)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.to_date(col)
    return F.lit(0)


def lazy_index(values: DataFrame, order_cols: Sequence[str], out: str = "code") -> DataFrame:
    """Exact 0-based global index (long) of each row of ``values`` in
    ``order_cols`` order (unique per row), as part of the plan: rows are ranked
    within buckets of the first column, and buckets are offset by the number of
    rows before them (one row per bucket is summed up in order)."""
    ranked = values.withColumn("_bucket", _bucket(values, order_cols[0]))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranked.groupBy(F.col("_bucket").alias("_at")).agg(F.count("*").alias("_n"))
    offsets = offsets.withColumnRenamed("_at", "_bucket").select(F.col("_bucket").alias("_at"), F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_cols))
    joined = ranked.withColumn("_within", within).join(offsets, F.col("_bucket").eqNullSafe(F.col("_at")))
    return joined.withColumn(out, F.col("_offset") + F.col("_within") - 1).drop("_bucket", "_at", "_within", "_offset")


def sorted_codes(df: DataFrame, col: str) -> DataFrame:
    """Code table of P6: (value, code), codes ascending with the value."""
    return lazy_index(_distinct(df, col), [col])


def first_seen_codes(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """Code table of P8: (value, code), codes in order of first appearance."""
    return lazy_index(first_seen_table(df, col, order_col), ["first_order", col]).select(col, "code")


def dense_index(values: DataFrame, order_cols: Sequence[str], out: str = "code") -> DataFrame:
    """Exact 0-based global index (long) of each row of ``values`` in
    ``order_cols`` order (which must be unique per row), without funnelling
    rows through one task.

    Range partitioning cuts the rows into ordered slices; after sorting each
    slice in place, ``monotonically_increasing_id`` (partition id << 33 plus
    the row's position in its partition) yields the in-slice position with no
    further shuffle. A per-slice offset (one row per partition, a proven
    bound, broadcast) turns it into the global index.
    """
    ordered = (
        values.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_slice", F.spark_partition_id())
    )
    local = ordered.withColumn(
        "_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_slice").cast("long"), 33)
    )
    # Slices come from sampled bounds: fix them once, before both uses.
    checkpoint_dir(values.sparkSession)
    local = local.checkpoint()
    sizes = local.groupBy("_slice").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn(
        "_offset",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_slice", "_offset")
    return (
        local.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_slice", "_local", "_offset")
    )


def apply_codes(df: DataFrame, codes: DataFrame, col: str, out: str) -> DataFrame:
    """``out``: the code that ``codes`` (value, code) gives ``col``; -1 without one."""
    value, code = codes.columns
    table = codes.select(F.col(value).alias("_code_value"), F.col(code).cast("int").alias("_code"))
    joined = df.join(table, F.col(col).cast("string") == F.col("_code_value"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_code"), F.lit(-1))).drop("_code_value", "_code")


def category_code_sorted(df: DataFrame, col: str = "player_position", out: str = "player_pos_code") -> DataFrame:
    """code = rank of the value among the sorted distinct values; null -> -1;
    absent column -> 0."""
    if col not in df.columns:
        return df.withColumn(out, F.lit(0))
    return apply_codes(df, sorted_codes(df, col), col, out)


def category_code_first_seen(
    df: DataFrame, col: str = "player_position", order_col: str = "row_id", out: str = "player_pos_code"
) -> DataFrame:
    """code = order of first appearance (by ``order_col``); null -> -1;
    absent column -> 0."""
    if col not in df.columns:
        return df.withColumn(out, F.lit(0))
    return apply_codes(df, first_seen_codes(df, col, order_col), col, out)


def vocabulary_table(spark: SparkSession, vocabulary: Sequence[str]) -> DataFrame:
    """(value, code) of a fitted vocabulary; of a repeated value, the first."""
    first = {v: i for i, v in reversed(list(enumerate(vocabulary)))}
    return spark.createDataFrame(list(first.items()), "value string, code int")


def category_code_vocab(
    df: DataFrame, vocabulary: Sequence[str] | DataFrame, col: str = "player_position", out: str = "player_pos_code"
) -> DataFrame:
    """P7 as a DataFrame step: codes by a fitted vocabulary (a list in code
    order, or a code table); absent column -> 0."""
    if col not in df.columns:
        return df.withColumn(out, F.lit(0))
    if isinstance(vocabulary, DataFrame):
        return apply_codes(df, vocabulary, col, out)
    if len(vocabulary) > LITERAL_VALUES:
        return apply_codes(df, vocabulary_table(df.sparkSession, vocabulary), col, out)
    return df.withColumn(out, vocab_code(col, vocabulary))
