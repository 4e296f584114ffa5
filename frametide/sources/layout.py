"""Columnar, week-partitioned storage of frame tables.

Weekly CSV files are the exchange format; at scale the frames are kept as
parquet partitioned by ``week`` so that week predicates (temporal splits,
week-restricted scoring) prune whole directories and column selections
read only the needed column chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frametide.schemas import PLAY_KEYS, PLAYER_KEYS


def write_week_partitioned(
    df: DataFrame, root: str, week: str = "week", cluster: Sequence[str] = (*PLAYER_KEYS, "frame_id"), codec: str = "zstd"
) -> str:
    """Write ``df`` as parquet partitioned by ``week``. Rows are shuffled by
    week and player keys (each week spread over many tasks and files) and
    sorted by the player series inside each file, which keeps a series
    together and compresses well."""
    keys = [c for c in cluster if c in df.columns]
    (
        df.repartition(week, *keys[:3])
        .sortWithinPartitions(week, *keys)
        .write.mode("overwrite")
        .option("compression", codec)
        .partitionBy(week)
        .parquet(root)
    )
    return root


def scan_weeks(spark: SparkSession, root: str, weeks: Column | None = None, week: str = "week") -> DataFrame:
    """Read a week-partitioned frame table; a predicate on ``week`` is a
    partition filter (only matching directories are listed and read)."""
    df = spark.read.parquet(root)
    return df.where(weeks) if weeks is not None else df


def weeks_after(last_train_week: int, week: str = "week") -> Column:
    return F.col(week) > F.lit(last_train_week)


#: Folders that a play store has.
PLAY_BUCKETS = 256


@dataclass(frozen=True)
class PlayStore:
    """Frames stored by play bucket: a batch of plays reads the folders its
    plays hash to, and nothing else."""

    root: str
    buckets: int = PLAY_BUCKETS
    keys: tuple[str, ...] = tuple(PLAY_KEYS)
    column: str = "play_bucket"
    schema: T.StructType | None = None

    def bucket(self) -> Column:
        """The bucket of a row; integral keys count as long, so that both sides agree."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def write(self, frames: DataFrame) -> PlayStore:
        """Store ``frames``; rows of a bucket are spread over as many files as
        their size asks for (adaptive execution splits large ones)."""
        rows = frames.withColumn(self.column, self.bucket()).hint("rebalance", self.column)
        rows.write.mode("overwrite").partitionBy(self.column).parquet(self.root)
        return replace(self, schema=rows.schema)

    def of(self, batch: DataFrame) -> DataFrame:
        """The stored frames of the buckets that ``batch`` has plays in. The
        buckets (``buckets`` numbers at most) are looked up first, so the scan
        lists and reads their folders alone."""
        wanted = sorted(r["b"] for r in batch.select(self.bucket().alias("b")).distinct().collect())
        reader = batch.sparkSession.read
        stored = (reader.schema(self.schema) if self.schema else reader).parquet(self.root)
        return stored.where(F.col(self.column).isin(wanted)).drop(self.column)
