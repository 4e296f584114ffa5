"""Streaming scoring.

Test rows arrive as files, each holding whole plays. A Structured Streaming
file source picks them up; every micro-batch is scored by the batch plan
(M9) against the input frames of its plays, validated, and appended to a parquet
sink. ``availableNow`` processes everything present and stops, with progress
kept in a checkpoint under the shared checkpoint folder, so a restarted job
resumes where it stopped and never scores a file twice.

Plays must not span files: lag features need every frame of a player's
series in one micro-batch (the batch plan has no cross-batch state).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from frametide.functions.keys import play_key
from frametide.operators import models as M
from frametide.operators.validate import ErrorType, ValidationError, check_columns, submission_report
from frametide.schemas import PLAY_KEYS, ROW_ID
from frametide.sources.layout import PlayStore


def write_play_files(test: DataFrame, root: str, keys: Sequence[str] = PLAY_KEYS, files_per_batch: int | None = None) -> str:
    """Lay test rows out as parquet files that each hold whole plays
    (hash-partitioned by play key, one write job): ``files_per_batch`` of them, or as
    many as their size asks for."""
    dealt = test.repartition(files_per_batch, *keys) if files_per_batch else test.repartition(*keys)
    dealt.write.mode("overwrite").parquet(root)
    return root


def score_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    test_input: DataFrame | PlayStore,
    bundle: M.ModelBundle,
    sink_dir: str,
    checkpoint: str,
    max_files_per_trigger: int = 1,
    id_col: str = ROW_ID,
) -> None:
    """availableNow stream of test files -> scored, validated batches
    written to ``sink_dir/batch_id=<n>``. Raises INVALID_SUBMISSION if a
    batch fails. Input frames kept in a :class:`PlayStore` are read by the
    buckets of each batch's plays; a DataFrame is read whole for every batch."""
    from frametide.plans.score import score_test

    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # Scored once, validated, then appended: the batch's predictions are
        # kept (memory, spilling to disk) between the check and the write.
        frames = test_input.of(batch) if isinstance(test_input, PlayStore) else test_input
        preds = score_test(batch, frames, bundle, id_col=id_col).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            check_columns(preds, id_col=id_col)
            report = submission_report(preds, batch, id_col=id_col).first()
            if not report["valid"]:
                raise ValidationError(ErrorType.INVALID_SUBMISSION, f"batch {batch_id}: {report.asDict()}")
            # Idempotent: a retried batch overwrites its own directory
            # instead of appending a second copy (foreachBatch is
            # at-least-once); readers see batch_id by partition discovery.
            preds.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")
        finally:
            preds.unpersist()

    query = (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def play_batches(test: DataFrame, order_col: str, keys: Sequence[str] = PLAY_KEYS) -> DataFrame:
    """T1 (batch form): each test row tagged with its play key and the play's
    position in first-appearance order (``batch_index``)."""
    from frametide.operators.metrics import distinct_plays

    order = distinct_plays(test, order_col, *keys).select("unique_play_id", "batch_index")
    return test.withColumn("unique_play_id", play_key(*keys)).join(order, "unique_play_id")
