"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frametide.session import checkpoint_dir, ship_package

#: Words are runs of bytes outside these six: space, \t, \n, \v, \f, \r.
WORD_BREAK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

#: Bytes of text that a numpy pass handles at once; a longer text is a pass of its own.
PASS_BYTES = 1 << 20
#: Bytes of rows that Spark hands to a Python worker at once; the passes above bring nothing for more.
BATCH_BYTES = 4 << 20


def start(spark: SparkSession) -> SparkSession:
    """Make the package importable on executors and the shared folder known,
    and bound the batches that Python workers hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
    checkpoint_dir(spark)
    return spark


def release(spark: SparkSession) -> None:
    """Have the driver collect frames that nothing refers to any more. Spark then
    removes their shuffle files, and their checkpoints where
    spark.cleaner.referenceTracking.cleanCheckpoints says so; on its own it would
    wait until the driver runs short of memory."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row: a lambda variable is
    bound, whereas a repeated expression would be evaluated per array item."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(body) > 0, F.split(body, WORD_BREAK)).otherwise(F.array().cast("array<string>"))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 row offsets; null: empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - (offsets[0] if len(offsets) else 0)


def passes(offsets: np.ndarray, limit: int = PASS_BYTES, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or of one longer row) and ``most`` rows."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, rows, row + (most or rows))
        yield row, end
        row = end


MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer over an array."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_A
    h ^= h >> np.uint64(27)
    h *= MIX_B
    h ^= h >> np.uint64(31)
    return h


def random_table(seed: int, n: int = 256) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def typed(source: DataFrame, columns: list[str], ddl: str) -> T.StructType:
    """Columns of ``source`` with their own types, then those of ``ddl``."""
    return T.StructType([T.StructField(c, source.schema[c].dataType) for c in columns] + T.StructType.fromDDL(ddl).fields)
