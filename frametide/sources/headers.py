"""Header index of CSV files: which columns every file has, in which order.

A glob of weekly files may mix layouts (columns reordered, added or dropped
over the season). The first line of every file is read by one job, a task per
file that stops after its first batch; files with the same header then form
one scan, and the scans are united by column name.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A task holds one file: files are neither split nor packed while headers are read.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t", "spark.sql.files.minPartitionNum": "1"}


def column_names(line: str) -> list[str]:
    """Column names of a header line; empty names and repeats are numbered
    (``x``, ``x.1``), so every column stays addressable."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.lstrip("\ufeff").rstrip("\r\n")]), [])):
        name = base = name or f"Unnamed: {i}"
        n = 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def _first_lines(batches):
    """The first row of the task's file; what follows is left unread."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([c.slice(0, 1) for c in batch.columns], names=batch.schema.names)
            return


def header_index(spark: SparkSession, pattern: str) -> list[tuple[str, list[str]]]:
    """(file path, first line) of all files matching ``pattern`` that aren't
    empty, by path: what a driver holds of a file listing anyway."""
    before = {k: spark.conf.get(k, None) for k in _WHOLE_FILES}
    for key, value in _WHOLE_FILES.items():
        spark.conf.set(key, value)
    try:
        lines = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("file"), "value")
        rows = lines.mapInArrow(_first_lines, "file string, value string").collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return sorted((r["file"], r["value"]) for r in rows)


def _column(names: Sequence[str], field: T.StructField) -> Column:
    """A field of a file's raw text; null where the file lacks it."""
    if field.name not in names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)


def _layouts(spark: SparkSession, pattern: str) -> list[tuple[list[str], DataFrame]]:
    """(column names, raw text rows) per distinct header, first file first."""
    files: dict[str, list[str]] = {}  # by header
    for path, line in header_index(spark, pattern):
        files.setdefault(line, []).append(path)
    out = []
    for line, paths in files.items():
        names = column_names(line)
        raw = T.StructType([T.StructField(n, T.StringType()) for n in names])
        out.append((names, spark.read.schema(raw).option("header", True).csv(paths)))
    return out


def _united(parts: list[DataFrame]) -> DataFrame | None:
    while len(parts) > 1:  # pairwise, so that many layouts make a shallow plan
        parts = [a.unionByName(*b) if b else a for a, *b in (parts[i : i + 2] for i in range(0, len(parts), 2))]
    return parts[0] if parts else None


def scan_by_name(spark: SparkSession, pattern: str, schema: T.StructType | None = None, with_source: bool = False) -> DataFrame | None:
    """All CSV files matching ``pattern``, columns bound by each file's own
    header. With a ``schema`` its fields are read (a column that a file lacks
    is null, other columns are skipped); without one, every column of any file
    as text, in order of first appearance. None when no file has a header."""
    layouts = _layouts(spark, pattern)
    if schema is None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(n for names, _ in layouts for n in names)])
    source = [F.col("_metadata.file_path").alias("source_file")] if with_source else []
    return _united([raw.select(*[_column(names, f) for f in schema], *source) for names, raw in layouts])


def reject_report(spark: SparkSession, pattern: str, schema: T.StructType, json_lines: bool = False) -> DataFrame:
    """Cells that hold text but no value of their column's type: file,
    column_name, n_rows, n_rejected and one such text (the smallest), a row per
    file and column of ``schema`` that the file has. One scan, reading no
    columns but these; rows meet only as counts per file. ``json_lines``: the
    files hold an object per line, whose absent keys are null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    layouts = [(schema.names, spark.read.schema(text).json(pattern))] if json_lines else _layouts(spark, pattern)
    parts = []
    for names, raw in layouts:
        fields = [f for f in schema if f.name in names]
        if not fields:
            continue
        bad = {f.name: F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in fields}
        counts = [F.struct(F.lit(n).alias("column_name"), F.count_if(b).alias("n_rejected"), F.min(F.when(b, F.col(f"`{n}`"))).alias("example")) for n, b in bad.items()]
        per_file = raw.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.array(*counts).alias("c"))
        parts.append(per_file.select("file", "n_rows", F.inline("c")).select("file", "column_name", "n_rows", "n_rejected", "example"))
    united = _united(parts)
    return united if united is not None else spark.createDataFrame([], "file string, column_name string, n_rows bigint, n_rejected bigint, example string")


def observed_rejects(raw: DataFrame, schema: T.StructType, observation: Observation, keep: Sequence[str] = ()) -> DataFrame:
    """``raw`` text columns cast to ``schema``; ``observation`` holds, after
    the first action on the result, n_rows and one reject count per column,
    counted in that same pass."""
    fields = [f for f in schema if f.name in raw.columns]
    bad = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f"n_rejected_{f.name}") for f in fields]
    seen = raw.observe(observation, F.count(F.lit(1)).alias("n_rows"), *bad)
    return seen.select(*[_column(raw.columns, f) for f in schema], *keep)
