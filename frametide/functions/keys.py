"""Key and name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def play_key(game_col: str = "game_id", play_col: str = "play_id") -> Column:
    """P10: ``<game>_<play>``; null if either part is null (concat semantics)."""
    return F.concat(F.col(game_col).cast("string"), F.lit("_"), F.col(play_col).cast("string"))


def week_from_filename(name: Column) -> Column:
    """The number after ``_w`` in a file name (``input_2023_w07.csv`` -> 7)."""
    return F.regexp_extract(name, r"_w(\d+)", 1).try_cast("int")


def file_name_column() -> Column:
    """Base name of the file a scanned row came from (hidden metadata column)."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1)


def version_name_class(name: Column, marker: str = "model-v") -> Column:
    """Classify artifact names that contain ``marker``.

    Split on '-': a name whose fourth part is exactly six digits (a HHMMSS
    time) is 'new'; other names carrying the marker are 'old'; names without
    the marker are not classified (null).
    """
    parts = F.split(name, "-")
    fourth = F.when(F.size(parts) >= 4, F.element_at(parts, 4))
    is_new = fourth.rlike(r"^[0-9]{6}$")
    return F.when(name.contains(marker), F.when(F.coalesce(is_new, F.lit(False)), "new").otherwise("old"))
