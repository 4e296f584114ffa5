"""Weighted blending of model outputs (M4)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def blend_weighted(columns: Mapping[str, float]) -> Column:
    """M4: sum of weight * column, weights used exactly as given (not
    normalised; V9 reports weights that do not sum to 1)."""
    out = None
    for name, weight in columns.items():
        term = F.lit(float(weight)) * F.col(name)
        out = term if out is None else out + term
    return out
