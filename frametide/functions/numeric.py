"""Numeric coercion (P1, P2): everything stays a JVM-side Column expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the textual numbers accepted by the pandas coercion we match.
# Decimal and scientific forms with optional sign and surrounding blanks, and
# signed inf / infinity in any case but without blanks. Anything else (NaN,
# hex floats, type suffixes such as "1.5d", words) is "not a number" -> 0.
NUMERIC_TEXT = (
    r"(?i)^(\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*|[+-]?(inf|infinity))$"
)
# A finite literal too large for a double (e.g. 1e400) is unparsable, not inf.
INF_TEXT = r"(?i)inf"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def numeric(df: DataFrame, name: str) -> Column:
    """Column ``name`` coerced to a number; missing/unparsable/NaN/null -> 0.

    Integral columns keep their type (they cannot hold NaN); floating and
    text columns become double. A column absent from ``df`` is the literal 0.
    """
    if name not in df.columns:
        return F.lit(0.0)
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, _INTEGRAL):
        return F.coalesce(c, F.lit(0).cast(dtype))
    if isinstance(dtype, _FLOATING):
        return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    if isinstance(dtype, (T.DecimalType, T.BooleanType)):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    if isinstance(dtype, T.StringType):
        parsed = F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double"))
        overflow = (F.abs(parsed) == F.lit(float("inf"))) & ~c.rlike(INF_TEXT)
        parsed = F.when(~overflow, parsed)
        return F.coalesce(F.nanvl(parsed, F.lit(None).cast("double")), F.lit(0.0))
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def ensure_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Coerce ``columns`` in place (absent ones are added as 0)."""
    return df.withColumns({c: numeric(df, c) for c in columns})


def fill_missing_columns(df: DataFrame, columns: Iterable[str], value: float = 0.0) -> DataFrame:
    """Add each absent column as a constant."""
    missing = {c: F.lit(value) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df
