"""Direction and ball-relative features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.functions.numeric import numeric


def direction_sin_cos(df: DataFrame, dir_col: str = "dir") -> DataFrame:
    """Heading in degrees -> dir_rad, dir_sin, dir_cos.

    A missing or unparsable heading counts as 0 degrees.
    """
    rad = F.radians(numeric(df, dir_col))
    return df.withColumn("dir_rad", rad).withColumns(
        {"dir_sin": F.sin("dir_rad"), "dir_cos": F.cos("dir_rad")}
    )


def has_ball_columns(df: DataFrame, bx: str = "ball_land_x", by: str = "ball_land_y") -> bool:
    return bx in df.columns and by in df.columns


def ball_relative(
    df: DataFrame,
    x: str = "x",
    y: str = "y",
    bx: str = "ball_land_x",
    by: str = "ball_land_y",
    present: bool | None = None,
) -> DataFrame:
    """P5: offset and Euclidean distance to the ball landing point.

    ``present`` is the ball-column presence decided on the raw input (before
    any coercion adds the columns); without ball columns all three are 0.
    The distance is written as sqrt(dx*dx + dy*dy): correctly rounded, so the
    same bits in every engine.
    """
    if present is None:
        present = has_ball_columns(df, bx, by)
    if not present:
        return df.withColumns({"dx_ball": F.lit(0.0), "dy_ball": F.lit(0.0), "dist_ball": F.lit(0.0)})
    out = df.withColumns({"dx_ball": F.col(x) - F.col(bx), "dy_ball": F.col(y) - F.col(by)})
    return out.withColumn(
        "dist_ball", F.sqrt(F.col("dx_ball") * F.col("dx_ball") + F.col("dy_ball") * F.col("dy_ball"))
    )
