"""SQL text fragments for the DuckDB oracle, mirroring the Spark expressions
of the operators (same arithmetic, same null rules)."""

from __future__ import annotations

from collections.abc import Sequence

from frametide.functions.numeric import INF_TEXT, NUMERIC_TEXT
from frametide.schemas import PLAYER_KEYS

ZERO = "CAST(0 AS DOUBLE)"


def r6(expr: str) -> str:
    """Six-decimal rounding with negative zero normalised (used on both sides
    for transcendental results and floating averages)."""
    return f"(round({expr}, 6) + {ZERO})"


def mse(pred: str, truth: str) -> str:
    """Mean squared error; null when a row lacks its prediction or truth."""
    err = f"({pred} - {truth}) * ({pred} - {truth})"
    return f"CASE WHEN count({err}) = count(*) THEN avg({err}) END"


def lag_sql(
    source: str,
    lags: Sequence[int] = (1, 2, 3),
    keys: Sequence[str] = PLAYER_KEYS,
    order: str = "frame_id, row_id",
    x: str = "x",
    y: str = "y",
    frame: str = "frame_id",
) -> str:
    """SELECT producing the W5 columns over ``source`` (a view name)."""
    guard = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    window = f"(PARTITION BY {', '.join(keys)} ORDER BY {order})"
    inner = []
    outer = []
    for k in lags:
        inner += [
            f"CASE WHEN {guard} THEN lag({x}, {k}) OVER {window} END AS x_shift_{k}",
            f"CASE WHEN {guard} THEN lag({y}, {k}) OVER {window} END AS y_shift_{k}",
            f"CAST(CASE WHEN {guard} THEN lag({frame}, {k}) OVER {window} END AS DOUBLE) AS frame_shift_{k}",
        ]
        dt = f"nullif(CAST({frame} - frame_shift_{k} AS DOUBLE), {ZERO})"
        outer += [
            f"x_shift_{k}",
            f"y_shift_{k}",
            f"frame_shift_{k}",
            f"coalesce({x} - x_shift_{k}, {ZERO}) AS dx_lag_{k}",
            f"coalesce({y} - y_shift_{k}, {ZERO}) AS dy_lag_{k}",
            f"coalesce({dt}, {ZERO}) AS dt_lag_{k}",
            f"coalesce(({x} - x_shift_{k}) / {dt}, {ZERO}) AS vx_lag_{k}",
            f"coalesce(({y} - y_shift_{k}) / {dt}, {ZERO}) AS vy_lag_{k}",
        ]
    shift_names = {f"{p}_shift_{k}" for k in lags for p in ("x", "y", "frame")}
    passthrough = "* EXCLUDE (" + ", ".join(sorted(shift_names)) + ")"
    return (
        f"SELECT {passthrough}, {', '.join(outer)} FROM "
        f"(SELECT *, {', '.join(inner)} FROM {source}) AS lag_inner"
    )


def numeric_text_sql(expr: str) -> str:
    """P1 for a text expression: guard with the numeric pattern, then cast;
    NaN and failures become 0."""
    v = f"CASE WHEN regexp_matches({expr}, '{NUMERIC_TEXT}') THEN TRY_CAST(trim({expr}) AS DOUBLE) END"
    v = f"CASE WHEN isinf({v}) AND NOT regexp_matches({expr}, '{INF_TEXT}') THEN NULL ELSE {v} END"
    return f"coalesce(CASE WHEN isnan({v}) THEN NULL ELSE {v} END, {ZERO})"


def sorted_code_sql(source: str, col: str = "player_position") -> str:
    """P6 code table (value, code) over ``source``."""
    return (
        f"SELECT {col} AS code_value, CAST(row_number() OVER (ORDER BY {col}) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT {col} FROM {source} WHERE {col} IS NOT NULL) AS d"
    )


def first_seen_code_sql(source: str, col: str = "player_position", order_col: str = "row_id") -> str:
    """P8 / A7 code table (value, first_order, code) over ``source``."""
    return (
        f"SELECT {col} AS code_value, first_order, "
        f"CAST(row_number() OVER (ORDER BY first_order, {col}) - 1 AS INTEGER) AS code "
        f"FROM (SELECT {col}, min({order_col}) AS first_order FROM {source} "
        f"WHERE {col} IS NOT NULL GROUP BY {col}) AS d"
    )


def features_sql(source: str, code_table: str, extra: str = "") -> str:
    """P9 over ``source`` (a view whose numeric inputs are already non-null,
    as in the fixtures) with codes from ``code_table``."""
    return (
        f"SELECT s.*{extra}, radians(s.dir) AS dir_rad, sin(radians(s.dir)) AS dir_sin, "
        f"cos(radians(s.dir)) AS dir_cos, coalesce(ct.code, -1) AS player_pos_code, "
        f"s.x - s.ball_land_x AS dx_ball, s.y - s.ball_land_y AS dy_ball, "
        f"sqrt((s.x - s.ball_land_x) * (s.x - s.ball_land_x) + (s.y - s.ball_land_y) * (s.y - s.ball_land_y)) AS dist_ball "
        f"FROM {source} AS s LEFT JOIN {code_table} AS ct ON s.player_position = ct.code_value"
    )


def md5_key_sql(keys: Sequence[str], seed: int | None = None) -> str:
    parts = ([f"'{seed}'"] if seed is not None else []) + [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"md5(concat_ws('|', {', '.join(parts)}))"
