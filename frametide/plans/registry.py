"""Query registry: every registered query is a Spark plan over the driver
tables of ``sf_dir`` plus (where SQL can express it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.session import tune_session

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``: DuckDB's
    count_if is a 128-bit integer, Spark's a 64-bit one."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i : j + len(token)])
            i = j + len(token)
            continue
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def register(name: str, sql: str | None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its
    oracle ``sql`` (None: checked rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune_session(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = (run, bigint_counts(sql) if sql else None)
        return run

    return deco


def r6(c: Column | str) -> Column:
    """Six-decimal rounding, negative zero normalised (see sqltext.r6)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


def _load() -> None:
    # Importing the modules registers their queries.
    from frametide.plans import queries_core, queries_io, queries_models, queries_relational  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
