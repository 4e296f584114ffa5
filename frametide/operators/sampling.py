"""Ordering, head, exact-size sampling and deterministic splits.

Randomness is replaced by content hashes of row keys, so a split or sample is
the same on every run, every partitioning, and in SQL (md5 is available in
every engine).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frametide.functions.encoders import dense_index
from frametide.schemas import PLAY_KEYS
from frametide.session import checkpoint_dir

# Fixed value: share of rows held out for validation.
VALIDATION_FRACTION = 0.15

# Added to the sampling seed for the train/validation split.
SPLIT_SEED_STEP = 1_000_003


def key_hash(keys: Sequence[str], seed: int | None = None) -> Column:
    """Hex md5 of ``seed|key1|key2|...`` (keys should be integral or text)."""
    parts = ([F.lit(str(seed))] if seed is not None else []) + [F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def sort_frames(df: DataFrame, keys: Sequence[str], frame: str = "frame_id", tiebreak: Sequence[str] = ()) -> DataFrame:
    """O1: total order by group keys, frame and tie-break (a range-partitioned
    sort; only used at a sink - windows order rows themselves)."""
    return df.orderBy(*keys, frame, *tiebreak)


# Up to this many rows a top-n is a TakeOrderedAndProject (each task keeps its
# own top n, one task merges them); beyond it the rows are ranked
# distributedly so no single task holds n rows.
TOP_N_SINGLE_MERGE = 1_000_000


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The ``n`` smallest rows in ``order`` (exact for any n)."""
    if n <= TOP_N_SINGLE_MERGE:
        return df.orderBy(*order).limit(n)
    ranked = dense_index(df, list(order), "_rank_in_order")
    return ranked.where(F.col("_rank_in_order") < F.lit(n)).drop("_rank_in_order")


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """O2: first ``n`` rows in ``order``."""
    return first_n(df, n, order)


# Hash-prefix histogram resolution: 4 hex digits -> at most 65 536 buckets,
# collected to the driver (a proven bound, independent of the data size).
PREFIX_DIGITS = 4
# The bucket that holds the last row taken is refined digit by digit until it
# has at most this many rows; only its hashes are then looked at one by one.
BOUNDARY_ROWS = 65_536


def sample_exact_n_with_total(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 42
) -> tuple[DataFrame, int]:
    """O3: exactly ``min(n, count)`` rows, uniformly chosen without
    replacement and reproducible - the rows with the smallest
    ``md5(seed|keys)`` - plus the input row count.

    A radix selection: one aggregation pass counts rows per 4-hex-digit hash
    prefix (partial aggregation; at most 65 536 result rows). Its sum is the row
    count, and the bucket in which the cumulative count reaches ``n`` is refined
    by its next digits, until its hashes are few enough to name the ``n``-th
    smallest. The sample is then a filter on the hash: rows stay in the
    partitions they are in, whatever ``n``, and no task gathers them.
    """
    return sample_from_histogram(df, _histogram(df, key_hash(keys, seed), ""), n, keys, seed)


def _histogram(df: DataFrame, hashed: Column, prefix: str) -> list[tuple[str, int]]:
    """(next digits, rows) of the rows whose hash starts with ``prefix``, sorted."""
    digits = F.substring(hashed, len(prefix) + 1, PREFIX_DIGITS)
    rows = df.where(hashed.startswith(prefix)) if prefix else df
    return sorted((r["p"], r["c"]) for r in rows.groupBy(digits.alias("p")).agg(F.count("*").alias("c")).collect())


def _reach(counts: Sequence[tuple[str, int]], n: int) -> tuple[str, int, int]:
    """The first value at which the running count reaches ``n``, the count
    before it, and its own."""
    before = 0
    for value, count in counts:
        if before + count >= n:
            return value, before, count
        before += count
    raise ValueError("fewer rows than asked for")


def _lowest(df: DataFrame, hist: Sequence[tuple[str, int]], n: int, hashed: Column, digits: int, ties: Column | None) -> DataFrame:
    """The ``n`` rows of the smallest hash (``digits`` hex digits); rows of the
    same hash by ``ties``, another hash, and without one any of them."""
    prefix, before, size = _reach(hist, n)
    while size > BOUNDARY_ROWS and len(prefix) < digits:
        more, skipped, size = _reach(_histogram(df, hashed, prefix), n - before)
        prefix, before = prefix + more, before + skipped
    last = df.where(hashed.startswith(prefix)).groupBy(hashed.alias("p")).agg(F.count("*").alias("c")).collect()
    cut, skipped, size = _reach(sorted((r["p"], r["c"]) for r in last), n - before)
    wanted = n - before - skipped
    if wanted == size:
        return df.where(hashed <= cut)
    equal = df.where(hashed == cut)
    if ties is not None:
        return df.where(hashed < cut).unionByName(_lowest(equal, _histogram(equal, ties, ""), wanted, ties, 16, None))
    return df.where(hashed < cut).unionByName(equal.limit(wanted))


def sample_from_histogram(
    df: DataFrame, hist: Sequence[tuple[str, int]], n: int, keys: Sequence[str], seed: int = 42, settle: bool = False
) -> tuple[DataFrame, int]:
    """The exact sample given the sorted (prefix, rows) histogram of
    ``df``'s sample hashes; returns (sample, row count). ``settle``
    checkpoints the rows up to the boundary bucket (about ``n + count/65536``),
    so that what follows doesn't compute ``df`` again. Rows that agree in all
    keys go by a hash of the whole row."""
    total = sum(c for _, c in hist)
    if total <= n:
        return df, total
    if n <= 0:
        return df.where(F.lit(False)), total
    hashed = key_hash(keys, seed)
    if settle:
        checkpoint_dir(df.sparkSession)
        df = df.where(F.substring(hashed, 1, PREFIX_DIGITS) <= F.lit(_reach(hist, n)[0])).checkpoint()
    plain = [f.name for f in df.schema if "map" not in f.dataType.simpleString()]
    ties = F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in plain])), 16, "0"))
    return _lowest(df, hist, n, hashed, 32, ties), total


def sample_exact_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """O3 (see :func:`sample_exact_n_with_total`)."""
    return sample_exact_n_with_total(df, n, keys, seed)[0]


def split_threshold(fraction: float) -> str:
    """4-hex-digit cut point: md5 prefix below it <=> the row is in the
    fraction (0.15 -> '2666', i.e. 9830/65536); 'g' lies above every digit."""
    if fraction >= 1:
        return "g"
    return format(int(fraction * 65536), "04x")


def train_val_split(
    df: DataFrame, keys: Sequence[str], test_size: float = VALIDATION_FRACTION, seed: int | None = None, out: str = "is_val"
) -> DataFrame:
    """Flag validation rows by key hash (about ``test_size`` of rows)."""
    return df.withColumn(out, F.substring(key_hash(keys, seed), 1, 4) < F.lit(split_threshold(test_size)))


def group_split(
    df: DataFrame, keys: Sequence[str] = PLAY_KEYS, test_size: float = VALIDATION_FRACTION, seed: int | None = None, out: str = "is_val"
) -> DataFrame:
    """As O4 but hashed on the play keys, so a play never straddles."""
    return train_val_split(df, keys, test_size, seed, out)


def temporal_split(df: DataFrame, last_train_week: int, week: str = "week", out: str = "is_val") -> DataFrame:
    """Weeks after ``last_train_week`` validate."""
    return df.withColumn(out, F.col(week) > F.lit(last_train_week))


def latest_version(df: DataFrame, name: str, pattern: str, group: Sequence[str] = ()) -> DataFrame:
    """Newest artifact name matching ``pattern`` (timestamped names sort
    lexicographically by time), per ``group``."""
    matched = df.where(F.col(name).rlike(pattern))
    if group:
        return matched.groupBy(*group).agg(F.max(name).alias("latest"))
    return matched.agg(F.max(name).alias("latest"))
