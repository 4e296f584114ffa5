"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are dealt to cells by their nearest centre. What a vector v differs
from its centre c by is rotated at random and stored as the signs of its
coordinates, with three correction scalars: the length of v - c, its inner
product with the code direction, and <v, c>. For a query q

    <v, q> = <v - c, q - c> + <v, c> + <c, q> - <c, c>

where only the first term is estimated, from the signs. Its error is below
``epsilon`` standard deviations of a random rotation's (``EPSILON``; at 2.2 a neighbour that
lies just above the bar is missed with a chance of about 1.4 %). A vector is reranked by its exact inner product unless
its upper bound lies below the exact score of the k-th best found in the query's first block.

A query first searches one block of its own cell, which gives a k-th best score;
then all other blocks of the cells whose upper bound reaches that score. Cells are cut
into blocks of bounded size, so a cell that holds most vectors is many tasks.
Every row is indexed, and none is left out but by a bound. Centres are fitted on
a bounded sample (``FIT_ROWS``, ``FIT_VALUES``); they steer cost, not results.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id or vectors of another length
than most vectors have (ties: the shorter); of rows that repeat an id, the one
with the smallest vector stands; queries with fewer candidates get all; ties go
to the smaller id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows, and components, that centres are fitted on at most.
FIT_ROWS = 20_000
FIT_VALUES = 8_000_000
FIT_ROUNDS = 8
MOST_CELLS = 1024
#: Standard deviations of the estimate that its error bound spans.
EPSILON = 2.2
#: Vectors in a block and queries in a pack, roughly; estimates made at a time.
BLOCK_ROWS = 8192
PACK_ROWS = 512
STEP = 1 << 18

CODED = "id bigint, cell int, v binary, code binary, size double, along double, own double"
BLOCK = "cell int, block int, ids binary, v binary, code binary, size binary, along binary, own binary"
HIT = "query_id bigint, vec_id bigint, score double"


def vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part; v as floats or doubles."""
    kind = "float" if isinstance(rows.schema[vector].dataType.elementType, T.FloatType) else "double"
    valid = F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)")
    rows = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    return rows.where("id is not null and v is not null").where(valid)


class Index:
    """Centres and rotation; small, shared with every task. ``kind``: how
    vectors are stored (f4 or f8)."""

    def __init__(self, centres: np.ndarray, seed: int, kind: str = "f8"):
        self.centres, self.kind = centres, kind
        self.dim = centres.shape[1]
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((self.dim, self.dim)))
        self.rotation = q * np.sign(np.diag(r))
        self.norms = (centres**2).sum(1)

    def cells(self, v: np.ndarray) -> np.ndarray:
        """The nearest centre of every row."""
        return np.argmin(self.norms - 2.0 * (v @ self.centres.T), axis=1).astype(np.int32)


def fit(sample: np.ndarray, cells: int, seed: int, kind: str = "f8") -> Index:
    """Centres by a few rounds of k-means over a sample."""
    rng = np.random.default_rng(seed)
    centres = sample[np.sort(rng.choice(len(sample), min(cells, len(sample)), replace=False))]
    for _ in range(FIT_ROUNDS):
        of = Index(centres, seed).cells(sample)
        count = np.bincount(of, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, of, sample)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return Index(np.unique(centres, axis=0), seed, kind)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def _encode(index: Index):
    def run(batches):
        for batch in batches:
            v = _matrix(batch.column(1), index.dim)
            with np.errstate(all="ignore"):
                cell = index.cells(v)
                rest = v - index.centres[cell]
                size = np.sqrt((rest**2).sum(1))
                turned = (rest @ index.rotation) / np.where(size > 0, size, 1.0)[:, None]
                sign = turned >= 0
                along = np.where(sign, turned, -turned).sum(1) / np.sqrt(index.dim)
                own = (v * index.centres[cell]).sum(1)
            code = np.packbits(sign, axis=1)
            binary = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell), binary(v.astype(index.kind)), binary(code), pa.array(size), pa.array(along), pa.array(own)],
                names=["id", "cell", "v", "code", "size", "along", "own"],
            )

    return run


def _pack_block(group: pa.Table) -> pa.Table:
    """A block of a cell as one row, by id."""
    group = group.sort_by("id")
    joined = {k: b"".join(group[k].to_pylist()) for k in ("v", "code")}
    plain = {k: group[k].to_numpy().tobytes() for k in ("size", "along", "own")}
    row = {"cell": group["cell"][0].as_py(), "block": group["block"][0].as_py(), "ids": group["id"].to_numpy().tobytes()} | joined | plain
    kinds = {"cell": pa.int32(), "block": pa.int32()}
    return pa.table({k: pa.array([row[k]], kinds.get(k, pa.binary())) for k in ("cell", "block", "ids", "v", "code", "size", "along", "own")})


def _above(index: Index, cell: int, block: dict, queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Estimate plus error bound less the floor, query x vector, as one product
    of matrices: the code's signs, scaled, and a column per correction."""
    dim, centre = index.dim, index.centres[cell]
    with np.errstate(all="ignore"):
        along = np.maximum(block["along"], 1e-300)
        sign = np.unpackbits(block["code"], axis=1, count=dim).astype(np.float64) * 2.0 - 1.0
        scaled = sign * (block["size"] / (along * np.sqrt(dim)))[:, None]
        spread = block["size"] * np.sqrt(np.maximum(0.0, 1.0 - along**2)) / along * (EPSILON / np.sqrt(max(dim - 1, 1)))
        away = queries - centre
        reach = np.sqrt((away**2).sum(1))
        shift = queries @ centre - index.norms[cell]
        slack = 1e-5 * (np.abs(shift) + np.abs(block["own"]).max() + block["size"].max() * reach)
        left = np.column_stack([away @ index.rotation, np.ones(len(queries)), reach, shift + slack - floor])
        right = np.column_stack([scaled, block["own"], spread, np.ones(len(scaled))])
        # Single precision where nothing can overflow; the slack covers its rounding.
        if max(np.abs(left[:, :-1]).max(), np.abs(shift).max(), np.abs(right).max()) < 1e15:
            left, right = left.astype(np.float32), right.astype(np.float32)
        return left @ right.T


def _exact(q: np.ndarray, at: np.ndarray, v: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Inner products of rows ``at`` of q with rows ``of`` of v; equal rows give equal ones."""
    score = np.empty(len(at))
    for lo in range(0, len(at), 4096):
        score[lo : lo + 4096] = (q[at[lo : lo + 4096]] * v[of[lo : lo + 4096]]).sum(1)
    return score


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` best of every query: highest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    first = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[rank < k]


def search_block(index: Index, cell: int, block: dict, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, vector id, exact score) of the ``k`` best of a block for every
    query, those below the query's ``floor`` left out."""
    n = len(block["ids"])
    step = max(1, STEP // n)
    for lo in range(0, len(queries), step):
        q, qid, bar = queries[lo : lo + step], query_ids[lo : lo + step], floor[lo : lo + step]
        hit = np.flatnonzero(~(_above(index, cell, block, q, bar) < 0))
        at, of = hit // n, hit % n
        score = _exact(q, at, block["v"], of)
        keep = np.flatnonzero((score >= bar[at]) & (block["ids"][of] != qid[at]))
        at, of, score = at[keep], of[keep], score[keep]
        keep = _best(at, block["ids"][of], score, k)
        yield qid[at[keep]], block["ids"][of[keep]], score[keep]


def _search(index: Index, k: int):
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r].as_py() for i, name in enumerate(batch.schema.names)}
                array = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: B023, E731
                n = len(row["ids"]) // 8
                block = {name: array(name, np.float64) for name in ("size", "along", "own")}
                block |= {"ids": array("ids", np.int64), "v": array("v", index.kind).astype(np.float64).reshape(n, -1), "code": array("code", np.uint8).reshape(n, -1)}
                pack = row["pack"]
                ids = np.array([p["query_id"] for p in pack], np.int64)
                queries = np.array([np.frombuffer(p["q"], index.kind) for p in pack]).astype(np.float64)
                floor = np.array([p["floor"] for p in pack])
                for part in search_block(index, row["cell"], block, ids, queries, floor, k):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, part)), names=["query_id", "vec_id", "score"])

    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # The rank is limited before the shuffle as well.
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _probe(index: Index, blocks: DataFrame, wanted: DataFrame, parts: Column, k: int) -> DataFrame:
    """Hits of the queries ``wanted`` (cell, block, query_id, q, floor)."""
    packs = wanted.groupBy("cell", "block", parts.alias("part")).agg(F.collect_list(F.struct("query_id", "q", "floor")).alias("pack"))
    pairs = blocks.join(packs.drop("part"), ["cell", "block"])
    return pairs.mapInArrow(_search(index, k), HIT)


def _cells_within_reach(index: Index, stats: np.ndarray):
    """A row per query and cell whose upper bound reaches the query's floor."""

    def run(batches):
        for batch in batches:
            q = np.array([np.frombuffer(b, index.kind) for b in batch.column(1).to_pylist()]).astype(np.float64).reshape(-1, index.dim)
            floor = batch.column(2).to_numpy()
            for lo in range(0, len(q), 256):
                part = q[lo : lo + 256]
                dot = part @ index.centres.T
                size = np.sqrt((part**2).sum(1))[:, None]
                away = np.sqrt(np.maximum(0.0, size**2 - 2 * dot + index.norms))
                # <v, q> = <c, q> + <v - c, q>, or <v - c, q - c> + <v, c> + <c, q> - <c, c>
                most = dot + np.minimum(stats[:, 1] * size, stats[:, 1] * away + stats[:, 2] - index.norms)
                most += 1e-9 * (1.0 + np.abs(most))
                at, cell = np.nonzero(((most >= floor[lo : lo + 256, None]) | ~np.isfinite(most)) & (stats[:, 0] > 0))
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at + lo)).columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 20, seed: int = 12, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of the largest inner
    product with each row where ``is_query`` (over ``id``) holds, itself aside."""
    spark = rows.sparkSession
    found = vectors(rows, id_column, vector)
    counted = found.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if counted is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim, total = counted
    kind = "f4" if isinstance(found.schema["v"].dataType.elementType, T.FloatType) else "f8"
    found = found.where(F.size("v") == dim)
    room = max(1, min(FIT_ROWS, FIT_VALUES // dim))
    key = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    picked = found.where(key <= int(min(1.0, 2.0 * room / total) * (1 << 20))).orderBy(key, "id", "v").limit(room).select("v").toArrow()
    # Ids that all hash elsewhere leave one centre in the origin.
    sample = _matrix(picked["v"].combine_chunks(), dim) if picked.num_rows else np.zeros((1, dim))
    index = fit(sample, min(MOST_CELLS, 1 + total // BLOCK_ROWS), seed, kind)

    coded = found.mapInArrow(_encode(index), CODED)
    stats = np.zeros((len(index.centres), 3))
    for cell, *values in coded.groupBy("cell").agg(F.count("*"), F.max("size"), F.max("own")).collect():  # a row per centre
        stats[cell] = values
    cuts = F.get(F.array(*[F.lit(int(1 + n // BLOCK_ROWS)) for n in stats[:, 0]]), F.col("cell"))
    block = F.pmod(F.xxhash64("id"), cuts).cast("int")
    blocks = coded.withColumn("block", block).groupBy("cell", "block").applyInArrow(_pack_block, BLOCK).checkpoint()

    asking = found.where(is_query).groupBy("id").agg(F.min("v").alias("v")).mapInArrow(_encode(index), CODED)
    asking = asking.select(F.col("id").alias("query_id"), F.col("v").alias("q"), "cell", block.alias("block")).checkpoint()
    parts = F.pmod(F.xxhash64("query_id"), F.lit(1 + asking.count() // PACK_ROWS))
    anything = F.lit(float("-inf"))
    first = _probe(index, blocks, asking.withColumn("floor", anything), parts, k).checkpoint()
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(anything).alias("floor"))
    home = [F.col("cell").alias("home_cell"), F.col("block").alias("home_block")]
    floored = asking.join(floors, "query_id", "left").select("query_id", "q", F.coalesce("floor", anything).alias("floor"), *home)
    reached = floored.mapInArrow(_cells_within_reach(index, stats), "query_id bigint, q binary, floor double, home_cell int, home_block int, cell int")
    reached = reached.withColumn("block", F.explode(F.sequence(F.lit(0), cuts - 1)))
    reached = reached.where((F.col("cell") != F.col("home_cell")) | (F.col("block") != F.col("home_block"))).drop("home_cell", "home_block")
    return _top(first.unionByName(_probe(index, blocks, reached, parts, k)), k).select("query_id", "rank", "vec_id", "score")
