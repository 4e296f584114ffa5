"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree over exact block quotas.

Documents of a source fall into hash blocks. A source gives every block as
many whole passes as its target holds, then permuted blocks until the rest of
the target is reached, and closes the gap with single documents of blocks that
are left, until none of these fits. The tree splits the block quotas of all sources between
output shards; each shard draws its quota as the next, disjoint blocks of each
source's permutation, and its rows carry a local shuffle key.

The tree ends at GROUPS groups of shards, with BLOCKS_PER_GROUP blocks to a
group at least. Where more shards are wanted, a last level deals on executors:
every drawn block falls into as many parts as its group has shards, one for
each, rotated by draw. So only bounded sums reach the driver, a row per source
and per block; the number of sources is the bound to know, and plans and draws
are broadcast up to BROADCAST_ROWS rows, else joined by shuffle. Defined cases: a null or blank text has size 0 and is drawn
like any other; the null source is one source, ordered last; equal rows share
their draws; ids may be null or repeat; an empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import fresh

SEED = 17
BLOCKS = 4096
#: Ends of the tree on the driver, and blocks to each of them.
GROUPS = 8192
BLOCKS_PER_GROUP = 8
#: A block holds this many rows at least, so that the edge block can be filled closely.
BLOCK_ROWS = 8
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SHARD_WORDS = 2_000_000
#: Left blocks of a source whose documents may fill the last gap to its target.
FILL_BLOCKS = 8
#: Rows of a plan that are broadcast (some 100 bytes each).
BROADCAST_ROWS = 200_000


def text_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def row_key(seed: int = SEED) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def block_of(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def target_words(sizes: dict, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> dict:
    """Target per source: all words shared by weight, a target stopping at
    ``max_epochs`` times its source, the excess reshared by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, active, out = float(sum(sizes.values())), list(order), {}
    while active:
        unit = left / sum(weight[s] for s in active)
        over = [s for s in active if unit * weight[s] > max_epochs * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in active}
        for s in over:
            out[s] = float(max_epochs * sizes[s])
            left -= out[s]
        active = [s for s in active if s not in out]
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Quota of every source (column) in every shard (row): each tree node
    deals half of its shards a multivariate-hypergeometric part of its blocks."""
    out = np.zeros((shards, len(quotas)), np.int64)
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        lo, hi, q = stack.pop()
        if hi - lo == 1:
            out[lo] = q
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(q, int(q.sum()) * (mid - lo) // (hi - lo), method="marginals")
        stack += [(lo, mid, left), (mid, hi, q - left)]
    return out


@dataclass
class SourcePlan:
    source: str | None
    size: int
    target: float
    blocks: int
    partial: list = field(default_factory=list)
    edges: list = field(default_factory=list)
    gap: int = 0
    fills: list = field(default_factory=list)


@dataclass
class MixPlan:
    sources: list[SourcePlan]
    draws: list[tuple]
    groups: int
    #: Shards of a group.
    parts: int
    seed: int

    @property
    def shards(self) -> int:
        return self.groups * self.parts


def chosen(size: Column, key: Column, fills: Column) -> Column:
    """Whether a document of an edge block is taken: a round of filling takes
    all documents of at most its size within its keys."""
    return F.coalesce(F.exists(fills, lambda x: (size <= x["size"]) & key.between(x["from"], x["to"])), F.lit(False))


def small(spark, data: list, schema: str) -> DataFrame:
    """A driver table, broadcast while it has few rows."""
    df = spark.createDataFrame(data, schema)
    return F.broadcast(df) if len(data) <= BROADCAST_ROWS else df


def plan_mix(docs: DataFrame, seed: int = SEED, blocks: int = BLOCKS, weights=WEIGHTS, shard_words: int = SHARD_WORDS) -> MixPlan:
    """Block quotas, their draws and shards for ``docs``."""
    spark = docs.sparkSession
    rows = docs.select("source", text_words(F.col("text")).alias("size"), row_key(seed).alias("key")).checkpoint()
    totals = {r["source"]: (r["size"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    target = target_words({s: v[0] for s, v in totals.items()}, weights)
    whole = max(1, sum(v[0] for v in totals.values()))
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = max(1, -(-whole // shard_words))
    groups = min(GROUPS, wanted)
    blocks = max(blocks, BLOCKS_PER_GROUP * groups)
    plans = [SourcePlan(s, totals[s][0], target[s], max(1, min(totals[s][1] // BLOCK_ROWS, round(blocks * totals[s][0] / whole)))) for s in order]
    if not plans:
        return MixPlan([], [], 1, 1, seed)

    def with_source(data, schema):
        """``rows`` joined with a table of at most one row per source."""
        return rows.alias("r").join(small(spark, data, "p_source string, " + schema), F.col("source").eqNullSafe(F.col("p_source")))

    count = with_source([(p.source, p.blocks) for p in plans], "blocks bigint")
    sums: dict = {}
    for r in count.groupBy("source", block_of(F.col("key"), F.col("blocks")).alias("block")).agg(F.sum("size").alias("size")).collect():
        sums.setdefault(r["source"], {})[r["block"]] = r["size"]

    rng = np.random.default_rng(seed)
    for p in plans:
        of = sums.get(p.source, {})
        rest = round(p.target) - whole_passes(p) * p.size
        for b in rng.permutation(sorted(of)).tolist():
            if of[b] <= rest:
                p.partial.append(b)
                rest -= of[b]
            elif len(p.edges) < FILL_BLOCKS:
                p.edges.append(b)
        p.gap = rest
    _fill(plans, with_source)

    quotas, sequences = [], []
    for p in plans:
        seq = [b for _ in range(whole_passes(p)) for b in rng.permutation(p.blocks).tolist()]
        seq = [(b, False) for b in seq] + [(b, False) for b in p.partial] + [(b, True) for b in p.edges if p.fills]
        sequences.append(seq)
        quotas.append(len(seq))
    split = split_quotas(np.array(quotas), groups, rng)
    draws = []
    for i, p in enumerate(plans):
        at = np.repeat(np.arange(groups), split[:, i]).tolist()
        draws += [(p.source, b, s, edge) for (b, edge), s in zip(sequences[i], at, strict=True)]
    return MixPlan(plans, draws, groups, -(-wanted // groups), seed)


def whole_passes(p: SourcePlan) -> int:
    return min(MAX_EPOCHS, round(p.target) // p.size) if p.size else 0


#: A round of filling: it takes the documents of at most ``size`` words with keys from ``from`` to ``to``.
FILLS = "fills array<struct<size:bigint,from:bigint,to:bigint>>"
FIRST_KEY, LAST_KEY = -(1 << 63), (1 << 63) - 1


def _fill(plans: list[SourcePlan], with_source) -> None:
    """Reach into the edge blocks, document by document in the order of keys:
    every one that the gap still has room for. A round takes all up to the first
    that doesn't fit; the next starts behind it, with the gap that is left."""
    from pyspark.sql import Window

    by = {p.source: p for p in plans}
    start = {p.source: FIRST_KEY for p in plans if p.edges and p.gap > 0}
    while start:
        data = [(s, by[s].blocks, by[s].edges, by[s].gap, k) for s, k in start.items()]
        left = with_source(data, "blocks bigint, edges array<bigint>, gap bigint, from bigint").where(
            F.array_contains("edges", block_of(F.col("key"), F.col("blocks"))) & F.col("size").between(1, F.col("gap")) & (F.col("key") >= F.col("from"))
        )
        # Equal rows share a key and are drawn together.
        each = left.groupBy("source", "key", "gap").agg(F.sum("size").alias("size"))
        w = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        each = each.withColumn("so_far", F.sum("size").over(w))
        fits = F.col("so_far") <= F.col("gap")
        found = each.groupBy("source").agg(F.max(F.when(fits, F.col("key"))).alias("to"), F.max(F.when(fits, F.col("so_far"))).alias("got"), F.min(F.when(~fits, F.col("key"))).alias("stop")).collect()
        following = {}
        for r in found:
            p = by[r["source"]]
            if r["to"] is not None:
                p.fills.append((p.gap, start[p.source], r["to"]))
                p.gap -= r["got"]
            if p.gap > 0 and r["stop"] is not None and r["stop"] < LAST_KEY:
                following[p.source] = r["stop"] + 1
        start = following


def draw(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """``docs`` with a struct column ``mix``: size, source_size, target and
    ``shards``, the output shard of every time that the row is drawn."""
    spark = docs.sparkSession
    mix = fresh(docs, "mix")
    taken = [*docs.columns]
    names = {}
    for n in ("m_source", "m_blocks", "m_size", "m_target", "m_fills", "d_source", "d_block", "d_draws", "m_key"):
        names[n] = n
        while names[n].lower() in {c.lower() for c in taken}:
            names[n] = "_" + names[n]
    c = {k: F.col(v) for k, v in names.items()}
    rows = [(p.source, p.blocks, p.size, p.target, p.fills) for p in plan.sources]
    sources = small(spark, rows, f"{names['m_source']} string, {names['m_blocks']} bigint, {names['m_size']} bigint, {names['m_target']} double, {names['m_fills']} {FILLS.split(' ', 1)[1]}")
    by_block: dict = {}
    for s, b, group, edge in plan.draws:
        by_block.setdefault((s, b), []).append((group, edge))
    rows = [(s, b, d) for (s, b), d in by_block.items()]
    draws = small(spark, rows, f"{names['d_source']} string, {names['d_block']} bigint, {names['d_draws']} array<struct<group:int,edge:boolean>>")
    out = docs.withColumn(names["m_key"], row_key(plan.seed)).join(sources, docs["source"].eqNullSafe(c["m_source"]), "left")
    out = out.join(draws, docs["source"].eqNullSafe(c["d_source"]) & (block_of(c["m_key"], c["m_blocks"]) == c["d_block"]), "left")
    fill = chosen(text_words(docs["text"]), c["m_key"], c["m_fills"])
    mine = F.filter(F.coalesce(c["d_draws"], F.array()), lambda x: ~x["edge"] | fill)
    # The last level: a block's part, rotated by draw, is the shard within the group.
    part = F.xxhash64(F.lit(plan.seed + 1), c["m_key"])
    shards = F.transform(mine, lambda x, i: (x["group"] * plan.parts + F.pmod(part + i, F.lit(plan.parts))).cast("int"))
    column = F.struct(text_words(docs["text"]).alias("size"), c["m_size"].alias("source_size"), c["m_target"].alias("target"), shards.alias("shards"), c["m_key"].alias("key"))
    return out.select(*[docs[x] for x in docs.columns], column.alias(mix))


def mix(docs: DataFrame, plan: MixPlan, place: bool = True) -> DataFrame:
    """The mixed corpus: a row per draw with the columns of ``docs``, ``shard``
    and ``epoch``. With ``place`` the rows of a shard meet in one partition,
    shuffled there by a hash of key, epoch and seed."""
    m, shard, epoch, order = fresh(docs, "mix"), fresh(docs, "shard"), fresh(docs, "epoch"), fresh(docs, "mix_order")
    out = draw(docs, plan).select(*[F.col(c) for c in docs.columns], m, F.posexplode(F.col(m)["shards"]).alias(epoch, shard))
    out = out.withColumn(order, F.xxhash64(F.lit(plan.seed), F.col(m)["key"], epoch)).drop(m)
    if place:
        out = out.repartition(plan.shards, shard).sortWithinPartitions(shard, order)
    return out.drop(order)
