"""Conversation prefix trie over ternary search trees.

A turn becomes a fixed-width key: 16 bytes of the SHA-256 of its role and text,
and its number of words. A conversation is the string of its keys. Strings are
range-partitioned by (string, id), so equal conversations, however many, may
fall into several shards. Within a shard every distinct key gets a code, and a
ternary search tree over the codes is filled median first, so that the search
for a turn among its siblings stays logarithmic. An iterative traversal counts
members, leaves and savings.

Only nodes on the path of a shard's first or last string can be shared with
another shard. A shard hands these boundary paths on, and the ids that end in
its first or last string; they are merged in shard order by one streaming pass
with a stack as deep as one conversation. That pass reads two paths per shard;
ids only of conversations whose string lies on an edge, as their SHA-256 is one
sequential pass over ids.

Defined cases: a null role or text is empty; turns go by turn (null first),
equal turn numbers by the digest of role and text, and repeated rows are turns
of their own; rows without an id take no part; a conversation without turns
ends in the root; an empty table gives no rows; extra columns are ignored. A
conversation's string (20 bytes a turn) is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_BYTES = 20
#: Turns in a shard, roughly.
SHARD_TURNS = 200_000
#: Ids in one piece of an edge string's members.
PIECE_IDS = 1 << 16

_COUNTS = {"n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string()}
_EDGE = {"edge_shard": pa.int32(), "edge_last": pa.bool_(), "edge_depth": pa.int64()}
#: A node within a shard; its parent is known, or a place on an edge of the shard.
NODE = {"conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64()} | _EDGE | _COUNTS
_LISTS = ("members", "smallest", "children", "leaves", "saved")
#: What a shard knows of its first or last path, or (string null) further ids that end there.
PATH = {"shard": pa.int32(), "part": pa.int64(), "last": pa.bool_(), "string": pa.binary()} | {k: pa.list_(pa.int64()) for k in _LISTS} | {"ends": pa.list_(pa.string()), "ids": pa.binary()}
#: A merged node, and the merged node at a place on an edge.
MERGED = {"node_id": pa.int64(), "parent_id": pa.int64(), "conv_id": pa.int64(), "depth": pa.int64()} | _COUNTS
PLACE = _EDGE | {"node_id": pa.int64()}
NO_ENDS = hashlib.sha256().hexdigest()


def strings(conversations: DataFrame) -> DataFrame:
    """conv_id and keys, the fixed-width keys of its turns in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    # The role's length keeps role and text apart.
    digest = F.sha2(F.concat_ws(":", F.length(role), role, text).cast("binary"), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    key = F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(words), 8, "0")))
    rows = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", F.struct(F.col("turn"), key.alias("key")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.transform("t", lambda t: t["key"]).alias("keys"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Every conversation c opens with up to h turns of conversation c - c % 20
    in place of its own first h, h being crc32 of its id as text, modulo 4."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")
    bases = sequences.where(c % 20 == 0).select(c.alias("base"), F.slice("keys", 1, 3).alias("head"))
    opening = F.when(h > 0, F.slice(F.coalesce(F.col("head"), F.array().cast("array<binary>")), F.lit(1), h)).otherwise(F.array().cast("array<binary>"))
    own = F.slice(F.col("keys"), h + 1, F.greatest(F.size("keys"), F.lit(1)))
    return sequences.join(bases, c - c % 20 == F.col("base"), "left").select("conv_id", F.concat(opening, own).alias("keys"))


class Shard:
    """The distinct strings of a shard, ascending, as ternary search trees."""

    def __init__(self, found: list[tuple[bytes, int, int, str]]):
        self.found = found
        split = [[s[k : k + KEY_BYTES] for k in range(0, len(s), KEY_BYTES)] for s, *_ in found]
        self.keys = sorted({k for keys in split for k in keys})
        code = {k: i for i, k in enumerate(self.keys)}
        # Node 0 is the root; ``first`` is the top of a node's children's search tree.
        self.letter, self.low, self.high, self.first = [-1], [-1], [-1], [-1]
        self.end_of = {i: self._insert([code[k] for k in split[i]]) for i in _median_first(len(split))}
        self._traverse()

    def _insert(self, codes: list[int]) -> int:
        letter, low, high, first = self.letter, self.low, self.high, self.first
        node = 0
        for c in codes:
            at, link, holder = first[node], first, node
            while at >= 0 and letter[at] != c:
                link, holder = (low, at) if c < letter[at] else (high, at)
                at = link[at]
            if at < 0:
                at = link[holder] = len(letter)
                letter.append(c)
                low.append(-1)
                high.append(-1)
                first.append(-1)
            node = at
        return node

    def _traverse(self) -> None:
        n = len(self.letter)
        self.parent, self.depth = [-1] * n, [0] * n
        self.order, waiting = [], [(0, -1, 0)]
        while waiting:
            node, parent, depth = waiting.pop()
            self.parent[node], self.depth[node] = parent, depth
            self.order.append(node)
            for sibling in (self.low[node], self.high[node]):
                if sibling >= 0:
                    waiting.append((sibling, parent, depth))
            if self.first[node] >= 0:
                waiting.append((self.first[node], node, depth + 1))
        # A node comes after its parent in that order.
        self.members, self.children, self.leaves, self.saved = [0] * n, [0] * n, [0] * n, [0] * n
        self.smallest = [None] * n
        self.ends_sha = [NO_ENDS] * n
        for i, node in self.end_of.items():
            _, conv, count, sha = self.found[i]
            self.members[node], self.smallest[node], self.ends_sha[node] = count, conv, sha
        self.edge = self._edges()
        words = [int.from_bytes(k[16:], "big") for k in self.keys]
        for node in reversed(self.order):
            p = self.parent[node]
            if node not in self.edge:
                if not self.children[node]:
                    self.leaves[node] = 1
                self.saved[node] += (self.members[node] - 1) * words[self.letter[node]]
            if p >= 0:
                self.members[p] += self.members[node]
                if self.smallest[p] is None or self.smallest[node] < self.smallest[p]:
                    self.smallest[p] = self.smallest[node]
                if node not in self.edge:  # an edge node is counted when it is merged
                    self.children[p] += 1
                    self.leaves[p] += self.leaves[node]
                    self.saved[p] += self.saved[node]

    def _edges(self) -> dict[int, bool]:
        """Nodes on the path of the first string, then of the last one (True)."""
        edge: dict[int, bool] = {}
        for last, i in ((False, 0), (True, len(self.found) - 1)):
            node = self.end_of[i]
            while node >= 0:
                edge.setdefault(node, last)
                node = self.parent[node]
        return edge

    def path(self, last: bool) -> list[int]:
        """The nodes of the first or last string, root first."""
        nodes, node = [], self.end_of[len(self.found) - 1 if last else 0]
        while node >= 0:
            nodes.append(node)
            node = self.parent[node]
        return nodes[::-1]


def _median_first(n: int) -> list[int]:
    """0 to n - 1, the median of every range before its two halves."""
    order, ranges = [], [(0, n)]
    for lo, hi in ranges:
        if lo < hi:
            mid = (lo + hi) // 2
            order.append(mid)
            ranges += [(lo, mid), (mid + 1, hi)]
    return order


def _groups(batches) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(shard, string, its ids) of rows sorted by string and id."""
    string, ids, shard = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column(2)[0].as_py()
        conv = batch.column(0).to_numpy()
        value = batch.column(1).cast(pa.large_binary())
        length = np.diff(np.frombuffer(value.buffers()[1], np.int64)[value.offset : value.offset + len(value) + 1])
        rows = value.to_pylist()
        same = [i for i in range(1, len(rows)) if length[i] != length[i - 1] or rows[i] != rows[i - 1]]
        for lo, hi in zip([0, *same], [*same, len(rows)], strict=True):
            if string is not None and rows[lo] != string:
                yield shard, string, np.concatenate(ids)
                ids = []
            string = rows[lo]
            ids.append(conv[lo:hi])
    if string is not None:
        yield shard, string, np.concatenate(ids)


def _spelled(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _build(batches):
    """Nodes inside a shard, and what its edges hand on."""
    found, ends, shard = [], {}, None
    for shard, string, ids in _groups(batches):
        if len(found) > 1:
            del ends[len(found) - 1]
        ends[len(found)] = ids
        found.append((string, int(ids.min()), len(ids), hashlib.sha256(_spelled(ids)).hexdigest()))
    if not found:
        return
    trie = Shard(found)
    inner = [v for v in trie.order if v not in trie.edge]
    for k in range(0, len(inner), 8192):
        part = inner[k : k + 8192]
        parent = [trie.parent[v] for v in part]
        on_edge = [p if p in trie.edge else -1 for p in parent]
        yield _batch(
            BUILT,
            node={
                "conv_id": [trie.smallest[v] for v in part],
                "depth": [trie.depth[v] for v in part],
                "parent_conv_id": [trie.smallest[p] if e < 0 else None for p, e in zip(parent, on_edge, strict=True)],
                "edge_shard": [shard if e >= 0 else None for e in on_edge],
                "edge_last": [trie.edge[e] if e >= 0 else None for e in on_edge],
                "edge_depth": [trie.depth[e] if e >= 0 else None for e in on_edge],
                "n_convs": [trie.members[v] for v in part],
                "n_children": [trie.children[v] for v in part],
                "n_leaves": [trie.leaves[v] for v in part],
                "saved_tokens": [trie.saved[v] for v in part],
                "ends_sha256": [trie.ends_sha[v] for v in part],
            },
        )
    part = 0
    for last in (False, True)[: min(2, len(found))]:
        nodes = trie.path(last)
        # What both paths share counts once.
        own = [trie.edge[v] == last for v in nodes]
        index = len(found) - 1 if last else 0
        take = lambda values: [values[v] if mine else 0 for v, mine in zip(nodes, own, strict=True)]  # noqa: B023, E731
        string, ids = found[index][0], ends[index]
        for k in range(0, len(ids), PIECE_IDS):
            lead = k == 0
            yield _batch(
                BUILT,
                path={
                    "shard": [shard],
                    "part": [part],
                    "last": [last],
                    "string": [string if lead else None],
                    "members": [take(trie.members) if lead else []],
                    "smallest": [[trie.smallest[v] for v in nodes] if lead else []],
                    "children": [take(trie.children) if lead else []],
                    "leaves": [take(trie.leaves) if lead else []],
                    "saved": [take(trie.saved) if lead else []],
                    # Strings that end on the path before the edge lie whole in the shard.
                    "ends": [[trie.ends_sha[v] if mine and v != nodes[-1] else None for v, mine in zip(nodes, own, strict=True)] if lead else []],
                    "ids": [_spelled(ids[k : k + PIECE_IDS])],
                },
            )
            part += 1


BUILT = {"node": NODE, "path": PATH}
JOINED = {"merged": MERGED, "place": PLACE}
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>"}


def _ddl(kinds: dict[str, dict]) -> str:
    return ", ".join(f"{kind} struct<{', '.join(f'{n}: {_SQL[t]}' for n, t in fields.items())}>" for kind, fields in kinds.items())


def _batch(kinds: dict[str, dict], **given: dict[str, list]) -> pa.RecordBatch:
    """Rows of one kind; the columns of the other kinds are null."""
    ((kind, values),) = given.items()
    rows = len(next(iter(values.values())))
    columns = []
    for name, fields in kinds.items():
        if name == kind:
            columns.append(pa.StructArray.from_arrays([pa.array(values[n], t) for n, t in fields.items()], fields=[pa.field(n, t) for n, t in fields.items()]))
        else:
            columns.append(pa.nulls(rows, pa.struct(list(fields.items()))))
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


class _Open:
    """A merged node that is still on the stack."""

    def __init__(self, node_id: int, key: bytes):
        self.node_id, self.key = node_id, key
        self.members, self.smallest, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends, self.ended, self.whole = hashlib.sha256(), False, None

    def row(self, depth: int, parent: _Open | None) -> tuple:
        """The finished node; its parent takes what it adds up to."""
        words = int.from_bytes(self.key[16:], "big")
        leaves = self.leaves if self.children else 1
        saved = self.saved + (self.members - 1) * words
        if parent:
            parent.children += 1
            parent.leaves += leaves
            parent.saved += saved
        return (self.node_id, parent and parent.node_id, self.smallest, depth, self.members, self.children, leaves, saved, self.whole or self.ends.hexdigest())


def _merge(batches):
    """Edge paths in the order of their strings: merged nodes and their places."""
    stack: list[_Open] = []
    merged, places, made = [], [], 0

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            merged.append(node.row(len(stack), stack[-1] if stack else None))

    def flush():
        if merged:
            yield _batch(JOINED, merged=dict(zip(MERGED, map(list, zip(*merged, strict=True)), strict=True)))
        if places:
            yield _batch(JOINED, place=dict(zip(PLACE, map(list, zip(*places, strict=True)), strict=True)))
        merged.clear()
        places.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if row["string"] is not None:
                string = row["string"]
                keys = [b"", *(string[k : k + KEY_BYTES] for k in range(0, len(string), KEY_BYTES))]
                kept = next((d for d, (node, key) in enumerate(zip(stack, keys, strict=False)) if node.key != key), min(len(stack), len(keys)))
                close(kept)
                for key in keys[kept:]:
                    stack.append(_Open(made, key))
                    made += 1
                for depth, (node, *adds) in enumerate(zip(stack, *(row[k] for k in _LISTS), row["ends"], strict=True)):
                    members, smallest, children, leaves, saved, ends = adds
                    node.members += members
                    node.children += children
                    node.leaves += leaves
                    node.saved += saved
                    node.smallest = smallest if node.smallest is None else min(node.smallest, smallest)
                    if ends not in (None, NO_ENDS):
                        node.whole = ends
                    places.append((row["shard"], row["last"], depth, node.node_id))
            end = stack[-1]
            end.ends.update(b"," + row["ids"] if end.ended else row["ids"])
            end.ended = True
            if len(merged) + len(places) > 8192:
                yield from flush()
    close(0)
    yield from flush()


def trie(sequences: DataFrame) -> DataFrame:
    """A row per node of the trie over (conv_id, keys): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    string = F.unhex(F.array_join(F.transform("keys", F.hex), "")).alias("string")
    # Range bounds are sampled, so the strings are settled first.
    rows = sequences.select(F.col("conv_id").cast("bigint").alias("conv_id"), string).checkpoint()
    turns = rows.agg(F.sum(F.length("string"))).first()[0] or 0
    shards = 1 + turns // (KEY_BYTES * SHARD_TURNS)
    ranged = rows.repartitionByRange(max(shards, rows.sparkSession.sparkContext.defaultParallelism), "string", "conv_id")
    ranged = ranged.sortWithinPartitions("string", "conv_id").withColumn("shard", F.spark_partition_id())
    built = ranged.mapInArrow(_build, _ddl(BUILT)).checkpoint()
    edges = built.where(F.col("path").isNotNull()).select("path.*")
    # One pass in order; it reads two paths a shard.
    joined = edges.repartition(1).sortWithinPartitions("shard", "part").mapInArrow(_merge, _ddl(JOINED)).checkpoint()
    merged = joined.where(F.col("merged").isNotNull()).select("merged.*")
    conv = merged.select(F.col("node_id").alias("at"), F.col("conv_id").alias("at_conv"))
    places = joined.where(F.col("place").isNotNull()).select("place.*").join(conv, F.col("node_id") == F.col("at")).drop("node_id", "at")
    node = built.where(F.col("node").isNotNull()).select("node.*")
    hanging = node.where(F.col("edge_shard").isNotNull()).join(places, list(_EDGE))
    head = ["conv_id", "depth"]
    return (
        node.where(F.col("edge_shard").isNull())
        .select(*head, "parent_conv_id", *_COUNTS)
        .unionByName(hanging.select(*head, F.col("at_conv").alias("parent_conv_id"), *_COUNTS))
        .unionByName(merged.join(conv, F.col("parent_id") == F.col("at"), "left").select(*head, F.col("at_conv").alias("parent_conv_id"), *_COUNTS))
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations given as rows (conv_id, turn, role, text)."""
    return trie(strings(conversations))
