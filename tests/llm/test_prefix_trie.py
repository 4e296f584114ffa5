"""The conversation trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from frametide.llm import prefix_trie as pt
from frametide.llm.common import start

SCHEMA = "conv_id bigint, turn bigint, role string, text string, string string, depth int"


def conversations(rows):
    out = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out[c].append((role or "", text or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def nodes(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len([w for w in re.split(r"[\x20\x09-\x0D]+", p[-1][1]) if w]) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        yield (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())


def hostile(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        hot = rng.random() < 0.4  # one large group of equal conversations
        size = 3 if hot else rng.randrange(0, 7)
        turns = list(range(size)) if rng.random() < 0.9 else [None, *range(size - 1)] if size else []
        for k, turn in enumerate(turns):
            role = rng.choice(["user", "assistant", None]) if not hot else "user"
            text = f"turn {k}" if hot or rng.random() < 0.5 else rng.choice([None, "", " \t", "a b  c\nd", "é", "x" * 3])
            rows.append((c, turn, role, text))
    rows += [(None, 0, "user", "no id"), (500, 0, "user:1", "x"), (501, 0, "user", "1:x"), (501, 1, "user", "long " * 300_000)]
    rows += [(502, t, "user", f"deep {t % 7}") for t in range(3000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_by_definition(spark, seed):
    start(spark)
    rows = hostile(seed)
    plain = conversations(rows)
    df = frame(spark, rows)
    assert ordered(pt.prefix_trie(df).collect()) == ordered(nodes(plain))
    assert ordered(pt.trie(pt.rebuilt(pt.strings(df))).collect()) == ordered(nodes(rebuilt(plain)))


def test_every_conversation_alone_and_all_equal(spark, monkeypatch):
    """Shards of a single row: every node lies on an edge."""
    start(spark)
    monkeypatch.setattr(pt, "SHARD_TURNS", 1)
    same = [(c, t, "user", "same words here") for c in range(40) for t in range(2)]
    for rows in (same, hostile(3, 30), [(7, 0, None, None)], [(c, 0, "u", str(c)) for c in range(9)]):
        rows = [r for r in rows if r[0] is None or r[0] < 500]
        assert ordered(pt.prefix_trie(frame(spark, rows)).collect()) == ordered(nodes(conversations(rows)))


def test_pieces_of_one_edge(spark, monkeypatch):
    start(spark)
    monkeypatch.setattr(pt, "PIECE_IDS", 3)
    rows = [(c, 0, "user", "same") for c in range(100)]
    batches = list(pt._build(iter([_batch(rows)])))
    assert len(batches) == 34 and sum(b.num_rows for b in pt._merge(iter([_paths(b) for b in batches]))) == 4


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([b"k" * 20] * len(rows)), pa.array([5] * len(rows), pa.int32())], names=["conv_id", "string", "shard"])


def _paths(batch):
    import pyarrow as pa

    return pa.RecordBatch.from_struct_array(batch.column(1))


def test_repeated_rows_ties_and_empty(spark):
    start(spark)
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (2, 0, "user", "same"), (2, 1, "user", "same")]
    assert ordered(pt.prefix_trie(frame(spark, rows)).collect()) == ordered(nodes(conversations(rows)))
    tied = [(1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    assert {(r["depth"], r["n_convs"]) for r in pt.prefix_trie(frame(spark, tied)).collect()} == {(0, 2), (1, 2), (2, 2)}
    assert pt.prefix_trie(frame(spark, []).limit(0)).collect() == []


def test_search_trees_are_balanced():
    found = [(i.to_bytes(16, "big") + b"\0\0\0\1", i, 1, "") for i in range(1023)]
    shard = pt.Shard(found)
    deepest, waiting = 0, [(shard.first[0], 1)]
    while waiting:
        node, depth = waiting.pop()
        deepest = max(deepest, depth)
        waiting += [(k, depth + 1) for k in (shard.low[node], shard.high[node]) if k >= 0]
    assert deepest == 10
