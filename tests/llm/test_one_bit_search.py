"""One-bit search against exact inner products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from frametide.llm import one_bit_search as ob
from frametide.llm.common import start


def plain(rows, k=20, dim=None):
    """Brute force in plain Python: {query: [(vec_id, score), ...]}."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    good = [(i, v) for i, v in good if dim is None or len(v) == dim]
    out = {}
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        asked = min(v for i, v in good if i == q)
        scored = []
        for i, v in good:
            if i != q:
                total = 0.0
                for a, b in zip(asked, v, strict=True):
                    total += a * b
                scored.append((-total, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def searched(df, k=20):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def clustered(seed, n, dim, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, dim))
    v = centres[rng.integers(0, 7, n)] + spread * rng.standard_normal((n, dim))
    return [(i, [float(x) for x in np.float32(row)]) for i, row in enumerate(v)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    v = np.array([x for _, x in clustered(5, 3000, 48)])
    index = ob.fit(v[:500], 4, 1)
    batch = next(ob._encode(index)(iter([_rows(v)])))
    cells = batch.column(1).to_numpy()
    take = lambda name, kind: np.array([np.frombuffer(b, kind) for b in batch[name].to_pylist()])
    q = v[:40] + 0.1 * rng.standard_normal((40, 48))
    bar = np.sort(q @ v.T, axis=1)[:, -20]
    near = kept = candidates = 0
    for cell in np.unique(cells):
        at = np.flatnonzero(cells == cell)
        block = {"code": take("code", np.uint8)[at]} | {k: batch[k].to_numpy()[at] for k in ("size", "along", "own")}
        above = ob._above(index, cell, block, q, bar) >= 0
        true = q @ v[at].T >= bar[:, None]
        near += true.sum()
        kept += (true & above).sum()
        candidates += above.sum()
    assert near == 40 * 20 and kept >= 0.97 * near
    assert candidates < 0.2 * 40 * 3000  # a cluster is a seventh


def _rows(v):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v.tolist(), pa.list_(pa.float64()))], names=["id", "v"])


@pytest.mark.parametrize("kind,dim", [("float", 32), ("double", 5), ("double", 1)])
def test_search_equals_brute_force(spark, kind, dim, monkeypatch):
    start(spark)
    monkeypatch.setattr(ob, "BLOCK_ROWS", 100)
    monkeypatch.setattr(ob, "PACK_ROWS", 16)
    rows = clustered(dim, 900, dim)
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], f"vec_id bigint, embedding array<{kind}>, v string, cell int")
    got, want = searched(ob.nearest(df, F.col("id") % 20 == 0)), plain(rows)
    assert got.keys() == want.keys()
    assert all(len(hits) == 20 for hits in got.values())
    same = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert same >= 0.97 * 20 * len(want)
    for q, hits in got.items():
        exact = dict(plain(rows, len(rows))[q]) if q < 100 else {}
        assert all(s == pytest.approx(exact[i], rel=1e-12) for i, s in hits if exact)
        assert [(-s, i) for i, s in hits] == sorted((-s, i) for i, s in hits)


def test_copies_ties_and_rows_that_take_no_part(spark):
    start(spark)
    base = clustered(3, 130, 8)
    hot = [(1000 + i, base[5][1]) for i in range(700)]  # one vector in most rows
    nan, inf = float("nan"), float("inf")
    bad = [(2000, None), (2001, []), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [nan] + [1.0] * 7), (2080, [inf] + [1.0] * 7), (2100, [1.0] * 7), (None, [1.0] * 8)]
    again = [(20, base[3][1]), (20, base[20][1]), (7, base[7][1])]
    rows = base + hot + bad + again
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got, want = searched(ob.nearest(df, F.col("id") % 20 == 0)), plain(rows, dim=8)
    assert got.keys() == want.keys()
    found = 0
    for q, hits in want.items():
        assert len(got[q]) == 20
        assert sum(i >= 1000 for i, _ in got[q]) == sum(i >= 1000 for i, _ in hits)  # copies go by id
        found += len(set(got[q]) & set(hits)) if hits[0][0] >= 1000 else len({i for i, _ in got[q]} & {i for i, _ in hits})
    assert found >= 0.97 * 20 * len(want)


def test_few_rows_and_none(spark):
    start(spark)
    schema = "vec_id bigint, embedding array<double>"
    for rows in ([], [(20, [1.0, 2.0])], [(0, [1e200, 1.0]), (1, [1e-200, 0.0]), (20, [-1.0, 0.5])], [(1, [0.0])]):
        got = searched(ob.nearest(spark.createDataFrame(rows, schema), F.col("id") % 20 == 0))
        assert got == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in plain(rows).items() if v}
