"""Periodic runs against the definition, on small hostile texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from frametide.llm import periodic_runs as pr
from frametide.llm.common import start


def lyndon_lengths(s):
    """Longest Lyndon word from every place, by its definition."""
    return [max(m for m in range(1, len(s) - i + 1) if all(s[i : i + m] < s[i + k : i + m] for k in range(1, m))) for i in range(len(s))]


def all_runs(s, min_words, exponent):
    found = set()
    for p in range(1, len(s)):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            size = j + p - i
            if j > i and size >= min_words and size >= exponent * p:
                piece = s[i : i + size]
                if p == next(q for q in range(1, p + 1) if piece[q:] == piece[:-q]):
                    found.add((i, size, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed, n):
    rng = random.Random(seed)
    for t in range(n):
        s = [rng.randrange(rng.choice([1, 2, 2, 3, 6])) for _ in range(rng.randrange(1, 34))]
        if t % 2:
            a, p = rng.randrange(len(s)), rng.randrange(1, 5)
            s = [s[a + (i - a) % p] if i >= a and a + p <= len(s) else c for i, c in enumerate(s)]
        yield s


def test_groups_are_the_longest_lyndon_prefixes():
    for s in sequences(1, 300):
        for order in (s, [-c for c in s]):
            length, group = pr.lyndon_groups(order)
            assert length == lyndon_lengths(order)
            prefix = [tuple(order[i : i + m]) for i, m in enumerate(length)]
            assert len(set(zip(group, prefix, strict=True))) == len(set(group)) == len(set(prefix))


@pytest.mark.parametrize("min_words,exponent", [(6, Fraction(4)), (1, Fraction(2)), (2, Fraction(3)), (5, Fraction(5, 2))])
def test_runs_by_definition(min_words, exponent):
    for s in sequences(2, 400):
        want = all_runs(s, min_words, exponent)
        assert sorted(pr.runs_of(np.array(s), min_words, exponent), key=lambda r: (r[0], r[2])) == want
        assert pr.find([b"%d" % c for c in s], min_words, exponent) == want


def expected(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = all_runs(words, 6, 4)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, size, p in runs for i in range(s + p, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def hostile():
    rng = random.Random(4)
    texts = [None, "", " \t\n\x0b", "one", "a b " * 9, "é é é é é é é", "x\x1cy x\x1cy\x85x " * 3, "a a a a a b b b b b b a a a a", "tie tie tie tie tie tie end end end end end end"]
    texts += [" ".join(f"w{c}" for c in s) for s in sequences(5, 120)]
    texts += [("long " * 60 + "  \r\n x y z " * 40) * 5]
    rows = [(i, t) for i, t in enumerate(texts)]
    hot = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(60)))) for i in hot[:80]]
    return rows + [(None, "n n n n n n n"), (2, "a b " * 9), (2, "a b " * 9)]


def test_query_by_definition(spark):
    start(spark)
    rows = hostile()
    docs = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], "doc_id bigint, text string, runs int, _text string")
    found = pr.periodic_runs(docs, text=pr.with_periodic_tail(docs["doc_id"], docs["text"]))
    assert found.columns == ["doc_id", "_runs"]
    got = pr.digests(found.withColumnRenamed("_runs", "runs")).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(i, t) for i, t in rows), key=key)
    assert any(r["n_runs"] > 1 for r in got) and any(r["doc_id"] is None and r["n_runs"] == 1 for r in got)


def test_empty_table_and_long_text(spark):
    start(spark)
    schema = "doc_id bigint, text string"
    assert pr.digests(pr.periodic_runs(spark.createDataFrame([], schema))).collect() == []
    text = " ".join(f"u{i % 4001}" for i in range(330_000))  # over a pass and a batch's share
    (row,) = pr.periodic_runs(spark.createDataFrame([(1, text)], schema)).collect()
    assert [tuple(r) for r in row["runs"]["found"]] == [(0, 330_000, 4001)]
    assert row["runs"]["collapsed"] == " ".join(f"u{i}" for i in range(4001))
