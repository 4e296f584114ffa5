"""Periodic runs of words by Baier grouping.

The first phase of Baier's suffix sorter refines groups of suffixes, from the
largest group down, until every suffix lies with those that share its longest
Lyndon prefix. The length of that prefix is the Lyndon array, so the phase is
run twice, under the order of words and under the reverse one. Each run of
words has its Lyndon root in one of the two arrays. Copies of a root that
follow each other lie in one group at the root's distance, which gives the
inside of a run without comparing a word; longest common extensions from the
first and the last copy give its two ends.

A word of a run of exponent e occurs at least floor(e) times in it, so words
that are rarer cut a text into stretches that hold its runs whole, again and
again until nothing more falls away. What is left is grouped.

Defined cases: words are runs of bytes outside space, \\t, \\n, \\v, \\f and \\r;
null, empty and blank texts have no words and no run; texts of any length are
taken whole, each by one task; rows are judged one by one, so repeated rows and
null ids give rows of their own; an empty table gives no rows. The result's
columns are those asked for and ``runs``, a struct, so that names don't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import groupby
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import BLANKS, fresh, let, typed, word_array

#: A run has this many words at least, and this many times its period.
MIN_WORDS = 6
MIN_EXPONENT = 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RUNS = f"struct<n_words:bigint,found:array<{RUN}>,best:{RUN},collapsed:string>"


def lyndon_groups(codes: Sequence[int]) -> tuple[list[int], list[int]]:
    """(length, group) of the longest Lyndon prefix of every suffix of ``codes``;
    equal prefixes share a group. The end of the sequence is below every code.

    Groups are taken from the highest down. A suffix's predecessor is the
    nearest one before it that lies in a lower group, that is one not yet taken;
    a predecessor to which k suffixes of the group point is followed by k copies
    of the group's prefix, so it moves to a new group, right above its old one
    and above the groups of smaller k, whose prefix is longer by these copies."""
    n = len(codes)
    members: list[list[int]] = []
    width: list[int] = []
    at: dict[int, int] = {}
    for c in sorted(set(codes)):
        at[c] = len(members)
        members.append([])
        width.append(1)
    group = [at[c] for c in codes]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    before = list(range(-1, n - 1))  # nearest places not yet taken
    after = list(range(1, n + 1))
    length = [0] * n
    now = len(members) - 1
    while now >= 0:
        size, pointed = width[now], []
        for i in members[now]:
            if group[i] != now:
                continue  # moved on
            length[i] = size
            left, right = before[i], after[i]
            if right < n:
                before[right] = left
            if left >= 0:
                after[left] = right
                pointed.append(left)
        if pointed:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, hits in groupby(pointed):
                moved.setdefault((group[j], sum(1 for _ in hits)), []).append(j)
            last = place = -1
            for (old, copies), of in sorted(moved.items()):
                new = len(members)
                members.append(of)
                width.append(width[old] + copies * size)
                for j in of:
                    group[j] = new
                # Right above the old group, or above its part with fewer copies.
                place = place if old == last else old
                below.append(place)
                above.append(above[place])
                if above[place] >= 0:
                    below[above[place]] = new
                above[place] = new
                last, place = old, new
        now = below[now]
    return length, group


def _match(a: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """Longest common extension of two places, forwards or (``step`` -1) backwards."""
    done, block = 0, 16
    while done < most:
        block = min(block, most - done)
        x, y = (a[k + done * step : k + (done + block) * step : step] if step > 0 else a[k - done - block + 1 : k - done + 1][::-1] for k in (i, j))
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done, block = done + block, 2 * block
    return done


def runs_of(codes: np.ndarray, min_words: int, min_exponent: Fraction) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of ``codes`` that is long enough."""
    n = len(codes)
    found = set()
    # A run holds floor(exponent) - 1 copies of its root whole, wherever the first one starts.
    copies = max(1, floor(min_exponent) - 1)
    for order in (codes, -codes):
        length, group = map(np.array, lyndon_groups(order.tolist()))
        at = np.arange(n)
        follower = np.minimum(at + length, n - 1)
        again = (at + length < n) & (group[follower] == group)
        first = np.ones(n, bool)
        first[follower[again]] = False  # a copy of the same root lies right before it
        for s in np.flatnonzero(first & (again | (copies == 1))).tolist():
            p, e, chain = int(length[s]), s, 1
            while again[e]:
                e, chain = e + p, chain + 1
            if chain < copies:
                continue
            end = e + p  # past the last copy
            left = _match(codes, s - 1, s + p - 1, min(p, s), -1)
            right = _match(codes, e, end, min(p, n - end), 1)
            size = end + right - (s - left)
            if size >= min_words and size >= min_exponent * p:
                found.add((s - left, size, p))
    return found


def _stretches(codes: np.ndarray, least: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Maximal stretches in which every word occurs ``least`` times or more."""
    places = np.arange(len(codes))
    of = np.zeros(len(codes), np.int64)
    while len(places):
        _, key, count = np.unique(of * (int(codes.max()) + 1) + codes, return_inverse=True, return_counts=True)
        keep = count[key] >= least
        dropped = not keep.all()
        places, codes, of = places[keep], codes[keep], of[keep]
        if not len(places):
            return
        cut = (np.diff(places, prepend=places[0]) > 1) | (np.diff(of, prepend=of[0]) != 0)
        of = np.cumsum(cut)
        size = np.bincount(of)
        keep = size[of] >= shortest
        if not dropped and keep.all():
            edges = np.flatnonzero(np.diff(of, prepend=-1))
            for s, m in zip(places[edges].tolist(), np.diff(edges, append=len(places)).tolist(), strict=True):
                yield s, s + m
            return
        places, codes, of = places[keep], codes[keep], of[keep]


def find(words: list[bytes], min_words: int, min_exponent: Fraction) -> list[tuple[int, int, int]]:
    """Runs of a text's words by start, then period."""
    least = max(1, floor(min_exponent))
    count = Counter(words)
    if not words or max(count.values()) < least:
        return []
    code = {w: i for i, w in enumerate(count)}
    codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
    found = []
    for s, e in _stretches(codes, least, min_words):
        found += [(s + i, size, p) for i, size, p in runs_of(codes[s:e], min_words, min_exponent)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words outside every run's repeats, joined by a space."""
    if not found:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, size, p in found:
        edge[s + p] += 1
        edge[s + size] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def periodic_runs(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id",),
    text: Column | None = None,
    min_words: int = MIN_WORDS,
    min_exponent: Fraction | int | str = MIN_EXPONENT,
) -> DataFrame:
    """``columns`` of ``docs`` and ``runs``: n_words, found (start, length and
    period of every run of ``min_words`` words and ``min_exponent`` periods at
    least, by start, then period), best (the run of the greatest exponent; ties:
    smallest start, then period; null without a run) and collapsed (the words
    that no run repeats, joined by a space). ``text``: the column ``text``."""
    exponent = Fraction(min_exponent)
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    body, out = fresh(docs, "_text"), fresh(docs, "runs")
    source = docs.select(*columns, (F.col("text") if text is None else text).cast("string").alias(body))
    result = typed(source, list(columns), f"{out} {RUNS}")
    shape = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    fields = [("n_words", pa.int64()), ("found", pa.list_(shape)), ("best", shape), ("collapsed", pa.string())]

    def judge(batches):
        for batch in batches:
            rows = []
            for value in batch.column(len(columns)):
                words = (value.as_py() or "").encode().split()  # on the six blank bytes
                found = find(words, min_words, exponent)
                best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in found]
                rows.append({"n_words": len(words), "found": named, "best": best and dict(zip(("start", "length", "period"), best, strict=True)), "collapsed": _collapsed(words, found).decode()})
            runs = pa.array(rows, pa.struct(fields))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], runs], names=[*columns, out])

    return source.mapInArrow(judge, result)


def with_periodic_tail(doc_id: Column, text: Column) -> Column:
    """Text in which the words of a tenth of the documents, chosen and measured
    by crc32 of the id as text, become periodic from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        g = F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    return F.when((h % 10 == 0) & (F.length(F.btrim(text, F.lit(BLANKS))) > 0), let(word_array(text), repeat)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The runs of every document as numbers and hashes."""
    r, best = F.col("runs"), F.col("runs.best")
    lines = F.transform(r["found"], lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    spelled = F.when(F.size(r["found"]) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size(r["found"]).cast("bigint").alias("n_runs"),
        *[best[k].alias(k) for k in ("start", "length", "period")],
        F.expr("1000 * runs.best.length div runs.best.period").alias("exponent_milli"),
        F.sha2(spelled.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(r["collapsed"].cast("binary"), 256).alias("collapsed_sha256"),
    )
