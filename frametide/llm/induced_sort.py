"""Suffix arrays by induced sorting and permuted common prefixes. Buckets are
walked a slice at a time where they are large, else suffix by suffix."""

from __future__ import annotations

import numpy as np

#: Below this mean size of a bucket its suffixes are walked one by one: array calls would cost more.
SLICE = 256


def types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type)."""
    n = len(t)
    step = np.sign(np.diff(t, append=-1).astype(np.int64))
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # first place from i on where neighbours differ
    s = step[np.minimum(following, n - 1)] > 0
    s[n - 1] = True
    return s


def induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix order that the given order of LMS suffixes induces.

    L-type suffixes are placed at bucket heads in one walk up the buckets,
    S-type at bucket tails in one walk down. A walk takes all suffixes that
    lie ready in a bucket at once; equal letters need another round."""
    n = len(t)
    if n < SLICE * k:
        return _induce_each(t, s, lms, k)
    sa = np.full(n, -1, np.int64)
    count = np.bincount(t, minlength=k)
    end = np.cumsum(count)
    start = end - count
    buckets = np.flatnonzero(count)

    head = start.copy()
    lms_letter = t[lms]
    lms_at = np.searchsorted(lms_letter, np.arange(k + 1))

    def place_up(of):
        p = of[of > 0] - 1
        p = p[~s[p]]
        c = t[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        first = np.flatnonzero(np.diff(c, prepend=-1))
        size = np.diff(first, append=len(c))
        sa[head[c] + np.arange(len(c)) - np.repeat(first, size)] = p
        head[c[first]] += size

    for c in buckets.tolist():
        at = start[c]
        while at < head[c]:
            ready, at = sa[at : head[c]], head[c]
            place_up(ready)
        if lms_at[c] < lms_at[c + 1]:
            place_up(lms[lms_at[c] : lms_at[c + 1]])

    tail = end.copy()

    def place_down(of):
        of = of[::-1]
        p = of[of > 0] - 1
        p = p[s[p]]
        c = t[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        first = np.flatnonzero(np.diff(c, prepend=-1))
        size = np.diff(first, append=len(c))
        sa[tail[c] - 1 - np.arange(len(c)) + np.repeat(first, size)] = p
        tail[c[first]] -= size

    sa[0] = n - 1
    tail[t[n - 1]] -= 1
    for c in buckets[::-1].tolist():
        at = end[c]
        while at > tail[c]:
            ready, at = sa[tail[c] : at], tail[c]
            place_down(ready)
        if head[c] > start[c]:
            place_down(sa[start[c] : head[c]])
    return sa


def _induce_each(t: np.ndarray, s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """``induce``, suffix by suffix."""
    last = np.cumsum(np.bincount(t, minlength=k))
    head, tail = np.concatenate([[0], last[:-1]]).tolist(), last.tolist()
    letters, ascending = t.tolist(), s.tolist()
    sa = [0] * len(letters)
    for i in lms[::-1].tolist():
        c = letters[i]
        tail[c] -= 1
        sa[tail[c]] = i
    for i in range(len(sa)):
        j = sa[i] - 1
        if j >= 0 and not ascending[j]:
            c = letters[j]
            sa[head[c]] = j
            head[c] += 1
    tail = last.tolist()
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and ascending[j]:
            c = letters[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return np.array(sa, np.int64)


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of every LMS substring, in the order ``ordered``; equal ones share it."""
    n = len(t)
    stop = np.append(lms[1:], n - 1)
    place = np.full(n, -1, np.int64)
    place[lms] = np.arange(len(lms))
    size = (stop - lms)[place[ordered]]
    new = np.ones(len(ordered), bool)
    i = np.flatnonzero(size[1:] == size[:-1]) + 1
    a, b, left, k = ordered[i - 1], ordered[i], size[i], 0
    while len(i):
        same = t[a + k] == t[b + k]
        done = same & (left == k)
        new[i[done]] = False
        go = same & ~done
        i, a, b, left, k = i[go], a[go], b[go], left[go], k + 1
    return np.cumsum(new) - 1


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of ``t``, whose letters are below ``k``.

    ``t`` ends with the only 0. LMS substrings are sorted by induction and
    named; names that repeat are sorted recursively, and the order of all
    suffixes is induced from that of the LMS suffixes."""
    n = len(t)
    if n < 3:
        return np.arange(n)[::-1].copy()
    if k < 1 << 15:
        t = t.astype(np.int16)  # letters sort by radix
    s = types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    by_letter = lms[np.argsort(t[lms], kind="stable")]
    sa = induce(t, s, by_letter, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    name = _names(t, lms, ordered)
    if name[-1] + 1 < len(lms):
        place = np.empty(n, np.int64)
        place[ordered] = name
        ordered = lms[suffix_array(place[lms], int(name[-1]) + 1)]
    return induce(t, s, ordered, k)


def common_prefixes(t: np.ndarray, sa: np.ndarray, breaks: np.ndarray, cap: int) -> np.ndarray:
    """PLCP: for each place, the letters it shares with the suffix before it in
    the array, up to ``cap`` at the places where counting starts.

    Where the predecessor moves along with the place, the prefix is one letter
    shorter; only other places, and those in ``breaks``, are compared."""
    n = len(t)
    phi = np.empty(n, np.int64)
    phi[sa[1:]] = sa[:-1]
    phi[sa[0]] = -1
    start = np.ones(n, bool)
    start[1:] = (phi[1:] != phi[:-1] + 1) | (t[:-1] != t[phi[:-1]])
    start[breaks] = True
    start |= phi < 0
    # Four letters at a time while they agree, then letter by letter.
    padded = np.concatenate([t, -1 - np.arange(cap + 8) % 2]).astype(np.int16)
    four = np.lib.stride_tricks.sliding_window_view(padded, 4).copy().view(np.int64).reshape(-1)
    at = np.flatnonzero(start & (phi >= 0))
    j, k = phi[at], 0
    length = np.zeros(n, np.int64)
    tail_at, tail_j, tail_k = [at[:0]], [at[:0]], [at[:0]]
    while len(at) and k < cap:
        same = (four[at + k] == four[j + k]) & (np.maximum(at, j) + k + 4 <= n)
        tail_at.append(at[~same])
        tail_j.append(j[~same])
        tail_k.append(np.full(len(tail_at[-1]), k))
        at, j, k = at[same], j[same], k + 4
    length[at] = cap
    at, j, k = map(np.concatenate, (tail_at, tail_j, tail_k))
    for step in range(4):
        same = (np.maximum(at, j) + k < n) & (padded[at + k] == padded[j + k])
        length[at[~same]] = k[~same]
        at, j, k = at[same], j[same], k[same] + 1
    length[at] = k
    first = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    return np.maximum(length[first] - (np.arange(n) - first), 0)
