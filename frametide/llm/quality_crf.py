"""Quality classifier: a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and its neighbours';
the labels of a text's lines form a chain. Forward-backward marginals of
"good", weighted by line length, are the document's score.

Defined cases: null and empty texts are one empty line; ids may be null (never
held out, never learned from) or repeat; repeated labels count once (the
lowest); without usable labels every score is 0.5. Texts are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import crc_mod, flat_text, passes, typed

#: Labelled documents that the field is fitted on (expected number, by id hash); those of more lines than FIT_LINES aren't fitted on.
FIT_DOCS = 3000
FIT_LINES = 2000
STEPS = 200
RATE = 0.1
PENALTY = 1e-3

#: Byte classes: 0 other, 1 lower or non-ASCII, 2 upper, 3 digit, 4 blank, 5 symbol, 6 shout, 7 full stop or comma.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>@^~=_/\\{}[]+"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[[ord(c) for c in ".,;:"]] = 7
OWN = 11


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, line offsets per row, bytes per line)."""
    n = len(raw)
    cut = np.flatnonzero(raw == 10)
    # A line starts at every row start and after every \n; it ends before the next \n or row end.
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cut, "right") - 1])
    order = np.argsort(row, kind="stable")
    row = row[order]
    starts = np.concatenate([offsets[:-1], cut + 1])[order]
    at = np.searchsorted(row, np.arange(len(offsets)))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[at[1:] - 1] = offsets[1:]
    size = ends - starts
    kind = _CLASS[raw]
    share = np.zeros((len(starts), 8))
    word_start = np.zeros(n + 1, bool)
    if n:
        blank = (kind == 4) | (raw == 10)
        word_start[:n] = ~blank
        word_start[1:n] &= blank[:-1]
        word_start[starts[size > 0]] = ~blank[starts[size > 0]]
    for c in range(1, 8):
        sums = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int64)])
        share[:, c] = sums[ends] - sums[starts]
    words = np.concatenate([[0], np.cumsum(word_start[:n], dtype=np.int64)])
    words = words[ends] - words[starts]
    # Lines equal to another of the text, by a hash of content and length.
    weights = np.concatenate([[0], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _place(n), dtype=np.uint64)])
    digest = (weights[ends] - weights[starts]) * _place_inverse(n)[starts]
    twin = np.zeros(len(starts), bool)
    o = np.lexsort((digest, size, row))
    same = (row[o][1:] == row[o][:-1]) & (digest[o][1:] == digest[o][:-1]) & (size[o][1:] == size[o][:-1]) & (words[o][1:] > 0)
    twin[o[1:]] |= same
    twin[o[:-1]] |= same
    solid = np.maximum(size - share[:, 4], 1)
    x = np.stack(
        [
            share[:, 2] / solid,
            share[:, 3] / solid,
            share[:, 5] / solid,
            share[:, 6] / solid,
            share[:, 7] / solid,
            share[:, 1] / solid,
            np.log1p(size) / 5,
            np.minimum(solid / np.maximum(words, 1), 30) / 6,
            twin.astype(float),
            (size == 0).astype(float),
            (share[:, 5] > 0).astype(float),
        ],
        axis=1,
    )
    return x, at, size


_POWERS: dict = {}
_ODD = 0x9E3779B97F4A7C15


def _power(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n + 1:
        out = np.full(max(n + 1, 1 << 20), np.uint64(base))
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if len(out) > 1 << 24:
            return out
        _POWERS[base] = out
    return _POWERS[base]


def _place(n: int) -> np.ndarray:
    return _power(_ODD, n)[:n]


def _place_inverse(n: int) -> np.ndarray:
    return _power(pow(_ODD, -1, 1 << 64), n)


def with_neighbours(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A line's features, those of the lines before and after, and a constant."""
    n, f = x.shape
    out = np.zeros((n, 3 * f + 1))
    out[:, :f] = x
    first = np.zeros(n, bool)
    first[at[:-1][at[:-1] < at[1:]]] = True
    last = np.roll(first, -1)
    out[1:, f : 2 * f] = x[:-1]
    out[first, f : 2 * f] = 0
    out[:-1, 2 * f : 3 * f] = x[1:]
    out[last, 2 * f : 3 * f] = 0
    out[:, -1] = 1
    return out


@dataclass
class Field:
    """Weights of "good" per feature, and the chain's gain for equal neighbours."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    stay: np.ndarray

    def emissions(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return with_neighbours((x - self.mean) / self.scale, at) @ self.weights


def marginals(e: np.ndarray, at: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per line and expected (bad, bad), (good, good) neighbour pairs,
    by forward-backward over all chains at once, in log odds.

    ``e``: log odds of each line alone; ``stay``: log weights of two bad and
    of two good neighbours."""
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    start, size = at[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than t

    def step(z):
        # Message to the next line: log sum over this line's label, as log odds.
        return np.logaddexp(z + stay[1], 0) - np.logaddexp(z, stay[0])

    ahead, back = np.zeros(len(e)), np.zeros(len(e))
    for t in range(1, longest):
        i = start[: active[t]] + t
        ahead[i] = step(ahead[i - 1] + e[i - 1])
    for t in range(longest - 2, -1, -1):
        i = start[: active[t + 1]] + t
        back[i] = step(back[i + 1] + e[i + 1])
    z = np.clip(ahead + back + e, -50, 50)
    p = 1 / (1 + np.exp(-z))
    inner = np.ones(len(e), bool)
    inner[at[1:][np.diff(at) > 0] - 1] = False
    i = np.flatnonzero(inner)
    # Pair weights in logs, relative to (bad, good).
    l, r = ahead[i] + e[i], back[i + 1] + e[i + 1]
    w = np.stack([np.full(len(i), stay[0]), r, l, l + r + stay[1]])
    w -= w.max(axis=0)
    w = np.exp(w)
    w /= w.sum(axis=0)
    return p, np.array([w[0].sum(), w[3].sum()])


def fit_field(x: np.ndarray, at: np.ndarray, good: np.ndarray) -> Field:
    """Maximum likelihood with a small quadratic penalty, by Adam steps over
    the whole (bounded) sample. ``good``: the label of each chain's lines."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    f = with_neighbours((x - mean) / scale, at)
    y = np.repeat(good.astype(float), np.diff(at))
    inner = np.repeat(np.diff(at), np.diff(at)) > 1
    last = np.zeros(len(x), bool)
    last[at[1:][np.diff(at) > 0] - 1] = True
    pairs = np.array([((1 - y) * (inner & ~last)).sum(), (y * (inner & ~last)).sum()])
    theta = np.zeros(f.shape[1] + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    chains = max(1, len(at) - 1)
    for t in range(1, STEPS + 1):
        p, expected = marginals(f @ theta[:-2], at, theta[-2:])
        g = np.concatenate([f.T @ (y - p), pairs - expected]) / chains - PENALTY * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Field(mean, scale, theta[:-2], theta[-2:])


def _sample(batches):
    for batch in batches:
        raw, offsets = flat_text(batch.column("text"))
        rows, packed = [], []
        for a, b in passes(offsets):
            x, at, _ = line_features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for i in range(b - a):
                if at[i + 1] - at[i] <= FIT_LINES:
                    rows.append(a + i)
                    packed.append(x[at[i] : at[i + 1]].astype(np.float32).tobytes())
        keep = pa.array(rows, pa.int64())
        yield pa.record_batch([batch.column("doc_id").take(keep), batch.column("quality").take(keep), pa.array(packed, pa.binary())], ["doc_id", "quality", "lines"])


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Field | None:
    """The field fitted on about ``fit_docs`` labelled documents whose
    crc32(doc_id as text) mod 3 is not 1."""
    marks = labels.where(F.col("quality").isNotNull() & (crc_mod(F.col("doc_id"), 3) != 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    n = marks.count()
    if not n:
        return None
    share = int(min(1.0, fit_docs / n) * 1_000_000)
    marks = marks.where(F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1_000_000)) < share)
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").mapInArrow(_sample, typed(docs, ["doc_id"], "quality int, lines binary")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["lines"]))
    lines = [np.frombuffer(r["lines"], np.float32).reshape(-1, OWN) for r in rows]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    return fit_field(np.concatenate(lines).astype(float), at, np.array([r["quality"] > 0 for r in rows]))


def _score(field: Field | None):
    def run(batches):
        for batch in batches:
            raw, offsets = flat_text(batch.column("text"))
            score = np.full(len(offsets) - 1, 0.5)
            for a, b in passes(offsets) if field is not None else ():
                x, at, size = line_features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                p, _ = marginals(field.emissions(x, at), at, field.stay)
                weight = size + 1.0
                score[a:b] = np.add.reduceat(p * weight, at[:-1]) / np.add.reduceat(weight, at[:-1])
            score = np.clip(score, 0, 1)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select("doc_id", "text", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"))
    return rows.mapInArrow(_score(field), typed(docs, ["doc_id"], "held_out boolean, score double, predicted int"))
