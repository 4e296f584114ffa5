"""Language ID by nearest centroids of TF-IDF character n-gram vectors.

Byte trigrams of the folded text are hashed into DIM features, weighted
(1 + log tf) * idf and normalised. Each language is clustered into several
spherical centroids; a text goes to the centroid of highest cosine, and is
marked ``rejected`` when it is farther from it than training members are.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
ids may be null (never held out, never learned from) or repeat; ties go to the
language and cluster listed first; without labels every text is ``und``.
Texts are used whole, a long one in its own pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import crc_mod, flat_text, passes, typed

DIM = 4096
CLUSTERS = 3
ITERATIONS = 12
#: Labelled texts per language that centroids are fitted on (expected number, by id hash).
FIT_PER_LANG = 400
#: A text is rejected beyond this quantile of its centroid's members' distances, times SLACK.
QUANTILE, SLACK = 0.99, 1.2
UND = "und"
#: Rows whose DIM counts a task holds at once.
PASS_ROWS = 512

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def gram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (rows x DIM) of trigrams around every byte that isn't a blank;
    rows are bounded by blanks."""
    rows = len(offsets) - 1
    b = _FOLD[raw]
    accent = np.zeros(len(b), bool)
    accent[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
    b[accent] += 32  # capitals of the Latin-1 letters
    left, right = np.empty_like(b), np.empty_like(b)
    left[1:], right[:-1] = b[:-1], b[1:]
    full = offsets[1:] > offsets[:-1]
    left[offsets[:-1][full]] = 32
    right[offsets[1:][full] - 1] = 32
    code = left.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32) << np.uint32(8) | right
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - 12)
    row = np.repeat(np.arange(rows, dtype=np.int64) * DIM, np.diff(offsets))
    middle = b != 32
    return np.bincount(row[middle] + code[middle], minlength=rows * DIM).reshape(rows, DIM)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(counts.shape, np.float32)
    hit = counts > 0
    out[hit] = 1 + np.log(counts[hit])
    out *= idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def has_letter(raw: np.ndarray) -> bool:
    if _ASCII_LETTER[raw].any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))


def cluster(x: np.ndarray, k: int = CLUSTERS, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: (centroids, assignment)."""
    mean = x.mean(axis=0)
    seeds = [x[int(np.argmax(x @ mean))]]
    while len(seeds) < min(k, len(x)):
        near = np.max(x @ np.array(seeds).T, axis=1)
        seeds.append(x[int(np.argmin(near))])
    c = np.array(seeds)
    for _ in range(iterations):
        at = np.argmax(x @ c.T, axis=1)
        c = np.array([x[at == j].sum(axis=0) if (at == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, np.argmax(x @ c.T, axis=1)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray


def _vectors(batches):
    for batch in batches:
        raw, offsets = flat_text(batch.column("text"))
        packed = []
        for a, b in passes(offsets, most=PASS_ROWS):
            counts = gram_counts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            packed += [r.astype(np.int32).tobytes() for r in counts]
        yield pa.record_batch([batch.column("lang"), pa.array(packed, pa.binary())], ["lang", "counts"])


def _counts(table: pa.Table) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), np.int32) for x in table.column("counts")]).reshape(-1, DIM)


def _frequency(table: pa.Table) -> pa.Table:
    c = _counts(table)
    return pa.table({"n": [len(c)], "df": [(c > 0).sum(axis=0).astype(np.int64).tobytes()]})


def _clusters(idf):
    def run(table: pa.Table) -> pa.Table:
        x = weighted(_counts(table), idf)
        c, at = cluster(x)
        far = 1 - (x * c[at]).sum(axis=1)
        radius = [float(np.quantile(far[at == j], QUANTILE) * SLACK) if (at == j).any() else 0.0 for j in range(len(c))]
        return pa.table({"lang": [table.column("lang")[0].as_py()] * len(c), "cluster": list(range(len(c))), "centroid": [r.astype(np.float32).tobytes() for r in c], "radius": radius})

    return run


def fit(docs: DataFrame, fit_per_lang: int = FIT_PER_LANG) -> Model | None:
    """Centroids from about ``fit_per_lang`` labelled texts per language; each
    language is clustered by its own task. The model is a few rows of DIM
    floats per language."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2))
    n = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not n:
        return None
    cut = F.create_map(*[x for k, c in n.items() for x in (F.lit(k), F.lit(int(min(1.0, fit_per_lang / c) * (1 << 30))))])
    sample = known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < F.element_at(cut, F.col("lang")))
    rows = sample.select("text", "lang").mapInArrow(_vectors, "lang string, counts binary").checkpoint()
    parts = rows.groupBy("lang").applyInArrow(_frequency, "n bigint, df binary").collect()
    total = sum(r["n"] for r in parts)
    if not total:
        return None
    df = sum(np.frombuffer(r["df"], np.int64) for r in parts)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    found = rows.groupBy("lang").applyInArrow(_clusters(idf), "lang string, cluster bigint, centroid binary, radius double").orderBy("lang", "cluster").collect()
    return Model([r["lang"] for r in found], idf, np.array([np.frombuffer(r["centroid"], np.float32) for r in found]), np.array([r["radius"] for r in found]))


def _predict(model: Model | None):
    def run(batches):
        for batch in batches:
            raw, offsets = flat_text(batch.column("text"))
            lang, score, rejected = [], [], []
            for a, b in passes(offsets, most=PASS_ROWS):
                part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                if model is not None:
                    cos = weighted(gram_counts(part, at), model.idf) @ model.centroids.T
                    best = np.argmax(cos, axis=1)
                for i in range(b - a):
                    if model is None or not has_letter(part[at[i] : at[i + 1]]):
                        lang.append(UND)
                        score.append(0.0)
                        rejected.append(True)
                    else:
                        c = float(cos[i, best[i]])
                        lang.append(model.langs[best[i]])
                        score.append(min(1.0, max(0.0, c)))
                        rejected.append(1 - c > model.radius[best[i]])
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    rows = docs.select("doc_id", "text", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"))
    return rows.mapInArrow(_predict(model), typed(docs, ["doc_id"], "held_out boolean, lang_pred string, score double, rejected boolean"))
