"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in lower case with runs of blanks as one space.
An item with an error budget of k edits is split into k + 1 pieces: a passage
within k edits holds one of them unchanged. Aho-Corasick finds all pieces in
one walk over a text, and Myers' bit-parallel distance verifies each place.
An item of under EDITABLE characters has no budget and counts where it stands
between word boundaries.

Defined cases: null, blank and empty texts and items match nothing; equal items
or rows each give their own pairs; ids may be null; of equally near places the
first counts. Texts are searched whole. Items are searched in blocks
of bounded size, one walk over the documents per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from frametide.llm.common import typed

#: One edit is allowed per so many characters of an item.
CHARS_PER_EDIT = 20
#: Shorter items are searched word for word.
EDITABLE = 24
#: Characters of items that a task holds at once.
BLOCK_CHARS = 1_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str) -> int:
    return len(item) // CHARS_PER_EDIT if len(item) >= EDITABLE else 0


def bounded(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] neither starts nor ends inside a word."""
    return not (start and text[start - 1 : start + 1].isalnum()) and not (end < len(text) and text[end - 1 : end + 1].isalnum())


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 parts of near-equal length."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the whole pattern to a part of ``text`` and the
    first end of such a part. ``anchored``: the part starts at the text's start."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 | anchored
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds every item of a list in texts."""

    def __init__(self, items: list[tuple]):
        self.items = [(i, normal(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        at: dict[str, list] = {}
        for n, (_, item) in enumerate(self.items):
            for offset, piece in pieces(item):
                at.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple]:
        """(item id, distance, start, end) of the best place of every item
        found; places count in the normalised text."""
        if not self.items:
            return []
        text = normal(text)
        starts: dict[int, set] = {}
        for end, (size, places) in self.automaton.iter(text):
            for n, offset in places:
                starts.setdefault(n, set()).add(end + 1 - size - offset)
        out = []
        for n, at in starts.items():
            item_id, item = self.items[n]
            if len(item) < EDITABLE:
                whole = min((s for s in at if bounded(text, s, s + len(item))), default=None)
                if whole is not None:
                    out.append((item_id, 0, whole, whole + len(item)))
                continue
            k, best, reached = budget(item), None, None
            for start in sorted(at):
                # Windows of close starts overlap: one walk covers them.
                if reached is not None and start <= reached:
                    continue
                reached = start
                while (further := [x for x in range(reached + 1, reached + k + 2) if x in at]):
                    reached = further[-1]
                lo = max(0, start - k)
                window = text[lo : reached + len(item) + k]
                distance, end = myers(item, window)
                if distance <= k and (best is None or distance < best[0]):
                    _, size = myers(item[::-1], window[:end][::-1], anchored=True)
                    best = (distance, lo + end - size, lo + end)
                    if not distance:
                        break
            if best:
                out.append((item_id, *best))
        return out


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """``benchmark`` in parts whose texts stay within ``block_chars`` (expected, by hash)."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-total // block_chars) or 1
    if n == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.where(part == i) for i in range(n)]


def _pairs(items, item_type):
    def run(batches):
        matcher = Matcher(items)
        for batch in batches:
            rows, hits = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for hit in matcher.find(text):
                    rows.append(i)
                    hits.append(hit)
            cols = list(zip(*hits, strict=True)) or [[]] * 4
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.record_batch([ids, pa.array(cols[0], item_type), *[pa.array(c, pa.int64()) for c in cols[1:]]], ["doc_id", "item_id", "distance", "start", "end"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start, end for every document and item that
    it holds within the item's error budget."""
    id_type = benchmark.schema["item_id"].dataType
    schema = typed(docs, ["doc_id"], "distance bigint, start bigint, end bigint")
    schema = T.StructType([schema["doc_id"], T.StructField("item_id", id_type), *schema.fields[1:]])
    out = None
    for block in item_blocks(benchmark, block_chars):
        items = [(r["item_id"], r["text"]) for r in block.select("item_id", "text").collect()]
        part = docs.select("doc_id", "text").mapInArrow(_pairs(items, to_arrow_type(id_type)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item: a filter per block of items."""
    for block in item_blocks(benchmark, block_chars):
        items = [(r["item_id"], r["text"]) for r in block.select("item_id", "text").collect()]
        docs = docs.where(~_leaky(items)(F.col("text")))
    return docs


def _leaky(items):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items)
        for batch in batches:
            yield pd.Series([bool(matcher.find(t)) for t in batch], dtype=bool)

    return F.pandas_udf(run, "boolean")
