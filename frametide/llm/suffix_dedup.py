"""Removal of repeated 100-byte strings with suffix arrays.

Every byte covered by a 100-byte string that also starts earlier (smaller
doc_id, or earlier in the document) goes. Four steps, all over whole texts:

1. Every window of 100 bytes has an anchor, the smallest hash among its
   32-byte grams (leftmost on ties), so equal windows have equal anchors at
   the same distance. Consecutive windows with one anchor are a piece.
2. Pieces meet by anchor. Equal pieces are aggregated to their first
   occurrence; the others repeat it. An anchor seen once, or with one content,
   needs nothing more.
3. Different pieces under one anchor share windows only in part (edges of a
   copy or passage, or a short common line in many contexts). They are cut
   once more by a second anchor, the smallest hash among the window's grams
   clear of the first, which spreads short common lines over their contexts.
   The texts that still share both anchors form shards; each shard's suffix
   array is built by induced sorting, permuted common prefixes of 100 or more
   bytes group equal windows, and all but the earliest of a group are repeats.
4. Repeats merge to runs per document.

Defined cases: null and empty texts are empty; rows without an id keep their
text and repeat nothing; rows that repeat a doc_id with one text are one document
(equal positions are the same string, and neither removes the other), with
different texts they are documents in the order of a hash of their texts; texts
under 100 bytes keep all bytes. Very long texts are cut into overlapping passes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import PASS_BYTES, flat_text, mixed, passes, random_table, release, typed
from frametide.llm.induced_sort import common_prefixes, suffix_array

WINDOW = 100
GRAM = 32
SPAN = WINDOW - GRAM + 1
SHARD_BYTES = 1 << 20
#: Bytes of text to a pair of buckets of anchors; their pieces take about as many.
BUCKET_BYTES = 256 << 20
#: Ids that have several texts are broadcast up to this many (8 bytes each).
BROADCAST_IDS = 1_000_000
_PLACE_BITS = np.uint64(21)
_BYTE = random_table(303)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, 1 << 20), np.uint64(base))
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


def _sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running polynomial sums, inverse powers, and the hashes of all grams."""
    n = len(raw)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
    return sums, down, mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])


def pieces(raw: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, piece hash, first window, last window) of the windows
    whose start is ``usable``; bytes of several rows may follow each other."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(raw) < WINDOW:
        return none
    sums, down, gram = _sums(raw)
    least = (gram >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while 2 * size <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < SPAN:
        least = np.minimum(least[: size - SPAN], least[SPAN - size :])
    anchor = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    at = np.flatnonzero(usable[: len(anchor)])
    if not len(at):
        return none
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = at[new]
    last = np.append(at[:-1][new[1:]], at[-1])
    where = anchor[first]
    content = (sums[last + WINDOW] - sums[first]) * down[first]
    whole = mixed(content ^ mixed(((where - first) << 16 | (last - first)).astype(np.uint64)))
    return gram[where], whole, first, last


def _row_pieces(batch):
    """(anchor, piece, doc_id, row, first, last) arrays of a batch; positions count in the document."""
    raw, offsets = flat_text(batch.column("text"))
    ids, rows = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "row"))
    for a, b in passes(offsets):
        if b - a == 1 and offsets[b] - offsets[a] > PASS_BYTES:
            whole = raw[offsets[a] : offsets[b]]
            for lo in range(0, len(whole) - WINDOW + 1, PASS_BYTES):
                part = whole[lo : lo + PASS_BYTES + WINDOW - 1]
                h, p, first, last = pieces(part, np.ones(len(part) - WINDOW + 1, bool))
                yield h, p, np.full(len(h), ids[a]), np.full(len(h), rows[a]), first + lo, last + lo
            continue
        part, at = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        usable = np.ones(len(part), bool)
        for end in at[1:]:
            usable[max(0, end - WINDOW + 1) : end] = False
        h, p, first, last = pieces(part, usable)
        own = np.searchsorted(at, first, "right") - 1
        yield h, p, ids[a + own], rows[a + own], first - at[own], last - at[own]


_COLUMNS = ("h", "p", "doc", "row", "first", "last")
_PACKED = "bucket int, repeat boolean, " + ", ".join(f"{c} binary" for c in _COLUMNS)


class _Owners:
    """The documents, (doc_id, row) in their order, that pieces belong to;
    ``of`` numbers them per piece."""

    def __init__(self, doc, row):
        order = np.lexsort((row, doc))
        doc, row = doc[order], row[order]
        new = np.ones(len(order), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.doc, self.row = doc[new], row[new]


def _rows_packed(row):
    """Bytes of ``row``; nothing where all are 0, as for ids of one text."""
    return row.tobytes() if row.any() else b""


def _owners(table: pa.Table) -> _Owners:
    doc = _join(table.column("doc"), np.int64)
    rows = [np.frombuffer(r.as_buffer(), np.int64) if len(r.as_buffer()) else np.zeros(len(d.as_buffer()) // 8, np.int64) for d, r in zip(table.column("doc"), table.column("row"), strict=True)]
    return _Owners(doc, np.concatenate(rows) if rows else np.zeros(0, np.int64))


def _repeats(h, p, doc, first):
    """True for pieces that follow an equal one (rows come ordered by h, p, doc, first)."""
    lead = np.ones(len(h), bool)
    lead[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    at = np.maximum.accumulate(np.where(lead, np.arange(len(h)), 0))
    return (doc > doc[at]) | ((doc == doc[at]) & (first > first[at])), lead


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of anchor hashes. Anchors are minima, so a third of them lie in the
    lowest hundredth of the hash range: they are hashed again before they are dealt."""
    return (((mixed(h ^ _DEALT) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


_DEALT = np.uint64(0xA0761D6478BD642F)


def _deal(buckets: int):
    """Pieces of a batch as packed arrays per bucket of the anchor hash. What
    repeats a piece of the batch is dealt by document, so that a piece that a
    third of all documents hold reaches its anchor's bucket once per batch."""

    def run(batches):
        for batch in batches:
            parts = list(zip(*_row_pieces(batch), strict=True))
            if not parts or not sum(map(len, parts[0])):
                continue
            h, p, doc, row, first, last = (np.concatenate(x) for x in parts)
            owner = _Owners(doc, row).of
            order = np.lexsort((first, owner, p, h))
            repeat = np.zeros(len(h), bool)
            repeat[order], _ = _repeats(h[order], p[order], owner[order], first[order])
            bucket = bucket_of(h, buckets)
            bucket[repeat] = buckets + mixed(doc[repeat].view(np.uint64)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            to = np.append(at[1:], len(bucket))
            data = [x[order] for x in (h, p, doc, row, first.astype(np.int32), (last - first).astype(np.int16))]
            cols = [[x[i:j].tobytes() for i, j in zip(at, to, strict=True)] for x in data]
            cols[3] = [_rows_packed(data[3][i:j]) for i, j in zip(at, to, strict=True)]
            again = bucket[at] >= buckets
            cols[0] = [b"" if r else x for r, x in zip(again, cols[0], strict=True)]
            cols[1] = [b"" if r else x for r, x in zip(again, cols[1], strict=True)]
            yield pa.record_batch([pa.array((bucket[at]).astype(np.int32)), pa.array(again), *[pa.array(c, pa.binary()) for c in cols]], ["bucket", "repeat", *_COLUMNS])

    return run


def _join(column, kind):
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _per_document(owner, *arrays):
    """(owner, packed arrays) with one row per document."""
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    to = np.append(at[1:], len(owner))[: len(at)]
    arrays = [x[order] for x in arrays]
    return owner[at], [[x[i:j].tobytes() for i, j in zip(at, to, strict=True)] for x in arrays]


def _found(owners, owner, a, b, need=None):
    """Rows (doc_id, row, sort, h, a, b): repeated windows a..b, or pieces that need sorting."""
    own, (pa_, pb) = _per_document(owner, a.astype(np.int32), b.astype(np.int32))
    of, sort, ph = [own], [np.zeros(len(own), bool)], [b""] * len(own)
    if need is not None:
        h, owner, a, b = need
        own, (qh, qa, qb) = _per_document(owner, h, a.astype(np.int32), b.astype(np.int32))
        of.append(own)
        sort.append(np.ones(len(own), bool))
        ph, pa_, pb = ph + qh, pa_ + qa, pb + qb
    of = np.concatenate(of)
    return pa.table(
        {
            "doc_id": pa.array(owners.doc[of], pa.int64()),
            "row": pa.array(owners.row[of], pa.int64()),
            "sort": pa.array(np.concatenate(sort), pa.bool_()),
            "h": pa.array(ph, pa.binary()),
            "a": pa.array(pa_, pa.binary()),
            "b": pa.array(pb, pa.binary()),
        }
    )


_FOUND = "doc_id bigint, row bigint, sort boolean, h binary, a binary, b binary"


def _meet(table: pa.Table) -> pa.Table:
    """Of a bucket's pieces: repeats of equal pieces, and first occurrences
    whose anchor has several contents."""
    owners = _owners(table)
    doc = owners.of
    first = _join(table.column("first"), np.int32).astype(np.int64)
    last = first + _join(table.column("last"), np.int16)
    if table.column("repeat")[0].as_py():
        return _found(owners, doc, first, last)
    h, p = _join(table.column("h"), np.uint64), _join(table.column("p"), np.uint64)
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(h), bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    h, p, doc, first, last = (x[shared] for x in (h, p, doc, first, last))
    order = np.lexsort((first, doc, p, h))
    h, p, doc, first, last = (x[order] for x in (h, p, doc, first, last))
    repeat, lead = _repeats(h, p, doc, first)
    anchor = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    contents = np.bincount(anchor, weights=lead)
    need = lead & (contents[anchor] > 1) if len(h) else lead
    return _found(owners, doc[repeat], first[repeat], last[repeat], (h[need], doc[need], first[need], last[need]))


def second_anchors(gram: np.ndarray, h: int, first: int, last: int) -> np.ndarray:
    """For the windows first..last under anchor ``h``: the smallest re-hashed
    gram that doesn't overlap the anchor. One side of it always has room."""
    at = first + int(np.argmax(gram[first : last + SPAN] == np.uint64(h)))
    count = last - first + 1
    out = np.full(count, np.uint64(2**64 - 1))
    if at - GRAM >= first:
        left = np.minimum.accumulate(mixed(gram[first : at - GRAM + 1] ^ _SECOND)[::-1])[::-1][:count]
        out[: len(left)] = left
    if last + SPAN - 1 >= at + GRAM:
        right = np.minimum.accumulate(mixed(gram[at + GRAM : last + SPAN] ^ _SECOND))[-count:]
        out[count - len(right) :] = np.minimum(out[count - len(right) :], right)
    return out


_SECOND = np.uint64(0x5851F42D4C957F2D)


def _cut(shards: int):
    """Pieces that need sorting, cut by their second anchors and packed with
    their texts per shard of both anchors."""

    def run(batches):
        for batch in batches:
            raw, offsets = flat_text(batch.column("text"))
            ids, rows = (batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("doc_id", "row"))
            out: dict[int, list] = {}
            for i, (hs, fs, ls) in enumerate(zip(batch.column("h"), batch.column("a"), batch.column("b"), strict=True)):
                h, first, last = _join(hs.values, np.uint64), _join(fs.values, np.int32), _join(ls.values, np.int32)
                text = raw[offsets[i] : offsets[i + 1]]
                ok = last + WINDOW <= len(text)
                if not ok.any():
                    continue
                _, _, gram = _sums(text)
                whole = text.tobytes()
                for x, f, t in zip(h[ok].tolist(), first[ok].tolist(), last[ok].tolist(), strict=True):
                    second = second_anchors(gram, x, f, t)
                    edge = [0, *(np.flatnonzero(second[1:] != second[:-1]) + 1).tolist(), t - f + 1]
                    for a, b in zip(edge, edge[1:], strict=False):
                        key = (int(second[a]) * 0x9E3779B97F4A7C15 ^ x) & (2**64 - 1)
                        out.setdefault((key >> 32) * shards >> 32, []).append((key, ids[i], rows[i], f + a, whole[f + a : f + b - 1 + WINDOW]))
            if out:
                kinds = (np.uint64, np.int64, np.int64, np.int32)
                cols = [[np.array([x[c] for x in v], kinds[c]).tobytes() for v in out.values()] for c in range(4)]
                cols[2] = [_rows_packed(np.array([x[2] for x in v], np.int64)) for v in out.values()]
                cols += [[np.array([len(x[4]) for x in v], np.int32).tobytes() for v in out.values()], [b"".join(x[4] for x in v) for v in out.values()]]
                yield pa.record_batch([pa.array(list(out), pa.int32()), *[pa.array(c, pa.binary()) for c in cols]], ["shard", "key", "doc", "row", "first", "size", "text"])

    return run


def repeated_windows(texts: np.ndarray, size: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True at the places of the concatenated pieces where a window starts
    that also starts at an earlier (document, position)."""
    count = len(size)
    begin = np.cumsum(size) - size + np.arange(count)
    t = np.ones(int(size.sum()) + count + 1, np.int64)
    piece = np.repeat(np.arange(count), size)
    inside = np.arange(len(piece)) + piece
    t[inside] = texts.astype(np.int64) + 2
    t[-1] = 0
    sa = suffix_array(t, 258)
    shared = common_prefixes(t, sa, begin, 4 * WINDOW) >= WINDOW
    window = np.zeros(len(t), bool)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(size) - size, size)
    window[inside] = offset <= np.repeat(size - WINDOW, size)
    # Groups of equal windows lie together in the array.
    rank = np.zeros(len(t), np.int64)
    where_doc, where_at = np.repeat(doc, size), np.repeat(first, size) + offset
    order = np.lexsort((where_at, where_doc))
    step = np.ones(len(order), np.int64)
    step[1:] = (where_doc[order][1:] != where_doc[order][:-1]) | (where_at[order][1:] != where_at[order][:-1])
    rank[inside[order]] = np.cumsum(step)
    group = np.cumsum(~shared[sa])
    keep = window[sa]
    place, group = sa[keep], group[keep]
    lead = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    earliest = np.minimum.reduceat(rank[place], np.flatnonzero(lead)) if len(place) else rank[:0]
    out = np.zeros(len(t), bool)
    out[place] = rank[place] > earliest[np.cumsum(lead) - 1]
    return out[inside]


def _sort(table: pa.Table) -> pa.Table:
    """Of a shard's pieces: repeats of equal pieces, and repeated windows of
    those that share both anchors with a different piece."""
    key = _join(table.column("key"), np.uint64)
    order = np.argsort(key, kind="stable")
    shared = np.zeros(len(key), bool)
    same = key[order][1:] == key[order][:-1]
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    owners = _owners(table)
    doc, first, size = owners.of, _join(table.column("first"), np.int32).astype(np.int64), _join(table.column("size"), np.int32).astype(np.int64)
    raw = b"".join(x.as_py() for x in table.column("text"))
    end = np.cumsum(size)
    pick = np.flatnonzero(shared)
    pick = pick[np.lexsort((first[pick], doc[pick]))]
    lead: dict = {}
    contents: dict[int, int] = {}
    again, alone = [], []
    for i, k, d, f in zip(pick.tolist(), key[pick].tolist(), doc[pick].tolist(), first[pick].tolist(), strict=True):
        name = (k, raw[end[i] - size[i] : end[i]])
        seen = lead.setdefault(name, (d, f))
        if seen == (d, f):
            if len(alone) == 0 or alone[-1][1] != name or (d, f) != (doc[alone[-1][0]], first[alone[-1][0]]):
                alone.append((i, name))
                contents[k] = contents.get(k, 0) + 1
        else:
            again.append(i)
    again = np.array(again, np.int64)
    need = np.array([i for i, (k, _) in alone if contents[k] > 1], np.int64)
    a_doc, a_first, a_last = doc[again], first[again], first[again] + size[again] - WINDOW
    if len(need):
        doc, first, size, end = doc[need], first[need], size[need], end[need]
        texts = np.frombuffer(b"".join(raw[e - s : e] for e, s in zip(end.tolist(), size.tolist(), strict=True)), np.uint8)
        del raw, lead, alone
        at = np.flatnonzero(repeated_windows(texts, size, doc, first))
        begin = np.cumsum(size) - size
        owner = np.searchsorted(begin, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
        a, o = at[new], owner[new]
        b = np.append(at[:-1][new[1:]], at[-1:])
        a_doc, a_first, a_last = (np.concatenate(x) for x in ((a_doc, doc[o]), (a_first, first[o] + a - begin[o]), (a_last, first[o] + b - begin[o])))
    return _found(owners, a_doc, a_first, a_last)


def told_apart(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``: a hash of the text where an id has several
    texts, else 0."""
    named = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    several = named.groupBy(F.col("doc_id").cast("bigint").alias("many")).agg(F.min("row").alias("a"), F.max("row").alias("b")).where("many is not null and a <> b").select("many").checkpoint()
    n = several.count()
    if not n:
        return named.withColumn("row", F.lit(0).cast("bigint"))
    joined = named.join(F.broadcast(several) if n <= BROADCAST_IDS else several, F.col("doc_id").cast("bigint") == F.col("many"), "left")
    return joined.select("doc_id", "text", F.when(F.col("many").isNotNull(), F.col("row")).otherwise(F.lit(0)).alias("row"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, row, a, b): packed ranges of windows that repeat an earlier
    one; ``docs`` as ``told_apart`` gives them."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    key = ["doc_id", "row"]
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "row", "text").where("doc_id is not null")
    dealt = named.mapInArrow(_deal(2 * buckets), _PACKED).repartition(buckets, "bucket")
    found = dealt.groupBy("bucket").applyInArrow(_meet, _FOUND).checkpoint()
    del dealt
    release(spark)
    need = found.where("sort").groupBy(key).agg(F.collect_list("h").alias("h"), F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    count = found.where("sort").agg(F.coalesce(F.sum(F.length("h")), F.lit(0))).first()[0] // 8
    shards = max(1, -(-count * (WINDOW + GRAM) // SHARD_BYTES))
    packed = "shard int, key binary, doc binary, row binary, first binary, size binary, text binary"
    cut = named.join(need, key).select(*key, "text", "h", "a", "b").mapInArrow(_cut(shards), packed)
    sorted_ = cut.repartition(min(shards, buckets), "shard").groupBy("shard").applyInArrow(_sort, _FOUND).select(*key, "a", "b").checkpoint()
    del need, cut
    release(spark)
    return found.where("not sort").select(*key, "a", "b").union(sorted_)


def removed_runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs [start, end) that windows starting in a..b cover."""
    order = np.argsort(a, kind="stable")
    a, end = a[order].astype(np.int64), b[order].astype(np.int64) + WINDOW
    if not len(a):
        return a, end
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    return a[new], np.append(reach[:-1][new[1:]], reach[-1])


def _apply(with_text: bool):
    def run(batches):
        for batch in batches:
            raw, offsets = flat_text(batch.column("text"))
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"), strict=True)):
                text = raw[offsets[i] : offsets[i + 1]]
                start, end = removed_runs(_join(a.values or (), np.int32), _join(b.values or (), np.int32)) if a.is_valid else ((), ())
                keep, at = [], 0
                for s, e in zip(start, end, strict=True):
                    keep.append(text[at:s])
                    at = e
                kept = b"".join(x.tobytes() for x in [*keep, text[at:]])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(len(start))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if with_text else None)
            kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary()}
            names = [n for n in out if n != "kept" or with_text]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(out[n], kinds[n]) for n in names]], ["doc_id", *names])

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and with
    ``with_text`` the remaining bytes as ``kept``."""
    rows = told_apart(docs)
    runs = repeated(rows).groupBy(F.col("doc_id").alias("run_id"), F.col("row").alias("run_row")).agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    own = (F.col("doc_id").cast("bigint") == F.col("run_id")) & (F.col("row") == F.col("run_row"))
    rows = rows.join(runs, own, "left").select("doc_id", "text", "a", "b")
    ddl = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return rows.mapInArrow(_apply(with_text), typed(docs, ["doc_id"], ddl))
