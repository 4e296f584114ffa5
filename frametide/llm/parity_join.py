"""N-gram Jaccard join by parity sketches.

The distinct word shingles of a text (of 4 words unless told otherwise) are
hashed to 64 bits. A parity sketch flips one bit per shingle, so the Hamming
distance of two sketches is at most the symmetric difference of the sets. Two
sets with a Jaccard index of 85 % (or the given percentage) or more differ in at
most 15/85 of the smaller one. Per size band, the hash range is cut into more
pieces than that difference; the parity (XOR) of a piece is its join key, and
linked sets agree in at least ``pieces - difference`` keys.

Equal sets are one class before anything is joined. Members of a key group are
first verified against the smallest leader met, then against a leader of each
group; last, every pair of a group that is still in different components and
within the sketch bound is verified, so no link between components is lost. Pairs pass the
Hamming bound of 1024-bit sketches, then the exact intersection.

Defined cases: null, empty and blank texts have no shingles and link with
nothing (component_id is their doc_id); fewer words than a shingle has are one;
a null doc_id stays out of a component's minimum (its own component_id is null
unless a linked row has an id), but its text links others; repeated rows are rows of one class; equal
sizes and ties order by set hash. Sets are identified by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frametide.llm.common import flat_text, fresh, mixed, passes, random_table, release, typed

#: Words of a shingle (up to 16) and Jaccard threshold in percent of the op10 query.
SHINGLE = 4
PERCENT = 85
SKETCH_WORDS = 16
#: Spare pieces beyond the difference, as a share of it: linked sets agree in more pieces by as many.
SPARE = 0.2
#: Key groups of this many sets or more may be dropped by a set that has keys to spare.
LARGE = 16
#: Bytes of a key beyond its bucket; keys that agree by chance only cost a comparison.
KEY_BYTES = 5
#: Keys in a bucket, roughly (14 bytes each with id and slot); a task takes two buckets.
BUCKET_KEYS = 1_000_000
#: Slices of the buckets that are dealt one after the other, each met before the next, so that no
#: more than a slice of the keys lies on disk. Texts are hashed again for each.
SLICES = 2
#: Shingles of the pairs verified at once, as a share of those of all sets; each slice of the pairs
#: reads the texts again and is released before the next, so its shuffle doesn't grow with the pairs.
PAIR_SHARE = 0.25
#: Shingles that a slice of pairs may have anyway (8 bytes each).
SLICE_SHINGLES = 1 << 22
#: Rows of ids that a join may broadcast instead of shuffling texts (16 bytes each).
BROADCAST_ROWS = 400_000
#: Bytes of text hashed at once (some forty bytes of arrays each); a longer text is a pass of its own.
SET_PASS_BYTES = 1 << 18
_BREAK = np.zeros(256, bool)
_BREAK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = random_table(101)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_BREAK] = 0
_ODD = random_table(7, 16) | np.uint64(1)
_BASE = int(_ODD[4])
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_CACHE: dict = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("up", ())) < n:
        size = max(n, SET_PASS_BYTES + 1)
        tables = _powers(_BASE, size), _powers(_INVERSE, size)
        if size > 1 << 24:
            return tables
        _CACHE["up"], _CACHE["down"] = tables
    return _CACHE["up"], _CACHE["down"]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows (A-Z as a-z) and the n + 1
    offsets of the rows' words. A word's hash is a difference of running
    polynomial sums, shifted back to its start."""
    blank = _BREAK[raw]
    n = len(raw)
    edge = np.ones(n + 1, bool)
    edge[1:n] = blank[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(edge[:n] & ~blank)
    stop = np.ones(n + 1, bool)
    stop[:n] = blank
    stop[offsets] = True
    ends = np.flatnonzero(stop[1:] & ~blank) + 1
    up, down = _tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    h, rows = word_hashes(raw, offsets)
    m = np.zeros(0, np.uint64)
    if len(h) >= shingle:
        m = h[: len(h) - shingle + 1] * _ODD[0]
        for i in range(1, shingle):
            m += h[i : len(h) - shingle + 1 + i] * _ODD[i]
        m = mixed(m)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= shingle:
            yield np.unique(m[a : b - shingle + 1])
        elif b > a:
            yield mixed((h[a:b] * _ODD[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield m[:0]


def set_id(s: np.ndarray) -> int:
    return int(mixed(s.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0].astype(np.int64)) if len(s) else 0


@cache
def bands(percent: int) -> np.ndarray:
    """Lower bounds of the size bands; linked sizes are in one band or in neighbours."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return np.array(out)


def most_different(band: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of linked sets whose smaller one is in ``band``."""
    return (100 - percent) * (int(bands(percent)[band + 1]) - 1) // percent


def _few_lone(mean: float, share: float) -> bool:
    """Whether pieces of ``mean`` shingles hold one or none in less than ``share`` of cases."""
    return (1 + mean) * math.exp(-mean) < share


def piece_keys(s: np.ndarray, band: int, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """Join keys of a set in ``band``, the parities of its hash range's
    pieces, and how many of them any linked set has at least.

    Linked sets agree in ``pieces - difference`` pieces. Weak pieces (one
    shingle or none; only none where a piece has few shingles on average) are
    no keys if a strong one must agree as well; a set of too many weak pieces
    has all pieces as keys."""
    d = most_different(band, percent)
    spare = 2 + int(np.ceil(SPARE * d))
    n = d + 1 + spare
    piece = ((s >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    at = np.flatnonzero(np.diff(piece, prepend=np.uint64(n)))
    parity = np.bitwise_xor.reduceat(s, at) if len(at) else s[:0]
    place = piece[at]
    count = np.diff(at, append=len(s))
    strong = count > (1 if d >= 8 and _few_lone(int(bands(percent)[band]) / n, spare / n) else 0)
    salt = random_table(band + 1_000, 1)[0]
    weak = n - int(strong.sum())
    if weak > spare:
        whole = np.zeros(n, np.uint64)
        whole[place.astype(np.int64)] = parity
        return mixed(whole ^ mixed(np.arange(n, dtype=np.uint64) + salt)), 1
    return mixed(parity[strong] ^ mixed(place[strong] + salt)), spare + 1 - weak


def keys_of(s: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys in the set's own band and, as the larger partner, in the one
    below; for each key 2 * (agreeing keys at least) + (0 own band, 1 below)."""
    n = len(s)
    band = int(np.searchsorted(bands(percent), n, "right")) - 1
    out = [piece_keys(s, band, percent)] if most_different(band, percent) else [(s[:0], 0)]
    if band and most_different(band - 1, percent) and percent * n <= 100 * (int(bands(percent)[band]) - 1):
        out.append(piece_keys(s, band - 1, percent))
    slots = [np.full(len(k), min(2 * m, 254) + i, np.uint8) for i, (k, m) in enumerate(out)]
    return np.concatenate([k for k, _ in out]), np.concatenate(slots)


def sketch(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((s & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def _each_set(batch, shingle: int) -> Iterator[np.ndarray]:
    raw, offsets = flat_text(batch.column("text"))
    for a, b in passes(offsets, SET_PASS_BYTES):
        yield from shingle_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)


def _digest(shingle: int):
    def run(batches):
        names = ["doc_id", "text_id", "n_shingles", "set_id", *[f"k{i}" for i in range(SKETCH_WORDS)]]
        for batch in batches:
            n, ids, sketches = [], [], []
            for s in _each_set(batch, shingle):
                n.append(len(s))
                ids.append(set_id(s))
                sketches.append(sketch(s))
            k = np.array(sketches, np.int64).reshape(-1, SKETCH_WORDS)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_id"), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), *[pa.array(k[:, i]) for i in range(SKETCH_WORDS)]], names)

    return run


def digests(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text hash, set size, set id and 1024-bit parity sketch per row."""
    ddl = "text_id bigint, n_shingles bigint, set_id bigint, " + ", ".join(f"k{i} bigint" for i in range(SKETCH_WORDS))
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).mapInArrow(_digest(shingle), typed(docs, ["doc_id"], ddl))


def _low(bucket: int, buckets: int) -> int:
    """The smallest key in a bucket."""
    return -(-(bucket << 32) // buckets) << 32


def _short(k: np.ndarray, bucket: int, buckets: int) -> bytes:
    """Keys of a bucket as the 40 bits that follow those which name the bucket."""
    rest = (k - np.uint64(_low(bucket, buckets))) >> np.uint64(max(0, 25 - buckets.bit_length()))
    return rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _long(packed: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = packed.reshape(-1, KEY_BYTES)
    return wide.view("<u8").reshape(-1)


def _deal(buckets: int, shingle: int, percent: int, low: int = 0, high: int | None = None):
    """Keys, set ids and slots of a batch as one row of packed arrays per
    bucket (of those from ``low`` to below ``high``): a million keys cost a few
    hundred rows. Equal sets of a batch count once."""

    def run(batches):
        for batch in batches:
            seen, keys, ids, slots = set(), [], [], []
            for s in _each_set(batch, shingle):
                if len(s) and (i := set_id(s)) not in seen:
                    seen.add(i)
                    k, slot = keys_of(s, percent)
                    keys.append(k)
                    slots.append(slot)
                    ids.append(np.full(len(k), i, np.int64))
            if not sum(map(len, keys)):
                continue
            k, i, slot = np.concatenate(keys), np.concatenate(ids), np.concatenate(slots)
            bucket = ((k >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            dealt = np.flatnonzero((bucket >= low) & (bucket < (buckets if high is None else high)))
            order = dealt[np.argsort(k[dealt])]
            k, i, slot, bucket = k[order], i[order], slot[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
            to = np.append(at[1:], len(k))
            short = pa.array([_short(k[a:b], int(bucket[a]), buckets) for a, b in zip(at, to, strict=True)], pa.binary())
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(at, to, strict=True)], pa.binary()) for x in (i, slot)]
            yield pa.record_batch([pa.array(bucket[at].astype(np.int32)), short, *packed], ["bucket", "keys", "ids", "slots"])

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Key groups of two sets or more: (g, id, sized), sized being 256 times the
    group's size plus the slot. Small groups are named by their members, so the
    keys that they share are one group; large ones by their key."""
    k, i, slot = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table.column(c)]) for c, t in (("keys", np.uint8), ("ids", np.int64), ("slots", np.uint8)))
    k = _long(k) + (np.uint64(table.column("bucket")[0].as_py()) << np.uint64(8 * KEY_BYTES))
    order = np.argsort(k, kind="stable")
    k, i, slot = k[order], i[order], slot[order]
    twin = np.zeros(len(k), bool)
    same = k[1:] == k[:-1]
    twin[1:] = same
    twin[:-1] |= same
    k, i, slot = k[twin], i[twin], slot[twin]
    order = np.lexsort((i, k))
    k, i, slot = k[order], i[order], slot[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
    k, i, slot = k[new], i[new], slot[new]
    lead = np.ones(len(k), bool)
    lead[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(lead)
    size = np.diff(at, append=len(k))
    members = np.add.reduceat(mixed(i.view(np.uint64)), at) if len(at) else k
    _, first = np.unique(members, return_index=True)
    keep = np.zeros(len(at), bool)
    keep[first] = True
    large = size >= LARGE
    keep = (keep | large) & (size > 1)
    name = np.where(large, mixed(k[at]), members)
    rows = np.repeat(keep, size)
    return pa.table({"g": np.repeat(name, size)[rows].view(np.int64), "id": i[rows], "sized": np.repeat(size, size)[rows] * 256 + slot[rows]})


def key_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, keys: int = 0) -> DataFrame:
    """(g, id): sets that share a key; ``keys``: how many are dealt, roughly.

    A set of which m keys at least agree with any linked one leaves its m - 1
    largest groups. The smallest group of two linked sets survives on both
    sides: m - 1 others that they share are larger. So very common pieces,
    which many unrelated sets share, bring no pairs, and no link is lost."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), keys // (2 * BUCKET_KEYS))
    edges = [2 * parts * i // SLICES for i in range(SLICES + 1)]
    met = None
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        dealt = docs.select("text").mapInArrow(_deal(2 * parts, shingle, percent, low, high), "bucket int, keys binary, ids binary, slots binary").repartition(-(-parts // SLICES), "bucket")
        part = dealt.groupBy("bucket").applyInArrow(_meet, "g bigint, id bigint, sized bigint").checkpoint()
        met = part if met is None else met.union(part)
        del dealt, part
        release(docs.sparkSession)
    large = F.col("sized") >= 256 * LARGE
    slot = F.pmod("sized", F.lit(256))
    place = F.row_number().over(Window.partitionBy("id", slot).orderBy(F.shiftright("sized", 8).desc(), "g"))
    rest = met.where(large).withColumn("place", place).where(F.col("place") >= F.floor(slot / 2))
    return met.where(~large).select("g", "id").union(rest.select("g", "id"))


def _pack(shingle: int):
    def run(batches):
        for batch in batches:
            ids, packed = [], []
            for want, s in zip(batch.column("want").to_pylist(), _each_set(batch, shingle), strict=True):
                if set_id(s) == want:
                    ids.append(want)
                    packed.append(s.tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["id", "packed"])

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                hit.append(100 * common >= percent * (len(both) - common))
            mask = pa.array(hit, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _side(sets: DataFrame, c: str) -> DataFrame:
    return sets.select(F.col("set_id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("row").alias(f"d{c}"), *[F.col(f"k{i}").alias(f"{c}{i}") for i in range(SKETCH_WORDS)])


def _within_bound(percent: int):
    """Sizes and sketches allow the sets a and b to be linked."""
    far = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
    near = far * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))
    return near & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of set ids that are linked, by sketch bound and exact
    intersection. Only one document per set involved is shingled again. The
    pairs are dealt in slices by their shingles, so that at most about
    ``PAIR_SHARE`` of all sets' shingles lies on disk at once, however many
    pairs there are."""
    spark = docs.sparkSession
    near = pairs.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").where(_within_bound(percent))
    near = near.select("a", "b", "da", "db", (F.col("na") + F.col("nb")).alias("both")).checkpoint()
    release(spark)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    slices = max(1, math.ceil((near.agg(F.sum("both")).first()[0] or 0) / max(SLICE_SHINGLES, PAIR_SHARE * total)))
    repeats, out = _repeats(docs), None
    for i in range(slices):
        dealt = near.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == i)
        want = dealt.select(F.col("a").alias("want"), "da.*").union(dealt.select("b", "db.*")).distinct()
        want = if_small(want.select("want", F.col("doc_id").alias("want_doc"), F.col("text_id").alias("want_text")))
        row = F.col("doc_id").eqNullSafe(F.col("want_doc")) & (F.xxhash64("text") == F.col("want_text"))
        packed = docs.select("doc_id", "text").join(want, row).select("want", "text").mapInArrow(_pack(shingle), "id bigint, packed binary")
        packed = packed.groupBy("id").agg(F.first("packed").alias("packed")) if repeats else packed
        both = dealt.select("a", "b").join(packed.select(F.col("id").alias("a"), F.col("packed").alias("x")), "a").join(packed.select(F.col("id").alias("b"), F.col("packed").alias("y")), "b")
        linked = both.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a bigint, b bigint").checkpoint()
        out = linked if out is None else out.union(linked)
        del dealt, want, row, packed, both, linked
        release(spark)
    return out


def if_small(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` (a few numbers per row) marked for broadcast when counted to be
    within ``limit`` rows; beyond it the join shuffles."""
    ids = ids.checkpoint()
    return F.broadcast(ids) if ids.count() <= limit else ids


def _repeats(docs: DataFrame) -> bool:
    """Whether a row occurs twice, so that a set could come from two rows."""
    return not docs.groupBy("doc_id", F.xxhash64("text")).count().where("count > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b): alternating large-star and
    small-star steps until nothing changes; all work in joins and minimums."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    mark = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.union(low).distinct().checkpoint()
        del both, low, large, small
        release(edges.sparkSession)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
        mark = now


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, root) after adding ``links``: only links between components are
    walked, as edges between their roots."""
    if roots is None:
        return components(links).checkpoint()
    side = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
    between = links.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
    new = components(between).checkpoint()
    moved = roots.join(new.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return moved.union(new.join(roots.select("id"), "id", "left_anti").select("id", "root")).checkpoint()


def rooted(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_id, n_shingles and the class's root set per row of ``docs``."""
    spark = docs.sparkSession
    rows = digests(docs, shingle).checkpoint()
    sets = rows.where("n_shingles > 0").groupBy("set_id", "n_shingles", *[f"k{i}" for i in range(SKETCH_WORDS)]).agg(F.min(F.struct("doc_id", "text_id")).alias("row")).checkpoint()
    release(spark)
    # A set has about as many keys as it may differ in from the smallest linked one.
    keys = sets.agg(F.sum(F.col("n_shingles") * (100 - percent) * (1 + SPARE) / percent + 2)).first()[0] or 0
    groups = key_groups(docs, shingle, percent, int(keys)).distinct().checkpoint()
    release(spark)
    roots, at = None, groups.withColumn("root", F.col("id"))
    for meet_all in (False, True):
        # First the smallest of all leaders; then, in every group, a leader of the group's own: as many pairs as group rows.
        order = F.xxhash64("id", "g") if meet_all else F.col("id")
        lead = at.groupBy("g").agg(F.min(F.struct(order.alias("order"), "id", "root")).alias("lead"))
        stars = at.join(lead, "g").where("lead.root <> root").select("id", F.col("lead.id").alias("other"))
        if not meet_all:
            stars = stars.groupBy("id").agg(F.min("other").alias("other"))
        stars = stars.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        roots = merged(roots, verified(stars, sets, docs, shingle, percent))
        del lead, stars, at
        release(spark)
        at = groups.join(roots, "id", "left").select("g", "id", F.coalesce("root", "id").alias("root"))
    open_groups = at.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("g")
    at = at.join(open_groups, "g").checkpoint()
    left = at.select("g", F.col("id").alias("a"), F.col("root").alias("ra")).join(_side(sets, "a").drop("da"), "a")
    right = at.select("g", F.col("id").alias("b"), F.col("root").alias("rb")).join(_side(sets, "b").drop("db"), "b")
    rest = left.join(right, (left["g"] == right["g"]) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _within_bound(percent)).select("a", "b").distinct()
    roots = merged(roots, verified(rest, sets, docs, shingle, percent))
    del left, right, rest, at, open_groups, groups
    release(spark)
    rows = rows.select("doc_id", "text_id", "n_shingles", "set_id").join(roots.withColumnRenamed("id", "set_id"), "set_id", "left")
    return rows.select("doc_id", "text_id", "n_shingles", F.coalesce("root", "set_id").alias("root"))


def join_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``."""
    rows = rooted(docs, shingle, percent)
    least = rows.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "root", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with
    the smallest (doc_id, text hash) stays, and one of several equal (doc_id,
    text) rows. Rows without an id stay."""
    rows = rooted(docs, shingle, percent).where("doc_id is not null").checkpoint()
    least = rows.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct("doc_id", "text_id")).alias("least"))
    gone = (F.col("least.doc_id") != F.col("doc_id")) | (F.col("least.text_id") != F.col("text_id"))
    drop = if_small(rows.where("n_shingles > 0").join(least, "root").where(gone).select("doc_id", "text_id").distinct())
    text_id = fresh(docs, "text_id")
    keyed = docs.withColumn(text_id, F.xxhash64("text"))
    out = keyed.join(drop.withColumnRenamed("text_id", text_id), ["doc_id", text_id], "left_anti")
    twice = rows.groupBy("doc_id", "text_id").count().where("count > 1").select("doc_id", F.col("text_id").alias(text_id))
    if twice.isEmpty():
        return out.select(*docs.columns)
    return out.join(twice, ["doc_id", text_id], "left_anti").select(*docs.columns).unionByName(out.join(twice, ["doc_id", text_id], "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))
