"""PII: base rules plus bootstrapped contextual extraction.

Entities found by the base rules are seeds. The one or two words before and
after them are lexical patterns, on their own and, as a weak feature, with the
class or the shape of the identifier. Spark scores the graph of patterns and
instances in rounds: a pattern is trusted by the share of its instances that
belong to one kind, an instance by the patterns that extract it. Identifiers
that no base rule knows, whatever their format, are reported when trusted
patterns agree in several contexts (one or two words, before or after).

Mentions are base spans, tokens with an @ or with four digits, numbers in groups
with single blanks between them (of more than 19 digits in all, the groups are
mentions of their own), and ``name at host`` in words or brackets.

Defined cases: null and empty texts have no spans; ids may be null or repeat;
equal rows give equal results; without seeds nothing is discovered. Ties
between kinds go to the kind listed first. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import typed

KINDS = ("email", "ip", "card", "phone")

ROUNDS = 2
#: Distinct instances that a pattern needs before it is trusted at all.
MIN_INSTANCES = 8
#: Share of one kind among a trusted pattern's instances, one instance of doubt added.
MIN_PATTERN = 0.8
#: Contexts with a trusted pattern and their joint score for a discovered identifier.
MIN_PATTERNS = 2
MIN_INSTANCE = 0.95

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")
_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_NUMBERS = re.compile(r"[+0-9][0-9+(). -]*")
_DOTTED = re.compile(r"[0-9.]+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]")
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|"
_DIGITS = frozenset("0123456789")
_GROUP = re.compile(r"[0-9+()./-]+")
#: Digits of the longest identifier that is written in groups (a card).
GROUP_DIGITS = 19
_AT = re.compile(r"(?<=[ \t\[({])at(?=[ \t\])}])", re.I | re.A)
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|[ \t]+dot[ \t]+|[ \t]*[\[({][ \t]*dot[ \t]*[\])}][ \t]*)[A-Za-z0-9-]+)*", re.I | re.A)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        done = _EMAIL_RUN.match(text, at).end()
        # No match leaves its run of address characters.
        for m in _EMAIL.finditer(text, start, done):
            yield m.start(), m.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the contract's base rules, in order of
    start and kind. Every numeric match lies in one run of number characters."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for run in _NUMBERS.finditer(text):
        lo, hi = run.span()
        if hi - lo < 7:
            continue
        for d in _DOTTED.finditer(text, lo, hi):
            if text.count(".", d.start(), d.end()) >= 3:
                for m in _IP.finditer(text, d.start(), d.end()):
                    if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
                        out.append((m.start(), 1, m.end()))
        if hi - lo >= 14:
            for m in _CARD.finditer(text, lo, hi):
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in run.group():
            for m in _PHONE.finditer(text, lo, hi):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(token: str) -> str:
    """Runs of digits as 9, of letters as a; other characters stay."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", token))


def _beside(text: str, start: int, end: int) -> list[str | None]:
    """The word and the two words before a span, and those after it, in lower
    case without edge marks; ^ and $ stand for the text's edges."""
    before = [w for x in reversed(text[max(0, start - 64) : start].split()) if (w := x.strip(_EDGE).lower())]
    after = [w for x in text[end : end + 64].split() if (w := x.strip(_EDGE).lower())]
    out = []
    for words, edge in ((before, "^"), (after, "$")):
        first, second = [*words[:2], edge, edge][:2]
        out += [first, f"{first} {second}" if words else None]
    return out


def _tokens(text: str):
    """(start, end, whole start, whole end) of tokens with a digit or an @,
    without and with the marks at their edges."""
    done = 0
    for m in _MARKED.finditer(text):
        if m.start() < done:
            continue
        lo, hi = m.start(), m.end()
        while lo and not text[lo - 1].isspace():
            lo -= 1
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        start, end, done = lo, hi, hi
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        while start < end and text[start] in _EDGE:
            start += 1
        yield start, end, lo, hi


def _joins(text: str, a: tuple, b: tuple) -> bool:
    """Whether two tokens are groups of one number."""
    return b[2] == a[3] + 1 and text[a[3]] in " \t\xa0" and text[a[1] : a[3]] in ("", ")") and text[b[2] : b[0]] in ("", "(") and all(_GROUP.fullmatch(text, t[0], t[1]) for t in (a, b))


def _digits(text: str, start: int, end: int) -> int:
    return sum(c in _DIGITS for c in text[start:end])


def _whole_groups(text: str, run: list[tuple]) -> list[tuple[int, int]]:
    """The number that ``run`` spells in groups, with the brackets that belong to it."""
    start, end = run[0][0], run[-1][1]
    if len(run) > 1:
        if sum(_digits(text, t[0], t[1]) for t in run) > GROUP_DIGITS:
            return [t[:2] for t in run]
        start -= text[run[0][2] : start] == "(" and ")" in text[start:end]
        end += text[end : run[-1][3]] == ")" and text.count("(", start, end) > text.count(")", start, end)
    return [(start, end)]


def _spelled(text: str):
    """(start, end) of ``name at host``, the at between blanks or brackets."""
    for m in _AT.finditer(text):
        end, right = m.start(), m.end()
        while end and text[end - 1] in " \t[({":
            end -= 1
        while right < len(text) and text[right] in " \t])}":
            right += 1
        start = end
        while start and text[start - 1] in _EMAIL_CHARS:
            start -= 1
        host = _HOST.match(text, right)
        if host and start < end and (not start or text[start - 1].isspace() or text[start - 1] in _EDGE):
            yield start, host.end()


def mentions(text: str, base) -> list[tuple[int, int, int]]:
    """(start, kind index or -1, end): base spans, and other tokens with an @
    or with four digits or more, numbers in groups and spelled addresses."""
    out, runs = list(base), []
    taken: list[tuple[int, int]] = []
    for s, _, e in base:
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))

    def free(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
        i = bisect_left(spans, (end,)) - 1
        return i < 0 or spans[i][1] <= start

    for t in _tokens(text):
        if not free(t[0], t[1], taken):
            continue
        if runs and _joins(text, runs[-1][-1], t):
            runs[-1].append(t)
        else:
            runs.append([t])
    numbers = []
    for run in runs:
        for start, end in _whole_groups(text, run):
            if ("@" in text[start:end] and end - start >= 6) or _digits(text, start, end) >= 4:
                numbers.append((start, end))
    spelled, done = [], 0
    for start, end in _spelled(text):
        if start >= done and free(start, end, taken) and free(start, end, numbers):
            spelled.append((start, end))
            done = end
    return out + [(s, -1, e) for s, e in sorted(numbers + spelled)]


_SPAN = "struct<start:int,kind:string,end:int>"
_MENTION = "struct<start:int,end:int,kind:string,value:string,beside:array<string>>"
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
_ARROW_MENTION = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()), ("beside", pa.list_(pa.string()))]))


def _scan(batches):
    for batch in batches:
        spans, found = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans.append([{"start": s, "kind": KINDS[k], "end": e} for s, k, e in base])
            found.append([{"start": s, "end": e, "kind": KINDS[k] if k >= 0 else None, "value": text[s:e], "beside": [*_beside(text, s, e), shape(text[s:e])]} for s, k, e in mentions(text, base)])
        yield pa.record_batch([batch.column("doc_id"), pa.array(spans, _ARROW_SPAN), pa.array(found, _ARROW_MENTION)], ["doc_id", "base", "mentions"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and mentions per row, with a row number fixed by a checkpoint."""
    schema = typed(docs, ["doc_id"], f"base array<{_SPAN}>, mentions array<{_MENTION}>")
    return docs.select("doc_id", "text").mapInArrow(_scan, schema).withColumn("row", F.monotonically_increasing_id()).checkpoint()


def _patterns():
    """(context, pattern) of a mention: the words of each of the four contexts
    alone, with the class (letters or none) and with the shape of the identifier.
    A text's edge alone is no context without the shape."""
    words, form = (lambda i: F.element_at("beside", i + 1)), F.element_at("beside", 5)
    forms = (F.lit(""), F.when(form.contains("a"), "a").otherwise("9"), form)
    return F.filter(
        F.array(*[F.struct(F.lit(i).alias("context"), F.when(F.lit(f == 2) | ~words(i).isin("^", "$"), F.xxhash64(F.lit(i), F.lit(f), words(i), x)).alias("pattern")) for i in range(4) for f, x in enumerate(forms)]),
        lambda p: p["pattern"].isNotNull(),
    )


def score_graph(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind, score) of identifiers that trusted patterns discover.

    Edges are distinct (pattern, value) pairs, so a word or an identifier that
    repeats a million times weighs once; sums are pre-aggregated per pattern.
    Patterns are told apart by 64-bit hashes. Of the patterns of one context
    only the most trusted counts, as they share their words."""
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    edges = m.select("value", "kind", F.explode(_patterns()).alias("p")).select("value", "kind", "p.*").distinct().checkpoint()
    size = edges.groupBy("pattern").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= MIN_INSTANCES)
    known = edges.where("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    score = known
    for _ in range(rounds):
        sums = edges.select("pattern", "value").distinct().join(score, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("s"))
        trusted = sums.join(size, "pattern").withColumn("trust", F.col("s") / (F.col("n") + 1)).where(F.col("trust") >= MIN_PATTERN).select("pattern", "kind", "trust")
        new = (
            edges.where("kind is null")
            .select("context", "pattern", "value")
            .join(trusted, "pattern")
            .groupBy("value", "kind", "context")
            .agg(F.max("trust").alias("trust"))
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))))).alias("score"), F.count("*").alias("n"))
            .where((F.col("n") >= MIN_PATTERNS) & (F.col("score") >= MIN_INSTANCE))
            .select("value", "kind", "score")
        )
        found_now = new.join(known.select("value"), "value", "left_anti").checkpoint()
        score = known.unionByName(found_now)
    rank = F.struct(F.col("score"), -F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.col("kind").alias("kind"))
    return found_now.groupBy("value").agg(F.max(rank).alias("r")).select("value", F.col("r.kind").alias("kind"), F.col("r.score").alias("score"))


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` spans and ``more`` spans (discovered) of every row."""
    found = scan(docs)
    news = score_graph(found)
    m = found.select("row", F.explode("mentions").alias("m")).where("m.kind is null").select("row", "m.start", "m.end", "m.value")
    more = m.join(news, "value").groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    return found.select("doc_id", "base", "row").join(more, "row", "left").drop("row")


def _report(batches):
    for batch in batches:
        out = defaultdict(list)
        for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist(), strict=True):
            spans = [(b["start"], KINDS.index(b["kind"]), b["end"]) for b in base]
            new = [(b["start"], KINDS.index(b["kind"]), b["end"]) for b in more or []]
            text = lambda x: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))
            for i, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(k == i for _, k, _ in spans))
            out["base_sha256"].append(hashlib.sha256(text(spans).encode()).hexdigest())
            out["spans"].append(text(spans + new))
            out["n_discovered"].append(len(new))
        names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "n_discovered"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.record_batch([batch.column("doc_id"), *[pa.array(out[n], t) for n, t in zip(names, kinds, strict=True)]], ["doc_id", *names])


def report(found: DataFrame) -> DataFrame:
    """Counts, digest and spans per row of ``extract``."""
    schema = typed(found, ["doc_id"], ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_discovered bigint")
    return found.mapInArrow(_report, schema)
