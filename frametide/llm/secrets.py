"""Secret scans: probabilistic automata inferred from labelled credentials.

The base rules mark credentials; these are the labels. Their character-class
strings form a prefix tree per kind whose statistically compatible states are
merged (Hoeffding test, red-blue order). Every other token is then scored: it is
a secret if an automaton holds its format as likely as those of its credentials,
and likelier than the corpus does. The corpus' own likelihood is that of a chain
of character classes counted over all texts, and weighs as many times more as
there are tokens to a credential. The automata give the lengths and characters
of candidates; there is no other bound on them.

Defined cases: null and empty texts have no spans; ids may be null or repeat
and are only carried; equal rows give equal results; without any credential in
the corpus there is no automaton and only base spans are reported; a token that
several kinds accept goes to the likeliest. Texts are scanned whole; the scans
are linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import flat_text, fresh, passes, typed

KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Labelled credentials per kind that an automaton is inferred from (expected number, by value hash).
FIT_VALUES = 400
#: Confidence parameter of the merge test.
ALPHA = 0.05
#: A candidate is as likely, per character, as all but this share of the labelled ones.
MISS_SHARE = 0.01
#: Formats whose verdicts a task remembers.
FORMATS = 1 << 16

_SEPARATOR = re.compile("[:=]")
_VALUE = re.compile(r"[A-Za-z0-9+/_.=-]+")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PUNCTUATION = "+/_.=-"
#: Classes of characters: d digit, x a-f, l other lower, X A-F, U other upper; punctuation stands for itself.
_CLASSES = "dxlXU" + _PUNCTUATION
_CLASS_OF = {c: "d" for c in string.digits} | {c: "x" if c in "abcdef" else "l" for c in string.ascii_lowercase} | {c: "X" if c in "ABCDEF" else "U" for c in string.ascii_uppercase} | {c: c for c in _PUNCTUATION}
_TABLE = str.maketrans(_CLASS_OF)
#: Class number of every byte; 0 is outside of tokens.
_CODE = np.array([_CLASSES.index(_CLASS_OF[chr(b)]) + 1 if chr(b) in _CLASS_OF else 0 for b in range(256)])
_STATES = len(_CLASSES) + 1


def _assignments(text: str):
    """(start, end, value start) of keyword, separator, value; a match that
    starts inside an earlier one is none."""
    done = 0
    for m in _SEPARATOR.finditer(text):
        at = m.start()
        if at < done:
            continue
        left = at
        while left and text[left - 1] == " ":
            left -= 1
        if left and text[left - 1] in "\"'":
            left -= 1
        for word in KEYWORDS:
            start = left - len(word)
            if start >= done and text.endswith(word[-1], start, left) | text.endswith(word[-1].upper(), start, left):
                found = text[start:left]
                if found.isascii() and found.lower() == word:
                    break
        else:
            continue
        right = at + 1
        while right < len(text) and text[right] == " ":
            right += 1
        if right < len(text) and text[right] in "\"'":
            right += 1
        value = _VALUE.match(text, right)
        if value:
            done = value.end()
            yield start, done, right


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind index, end, credential) of the contract's base rules, in
    order of start and kind."""
    out = [(s, 0, e, text[v:e]) for s, e, v in _assignments(text) if e - v >= 6]
    out += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(out)


def classes(token: str) -> str:
    """Format string of a token."""
    return token.translate(_TABLE)


def class_pairs(column: pa.Array) -> np.ndarray:
    """How often a class follows another one within the texts; 0 is both the
    start and the end of a token."""
    raw, offsets = flat_text(column)
    pairs = np.zeros(_STATES * _STATES, np.int64)
    for a, b in passes(offsets):
        lo = offsets[a]
        # Every text stands between two zeros.
        code = np.zeros(offsets[b] - lo + b - a + 1, np.int64)
        at = np.arange(offsets[b] - lo) + np.repeat(np.arange(1, b - a + 1), np.diff(offsets[a : b + 1]))
        code[at] = _CODE[raw[lo : offsets[b]]]
        pairs += np.bincount(code[:-1] * _STATES + code[1:], minlength=len(pairs))
    pairs[0] = 0
    return pairs


class Background:
    """Likelihood of formats among all tokens of the corpus: a chain of classes."""

    def __init__(self, pairs: np.ndarray):
        n = np.asarray(pairs, float).reshape(_STATES, _STATES) + 1
        n[0, 0] = 0
        self.tokens = float(n[0].sum())
        bits = np.log2(np.maximum(n, 1e-9) / n.sum(axis=1, keepdims=True))
        names = "$" + _CLASSES
        self.bits = {x + y: float(bits[i, j]) for i, x in enumerate(names) for j, y in enumerate(names)}

    def score(self, token: str) -> float:
        """Log2 likelihood of the token's format."""
        path = f"${classes(token)}$"
        return sum(self.bits[path[i : i + 2]] for i in range(len(path) - 1))


class Automaton:
    """A deterministic probabilistic automaton inferred by state merging."""

    def __init__(self, tokens: list[str], alpha: float = ALPHA):
        self.ends, self.arcs = [0], [{}]
        for token in tokens:
            state = 0
            for c in classes(token):
                arc = self.arcs[state].get(c)
                if arc is None:
                    arc = self.arcs[state][c] = [len(self.ends), 0]
                    self.ends.append(0)
                    self.arcs.append({})
                arc[1] += 1
                state = arc[0]
            self.ends[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        self.lengths = (min(map(len, tokens)), max(map(len, tokens))) if tokens else (0, -1)
        scores = sorted(self.score(t) for t in tokens)
        self.least = scores[int(MISS_SHARE * len(scores))] if scores else math.inf

    def _seen(self, state: int) -> int:
        return self.ends[state] + sum(a[1] for a in self.arcs[state].values())

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = self._seen(a), self._seen(b)
            if not na or not nb:
                continue
            limit = self.bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.ends[a] / na - self.ends[b] / nb) > limit:
                return False
            for c in self.arcs[a].keys() | self.arcs[b].keys():
                x, y = self.arcs[a].get(c, (0, 0)), self.arcs[b].get(c, (0, 0))
                if abs(x[1] / na - y[1] / nb) > limit:
                    return False
                if x[1] and y[1] and x[0] != y[0]:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the tree below ``blue`` to ``red``."""
        stack = [(red, blue)]
        while stack:
            a, b = stack.pop()
            self.ends[a] += self.ends[b]
            for c, (to, n) in self.arcs[b].items():
                arc = self.arcs[a].get(c)
                if arc is None:
                    self.arcs[a][c] = [to, n]
                else:
                    arc[1] += n
                    if arc[0] != to:
                        stack.append((arc[0], to))

    def _merge_all(self) -> None:
        red = [0]
        kept = {0}
        while True:
            blue = next(((s, c) for s in red for c in sorted(self.arcs[s]) if self.arcs[s][c][0] not in kept), None)
            if blue is None:
                return
            source, c = blue
            state = self.arcs[source][c][0]
            for r in red:
                if self._compatible(r, state):
                    self.arcs[source][c][0] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
                kept.add(state)

    def score(self, token: str) -> float:
        """Mean log2 likelihood per character, the end included."""
        state, total = 0, 0.0
        for c in classes(token):
            arc = self.arcs[state].get(c)
            if arc is None:
                return -math.inf
            total += math.log2(arc[1] / self._seen(state))
            state = arc[0]
        if not self.ends[state]:
            return -math.inf
        return (total + math.log2(self.ends[state] / self._seen(state))) / (len(token) + 1)

    def accepts(self, token: str) -> bool:
        return self.lengths[0] <= len(token) <= self.lengths[1] and self.score(token) >= self.least


class Formats:
    """The automata of all kinds and what a corpus says against them."""

    def __init__(self, automata: dict[str, Automaton], seen: dict[str, int], background: Background):
        self.automata, self.background = automata, background
        self.prior = {k: math.log2(min(0.5, n / background.tokens)) for k, n in seen.items()}
        least = min((a.lengths[0] for a in automata.values()), default=1)
        used = {c for a in automata.values() for arcs in a.arcs for c in arcs} & set(_PUNCTUATION)
        letters = "A-Za-z0-9" + "".join(re.escape(c) for c in sorted(used))
        self.run = re.compile(f"[{letters}]{{{least},}}")
        self.parts = re.compile(f"[A-Za-z0-9]{{{least},}}")
        self.verdicts: dict[str, str | None] = {}

    def kind_of(self, token: str) -> str | None:
        """The kind under whose automaton the token's format is likeliest, if
        any accepts it and the corpus doesn't explain it better."""
        form = classes(token)
        if form not in self.verdicts:
            if len(self.verdicts) >= FORMATS:
                self.verdicts.clear()
            self.verdicts[form] = self._judged(token)
        return self.verdicts[form]

    def _judged(self, token: str) -> str | None:
        best = None
        for k, a in sorted(self.automata.items()):
            if a.accepts(token):
                bits = a.score(token) * (len(token) + 1) + self.prior[k]
                if best is None or bits > best[0]:
                    best = (bits, k)
        return best[1] if best and best[0] > self.background.score(token) else None

    def find(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
        """(start, end, kind) of the secrets that overlap none of ``taken``: runs
        of credential characters, or without punctuation around them, or else
        the runs of letters and digits within."""
        if not self.automata:
            return []
        out = []
        for m in self.run.finditer(text):
            whole = m.group()
            inner = whole.strip(_PUNCTUATION)
            at = m.start() + len(whole) - len(whole.lstrip(_PUNCTUATION))
            tries = [[(m.start(), whole)], [(at, inner)] if inner != whole else [], [(m.start() + p.start(), p.group()) for p in self.parts.finditer(whole)] if not inner.isalnum() else []]
            for some in tries:
                hits = [(s, s + len(t), k) for s, t in some if t and (k := self.kind_of(t))]
                if hits:
                    out += hits
                    break
        return [(s, e, k) for s, e, k in out if not any(a < e and s < b for a, b in taken)] if out else out


def _scan(batches):
    """Per row: base spans and credentials; on a batch's first row also the
    class pairs of all its texts."""
    for batch in batches:
        base = [[{"start": s, "kind": KINDS[k], "end": e, "value": v} for s, k, e, v in base_spans(text or "")] for text in batch.column("text").to_pylist()]
        spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("value", pa.string())]))
        pairs = [class_pairs(batch.column("text")).tobytes(), *[None] * (len(base) - 1)][: len(base)]
        yield pa.record_batch([batch.column("doc_id"), pa.array(base, spans), pa.array(pairs, pa.binary())], ["doc_id", "base", "pairs"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and base spans of every row; ``pairs`` holds counts of the corpus
    on some rows, to be summed."""
    schema = typed(docs, ["doc_id"], "base array<struct<start:int,kind:string,end:int,value:string>>, pairs binary")
    return docs.select("doc_id", "text").mapInArrow(_scan, schema)


def _summed(batches):
    total = np.zeros(_STATES * _STATES, np.int64)
    for batch in batches:
        for x in batch.column("pairs"):
            total += np.frombuffer(x.as_buffer(), np.int64)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["pair", "n"])


def background(found: DataFrame) -> Background:
    """The corpus' chain of classes; its few counts alone reach the driver."""
    pairs = np.zeros(_STATES * _STATES, np.int64)
    for r in found.where("pairs is not null").select("pairs").mapInArrow(_summed, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] = r["n"]
    return Background(pairs)


def infer(found: DataFrame, fit_values: int = FIT_VALUES) -> Formats | None:
    """An automaton per kind from the distinct credentials of all documents,
    of which about ``fit_values`` per kind are drawn by hash; none without credentials."""
    values = found.select(F.explode("base").alias("b")).groupBy("b.kind", "b.value").count().withColumn("u", F.pmod(F.xxhash64("value"), F.lit(1 << 30)))
    n = {r["kind"]: (r["values"], r["seen"]) for r in values.groupBy("kind").agg(F.count("*").alias("values"), F.sum("count").alias("seen")).collect()}
    if not n:
        return None
    cut = F.create_map(*[x for k, (c, _) in n.items() for x in (F.lit(k), F.lit(int(min(1.0, fit_values / c) * (1 << 30))))])
    chosen = defaultdict(list)
    for r in values.where(F.col("u") < F.element_at(cut, F.col("kind"))).select("kind", "value").collect():
        chosen[r["kind"]].append(r["value"])
    return Formats({k: Automaton(sorted(v)) for k, v in sorted(chosen.items())}, {k: seen for k, (_, seen) in n.items()}, background(found))


def _report(formats):
    def run(batches):
        for batch in batches:
            rows = []
            for body in batch.column("text").to_pylist():
                spans = [(s, k, e) for s, k, e, _ in base_spans(body or "")]
                more = [(s, KINDS.index(k), e) for s, e, k in formats.find(body or "", [(s, e) for s, _, e in spans])] if formats else []
                text = lambda x: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))
                n = [sum(k == i for _, k, _ in spans) for i in range(3)]
                rows.append((*n, hashlib.sha256(text(spans).encode()).hexdigest(), text(spans + more), len(more)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred"])

    return run


def report(docs: DataFrame, formats: Formats | None) -> DataFrame:
    """Counts, digest and spans of every row."""
    schema = typed(docs, ["doc_id"], "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_inferred bigint")
    return docs.select("doc_id", "text").mapInArrow(_report(formats), schema)


def redact_text(text: str, formats: Formats | None) -> str:
    """The text with every secret replaced by its kind in angle brackets; of
    an assignment only the value goes."""
    base = base_spans(text)
    cuts = [(e - len(v), e, KINDS[k]) for _, k, e, v in base]
    if formats:
        cuts += formats.find(text, [(s, e) for s, _, e, _ in base])
    out, done = [], 0
    for s, e, k in sorted(cuts):
        if e <= done:
            continue
        out += [text[done : max(s, done)], f"<{k}>"]
        done = e
    return "".join(out) + text[done:] if cuts else text


def redact(docs: DataFrame, formats: Formats | None) -> DataFrame:
    """``docs`` with secrets redacted in ``text`` (null stays null)."""

    @F.pandas_udf("string")
    def clean(text):
        return text.map(lambda t: redact_text(t, formats), na_action="ignore")

    name = fresh(docs, "clean")
    out = docs.withColumn(name, clean(F.col("text")))
    return out.select(*[F.col(name).alias("text") if c == "text" else F.col(c) for c in docs.columns])
