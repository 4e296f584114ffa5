"""Quality rules: a decision list learned by sequential covering, applied as
ordered Spark conditional expressions (DataFrame functions only).

Defined cases: a null or blank text has no words and fails the base rule; a
null id is kept like any other row and never trains; ties between candidate
conditions go to the feature named first, then the lower bin; labels repeated
for an id count once (the lowest); without usable labels the list is empty and
only the base rule rejects. Texts are used whole, whatever their length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frametide.llm.common import fresh, let, word_array

#: Labelled rows that the list is learned from (expected number, by id hash).
FIT_ROWS = 20_000
BINS = 24
MAX_CONDITIONS = 3
MAX_RULES = 12
#: A rule must be this precise on the rows it was grown on and on those held back for pruning.
MIN_PRECISION = 0.97
MIN_COVER = 5

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes of their five word hashes. A text
    whose windows are all distinct is settled without sorting."""

    def covered(keys: Column) -> Column:
        n = F.size(keys)
        order = F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(s, k - 1)["h"] == x["h"]).otherwise(False)
                after = F.when(k < n - 1, F.get(s, k + 1)["h"] == x["h"]).otherwise(False)
                return before | after

            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))

        def total(at: Column) -> Column:
            # Each repeated window adds the words up to the next one, five at most.
            step = F.transform(at, lambda p, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - p, F.lit(5))))
            return F.aggregate(step, F.lit(0).cast("bigint"), lambda a, x: a + x)

        hit = let(let(order, repeated), total)
        return F.when(F.size(F.array_distinct(keys)) == n, F.lit(0).cast("bigint")).otherwise(hit)

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - 5),
            lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2), F.get(h, i + 3), F.get(h, i + 4)),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    value = let(let(hashes, windows), covered)
    return F.when(F.size(words) < 5, F.lit(0).cast("bigint")).otherwise(value)


def base_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the struct column ``stats``: the contract's counts and the
    learner's features."""
    body = F.coalesce(F.col(text), F.lit(""))
    words, lines, stats = fresh(df, "words__"), fresh(df, "lines__"), fresh(df, "stats")
    out = df.withColumn(words, word_array(F.col(text)))
    out = out.withColumn(lines, F.filter(F.split(body, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    w, ln = F.col(words), F.col(lines)
    counts = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(ln).cast("bigint").alias("n_lines"),
        (F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("bigint").alias("n_upper"),
        (F.length(body) - F.length(F.translate(body, "!?", ""))).cast("bigint").alias("n_shouts"),
    )
    return out.withColumn(stats, counts).drop(words, lines)


def features(s: Column) -> dict[str, Column]:
    """The learner's features, as ratios that don't depend on length."""
    chars, n = F.greatest(s["word_chars"], F.lit(1)), F.greatest(s["n_words"], F.lit(1))
    return {
        "symbol_share": s["n_symbols"] / chars,
        "repeat_share": s["n_repeat_words"] / n,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "upper_share": s["n_upper"] / chars,
        "shout_share": s["n_shouts"] / chars,
        "word_length": s["word_chars"] / n,
        "words_per_line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)),
        "n_words": s["n_words"].cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, cols: dict[str, Column]) -> Column:
        c = cols[self.feature]
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _cover(cells, conditions):
    """Bad and good rows of the cells that meet every (feature, above, bin)."""
    bad = good = 0
    for bins, b, g in cells:
        if all((bins[f] > t) == above for f, above, t in conditions):
            bad, good = bad + b, good + g
    return bad, good


def _grow(cells):
    """Add the condition with the largest information gain until the rule is
    precise or conditions run out."""
    rule = []
    while len(rule) < MAX_CONDITIONS:
        inside = [c for c in cells if all((c[0][f] > t) == above for f, above, t in rule)]
        bad, good = sum(c[1] for c in inside), sum(c[2] for c in inside)
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for f in range(len(inside[0][0])):
            at = {}
            for bins, b, g in inside:
                x = at.setdefault(bins[f], [0, 0])
                x[0] += b
                x[1] += g
            low = [0, 0]
            for t in sorted(at)[:-1]:
                low = [low[0] + at[t][0], low[1] + at[t][1]]
                for above, (b, g) in ((False, low), (True, (bad - low[0], good - low[1]))):
                    if b >= MIN_COVER:
                        gain = b * (math.log2(b / (b + g)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, above, t))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rule, held):
    """Drop trailing conditions while (bad - good) / covered doesn't fall on
    the rows held back."""

    def value(r):
        b, g = _cover(held, r)
        return (b - g) / (b + g) if b + g else -1.0

    while len(rule) > 1 and value(rule[:-1]) >= value(rule):
        rule = rule[:-1]
    return rule


def learn_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[list[Condition]]:
    """Ordered rules whose conjunction marks a text as bad.

    About ``fit_rows`` labelled rows, chosen by id hash, are reduced by Spark
    to counts per cell of quantile bins; growing and pruning work on these
    counts (at most as many cells as sampled rows). A third of the rows is
    held back for pruning."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = marks.count()
    if not n:
        return []
    share = min(1.0, fit_rows / n)
    marks = marks.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = base_stats(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"))
    cols = features(F.col("stats"))
    names = list(cols)
    rows = rows.select("quality", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).alias("held"), *[c.alias(k) for k, c in cols.items()]).checkpoint()
    cuts = rows.agg(*[F.percentile_approx(k, [i / BINS for i in range(BINS)], 10_000).alias(k) for k in names]).first()
    edges = {k: sorted(set(cuts[k] or [])) for k in names}
    # Bin = number of edges below the value; bin b ends at edge b.
    binned = [sum(((F.col(k) > F.lit(float(e))).cast("int") for e in edges[k]), F.lit(0)).alias(k) for k in names]
    cells = (
        rows.select("held", (F.col("quality") == 0).alias("bad"), *binned)
        .groupBy("held", *names)
        .agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g"))
        .collect()
    )
    cells = sorted((r["held"], tuple(r[k] for k in names), r["b"], r["g"]) for r in cells)
    grow = [c[1:] for c in cells if not c[0]] or [c[1:] for c in cells]
    held = [c[1:] for c in cells if c[0]]
    rules = []
    while len(rules) < MAX_RULES:
        rule = _prune(_grow(grow), held)
        b, g = _cover(grow, rule)
        hb, hg = _cover(held, rule)
        if not rule or b < MIN_COVER or b < MIN_PRECISION * (b + g) or hb < MIN_PRECISION * (hb + hg):
            break
        rules.append([Condition(names[f], above, float(edges[names[f]][t] if t < len(edges[names[f]]) else edges[names[f]][-1])) for f, above, t in rule])
        grow = [c for c in grow if not all((c[0][f] > t) == above for f, above, t in rule)]
        held = [c for c in held if not all((c[0][f] > t) == above for f, above, t in rule)]
        if not any(c[1] for c in grow):
            break
    return rules


def fired(rules: list[list[Condition]], s: Column) -> Column:
    """Index of the first rule that holds, or null: a chain of WHENs."""
    cols = features(s)
    out = None
    for i, rule in enumerate(rules):
        test = F.lit(True)
        for c in rule:
            test = test & c.column(cols)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(None).cast("int") if out is None else out.otherwise(F.lit(None).cast("int"))


def judge(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """``docs`` with a struct ``verdict``: the base counts, ``base_failed``,
    ``rule`` (index of the rule that fired) and ``kept``."""
    name = fresh(docs, "stats")
    out = base_stats(docs)
    s = F.col(name)
    failed = (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])
    rule = fired(rules, s)
    verdict = F.struct(*[s[k].alias(k) for k in BASE], failed.alias("base_failed"), rule.alias("rule"), (~failed & rule.isNull()).alias("kept"))
    return out.withColumn(fresh(docs, "verdict"), verdict).drop(name)


def filter_quality(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """The documents that the list keeps, with their own columns."""
    return judge(docs, rules).where(F.col(fresh(docs, "verdict"))["kept"]).select(*[docs[c] for c in docs.columns])
