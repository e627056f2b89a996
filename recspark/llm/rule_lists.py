"""Quality rules: base counts of a text and a learned decision list over them.

Only DataFrame functions are used. The list is grown by sequential covering on counts that Spark aggregates, so the
driver sees numbers of rows and no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.sources.scratch import written

WINDOW = 8
_WHITE = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def _without(text: Column, chars: Sequence[str]) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)


def _with_later(name: str, step: int):
    return lambda x, i: F.xxhash64(x, F.get(F.col(name), i + step))


def base_stats(docs: DataFrame, carry: str = "doc_id") -> DataFrame:
    """``carry`` and counts of each text, one row per row of ``docs``; null counts as empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks (``!``), n_adjacent (words equal to the word
    before), n_lines (lines with a word). Words are ``[^\\x20\\x09-\\x0D]+``; n_repeat_words counts the words inside
    8-word windows that the text has twice or more. Work for one text is that of a sort of its windows at most, and
    that only where a window repeats.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    bare = _without(t, _WHITE)
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(_without(x, _WHITE)) > 0)
    a = docs.select(
        carry,
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, list("#*$%&|<>")))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(_without(t, ["!"]))).cast("long").alias("n_marks"),
        lines.alias("lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("h1"),
    )
    a = a.select(
        carry, "word_chars", "n_symbols", "n_marks", "h1",
        F.size("h1").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    # hashes of 2, 4 and then 8 words, each from two of the hashes before
    for short, long, step in (("h1", "h2", 1), ("h2", "h4", 2), ("h4", "h8", 4)):
        n = F.greatest(F.size(short) - step, F.lit(0))
        a = a.withColumn(long, F.transform(F.slice(short, F.lit(1), n), _with_later(short, step)))
    same = F.size(F.filter("h1", lambda x, i: (i > 0) & (x == F.get(F.col("h1"), i - 1)))).cast("long")
    a = a.withColumn("n_adjacent", same).drop("h2", "h4")
    ordered = F.sort_array(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    a = a.withColumn("ordered", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), ordered))
    a = a.withColumn("at", F.sort_array(F.transform(
        F.filter("ordered", lambda x, i: (F.get(F.col("ordered"), i - 1)["h"] == x["h"]) | F.coalesce(F.get(F.col("ordered"), i + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"])))
    # a window covers its words up to the next repeated window
    covered = F.transform("at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - x, F.lit(WINDOW))))
    repeat = F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).cast("long")
    return a.select(carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"), "n_marks", "n_adjacent", "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


#: What a literal may compare, each from the counts alone.
FEATURES: dict[str, Column] = {}


def features() -> dict[str, Column]:
    if not FEATURES:
        FEATURES.update({
            "symbols_per_word": _share("n_symbols", "n_words"),
            "marks_per_word": _share("n_marks", "n_words"),
            "dup_line_share": _share("n_dup_lines", "n_lines"),
            "repeat_word_share": _share("n_repeat_words", "n_words"),
            "adjacent_share": _share("n_adjacent", "n_words"),
            "chars_per_word": _share("word_chars", "n_words"),
            "n_words": F.col("n_words").cast("double"),
        })
    return FEATURES


@dataclass(frozen=True)
class Literal:
    feature: str
    op: str  # ">=" or "<="
    threshold: float

    def column(self) -> Column:
        f = features()[self.feature]
        return f >= self.threshold if self.op == ">=" else f <= self.threshold


Rule = tuple[Literal, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (x.column() for x in rule), F.lit(True))


def verdict(rules: Sequence[Rule]) -> Column:
    """The list as one conditional expression: false at the first rule that holds, true if none does."""
    out = None
    for r in rules:
        out = F.when(holds(r), F.lit(False)) if out is None else out.when(holds(r), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


#: Quantiles besides the even ones, for kinds of junk at the ends of a feature.
TAILS = (0.0, 0.01, 0.02, 0.05, 0.95, 0.98, 0.99, 1.0)


def _candidates(rows: DataFrame, n_cuts: int) -> list[Literal]:
    """Literals at quantiles of the bad ones of ``rows``, and where many share one value of a feature, at quantiles above and below that value.

    So a kind of junk with its own values of a feature gets cuts there, however small its share of the rows is.
    """
    cuts = sorted({i / n_cuts for i in range(1, n_cuts)} | set(TAILS))
    names = list(features())
    bad = rows.where("label = 0")
    got = bad.agg(*[F.percentile_approx(features()[n], cuts, 2000).alias(n) for n in names]).first()
    found = {(n, float(v)) for n in names for v in got[n] or []}
    common = {n: max(set(got[n]), key=got[n].count) for n in names if got[n]}
    common = {n: v for n, v in common.items() if got[n].count(v) > 1}
    if common:
        parts = []
        for n, v in common.items():
            f = features()[n]
            parts += [F.percentile_approx(F.when(side, f), cuts, 2000).alias(f"{n}_{k}") for k, side in (("above", f > v), ("below", f < v))]
        around = bad.agg(*parts).first()
        found |= {(n, float(x)) for n in common for k in ("above", "below") for x in around[f"{n}_{k}"] or []}
    return sorted((Literal(n, op, v) for n, v in found for op in (">=", "<=")), key=lambda x: (x.feature, x.op, x.threshold))


def _counts(rows: DataFrame, base: Column, literals: Sequence[Literal]) -> list[tuple[int, int]]:
    """(bad, good) rows on which ``base`` and each literal hold, in one aggregation."""
    sums = []
    for i, x in enumerate(literals):
        on = x.column()
        sums += [F.sum(F.when(on, F.col("w_bad")).otherwise(0)).alias(f"b{i}"), F.sum(F.when(on, F.col("w_good")).otherwise(0)).alias(f"g{i}")]
    got = rows.where(base).agg(*sums).first()
    return [(got[f"b{i}"] or 0, got[f"g{i}"] or 0) for i in range(len(literals))]


def _rule_counts(rows: DataFrame, base: Column, rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """(bad, good) rows on which ``base`` and each rule hold, in one aggregation."""
    sums = [F.sum(F.when(holds(r), F.col(w)).otherwise(0)).alias(f"{w}{i}") for i, r in enumerate(rules) for w in ("w_bad", "w_good")]
    got = rows.where(base).agg(*sums).first()
    return [(got[f"w_bad{i}"] or 0, got[f"w_good{i}"] or 0) for i in range(len(rules))]


def learn(rows: DataFrame, max_rules: int = 6, max_literals: int = 3, n_cuts: int = 12, purity: float = 0.97, least_share: float = 0.01) -> list[Rule]:
    """An ordered list of conjunctions that pick label 0 out of rows of counts with a column label (0 or 1).

    Sequential covering: a rule is grown literal by literal by the information gained on two thirds of the rows, then
    literals are cut from its end while that doesn't lower its purity on the other third; rules stay if they are pure
    to ``purity`` there and cover ``least_share`` of the bad rows. Rows that a rule covers leave, and the next is grown,
    with thresholds from the rows that are left. After a rule that doesn't stay, another first literal is tried.
    Rows without label are left out; without rows of both labels the list is empty and everything is kept.
    """
    import math

    rows = rows.where("label is not null").withColumn("w_bad", F.when(F.col("label") == 0, 1).otherwise(0)).withColumn("w_good", 1 - F.col("w_bad"))
    rows = written(rows.withColumn("grow", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) < 2), "labelled")
    n_bad, n_good = (rows.agg(F.sum("w_bad").alias("b"), F.sum("w_good").alias("g")).first()[k] or 0 for k in ("b", "g"))
    rules: list[Rule] = []
    if not n_bad or not n_good:
        return rules
    every = [Literal("n_words", ">=", -1.0)]
    least = max(1, least_share * n_bad / 3)
    grown, held = rows.where("grow"), rows.where("not grow")
    left = F.lit(True)
    while len(rules) < max_rules:
        (bad, good), = _counts(grown, left, every)
        if not bad or not good:
            break
        literals = _candidates(rows.where(left), n_cuts)
        alone = _counts(grown, left, literals)
        # no rule that begins with a literal covers more than the literal does
        open_ = {i for i, (b, _) in enumerate(_counts(held, left, literals)) if b >= least}
        found: Rule | None = None
        while open_ and found is None:
            rule, first, now = (), None, (bad, good)
            while len(rule) < max_literals and all(now):
                counts = alone if not rule else _counts(grown, left & holds(rule), literals)
                gain = [b * (math.log2((b + 1) / (b + g + 2)) - math.log2((now[0] + 1) / (sum(now) + 2))) for b, g in counts]
                best = max(range(len(literals)) if rule else sorted(open_), key=lambda i: gain[i])
                if gain[best] <= 0 or counts[best] == now:
                    break
                first = best if first is None else first
                rule, now = (*rule, literals[best]), counts[best]
            if not rule:
                break
            prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
            worth = [((b + 1) / (b + g + 2), b, g) for b, g in _rule_counts(held, left, prefixes)]
            i = max(range(len(prefixes)), key=lambda k: (worth[k][0], -k))
            _, b, g = worth[i]
            if b >= least and b / (b + g) >= purity:
                found = prefixes[i]
            else:
                open_.discard(first)
        if found is None:
            break
        rules.append(found)
        left = left & ~holds(found)
    return rules


#: Labels that may be broadcast, so that only labelled texts are counted to learn from; with more, all texts are counted first. The list is the same.
BROADCAST_LABELS = 1_000_000


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned list, as they are, without a shuffle of texts.

    The list is learned from all labelled documents; every text is then counted in whole and judged.
    """
    known = written(labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label")), "known")
    texts = docs.select("doc_id", "text")
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
        texts = texts.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    stats = written(base_stats(texts), "counts")
    rules = learn(stats.where(~base_failed()).dropDuplicates(["doc_id"]).join(known, "doc_id"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")
    # a row number that the filter reads keeps the filter above the counts; pushed below, every use would repeat their expressions
    counted = base_stats(whole, "__row").withColumn("__at", F.monotonically_increasing_id())
    return counted.where((F.col("__at") >= 0) & ~base_failed() & verdict(rules)).select("__row.*")


def judged(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """Counts of every row of ``docs`` with base_failed and kept; the list is learned from ``labels`` (doc_id, quality).

    ``train`` limits the rows of labels to learn from. Texts that fail the base rules are rejected and aren't learned
    from. A document without text fails; repeated rows are judged each; an empty table gives no rows.
    """
    stats = written(base_stats(docs).withColumn("base_failed", base_failed()), "counts")
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    known = known.where(train) if train is not None else known
    rules = learn(stats.where("not base_failed").dropDuplicates(["doc_id"]).join(known, "doc_id"))
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules))
