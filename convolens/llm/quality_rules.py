"""Learned decision lists over document statistics, as ordered Spark conditions.

Statistics come from built-in functions only.  Rules are conjunctions of thresholds, learned by sequential covering on
a bounded sample of labelled rows: each rule is grown greedily on two thirds of the sample by information gain, pruned
backwards on the rest, and takes the rows it covers out before the next one.  The list becomes one CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import settle

#: Labelled rows that the learner sees at most, the lowest by a hash of the id.
SAMPLE_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
REPEAT_WIDTH = 8
#: Share of rejected rows a rule must have on the pruning part, and on the growing part, to enter the list.
LEAST_PRECISION = 0.97
MOST_RULES = 8
MOST_CONDITIONS = 4
THRESHOLDS = 24

FEATURES = ("n_words", "mean_word", "symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share", "top_word_share", "words_a_line", "bare_mark_share")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rejecting rules in order; a document that none covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule_index(self) -> Column:
        """Number of the first rule that covers a row, null if none does."""
        out: Column | None = None
        for k, rule in enumerate(self.rules):
            both = F.lit(True)
            for c in rule:
                both = both & c.column()
            out = F.when(both, F.lit(k)) if out is None else out.when(both, F.lit(k))
        return F.lit(None).cast("int") if out is None else out

    def accepts(self) -> Column:
        return self.rule_index().isNull()

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nkeep"


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row of statistics for each row of ``docs`` (null text: none of anything).

    Words are runs of characters other than ASCII white space; n_repeat_words counts the words in 8-word windows
    found twice or more in the text.  Windows are compared by a 64-bit hash inside one text.
    """
    text = F.coalesce(F.col("__text"), F.lit(""))
    gone = lambda c, chars: F.length(c) - F.length(F.translate(c, chars, ""))
    keep = [docs[c] for c in carry if c != "doc_id"]
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("__text"), *keep)
    d = d.withColumn("words", F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    d = d.withColumn("lines", F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != ""))
    d = d.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    last = F.size("codes") - REPEAT_WIDTH
    d = d.withColumn(
        "grams",
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get("codes", i + k) for k in range(REPEAT_WIDTH))))).otherwise(F.array().cast("array<bigint>")),
    )
    d = d.withColumn("n_words", F.size("words").cast("long")).withColumn("some_repeat", F.size(F.array_distinct("grams")) < F.size("grams"))
    # Sorted (gram, place) pairs put equal windows side by side; their places, in order, cover up to eight words each.
    pairs = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    d = d.withColumn("pairs", F.when(F.col("some_repeat"), pairs))
    again = F.filter("pairs", lambda p, i: (p["g"] == F.get("pairs", i - 1)["g"]) | (p["g"] == F.get("pairs", i + 1)["g"]))
    d = d.withColumn("places", F.array_sort(F.transform(again, lambda p: p["i"])))
    cover = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(REPEAT_WIDTH), F.coalesce(F.get("places", i + 1), p + REPEAT_WIDTH) - p).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
    )
    whole = F.length(text)
    d = d.select(
        "doc_id",
        *(c for c in carry if c != "doc_id"),
        "n_words",
        (whole - gone(text, SPACES)).cast("long").alias("word_chars"),
        gone(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("codes")).cast("long").alias("n_distinct"),
        gone(text, "!?.,;:").cast("long").alias("n_marks"),
        gone(text, "!").cast("long").alias("n_shouts"),
        gone(text, "0123456789").cast("long").alias("n_digits"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.filter("words", lambda w: F.translate(w, "|#*$%&<>!?.,;:-_=+/\\~", "") == "")).cast("long").alias("n_bare"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return d.withColumns(
        {
            "mean_word": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "upper_share": share("n_upper", "word_chars"),
            "mark_share": share("n_marks", "word_chars"),
            "digit_share": share("n_digits", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "top_word_share": share("n_distinct", "n_words"),
            "words_a_line": share("n_words", "n_lines"),
            "bare_mark_share": share("n_bare", "n_words"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """Information gain of a narrowed rule, counted on the rows it still covers."""
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def _covers(rows: list[tuple], rule: list[tuple[int, bool, float]]) -> list[tuple]:
    return [r for r in rows if all((r[f] > t) == up for f, up, t in rule)]


def _grow(rows: list[tuple]) -> list[tuple[int, bool, float]]:
    """Add the condition of greatest gain until only rejected rows are covered.  Rows end with their label (1: good)."""
    rule: list[tuple[int, bool, float]] = []
    for _ in range(MOST_CONDITIONS):
        good0 = sum(r[-1] for r in rows)
        bad0 = len(rows) - good0
        if not bad0 or not good0:
            break
        best, best_gain = None, 1e-9
        for f in range(len(FEATURES)):
            ordered = sorted((r[f], r[-1]) for r in rows)
            values = [v for v, _ in ordered]
            marks = sorted({values[min(len(values) - 1, len(values) * k // THRESHOLDS)] for k in range(THRESHOLDS)})
            bad_values = [v for v, y in ordered if not y]
            marks = sorted({*marks, *(bad_values[min(len(bad_values) - 1, len(bad_values) * k // THRESHOLDS)] for k in range(THRESHOLDS))})
            at = bad = good = 0
            for t in marks:
                while at < len(ordered) and values[at] <= t:
                    good += ordered[at][1]
                    bad += 1 - ordered[at][1]
                    at += 1
                for up, b, g in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                    if 0 < b + g < len(rows) and (gain := _gain(b, g, bad0, good0)) > best_gain:
                        # Halfway to the next value, so that the border isn't a value of the sample.
                        best, best_gain = (f, up, (t + values[at]) / 2 if at < len(values) else t), gain
        if best is None:
            break
        rule.append(best)
        rows = _covers(rows, [best])
    return rule


def _worth(rows: list[tuple], rule: list[tuple[int, bool, float]]) -> float:
    hit = _covers(rows, rule)
    bad = sum(1 - r[-1] for r in hit)
    return (bad - (len(hit) - bad)) / len(hit) if hit else -1.0


def learn(labelled: DataFrame, *, label_col: str = "quality", rows: int = SAMPLE_ROWS) -> DecisionList:
    """Fit a list on at most ``rows`` rows of ``labelled`` (features and a 0/1 label; nulls are left out).

    Without rejected or without accepted rows the list is empty and keeps everything.
    """
    order = F.xxhash64("doc_id")
    usable = labelled.where(F.col(label_col).isin(0, 1))
    # Only about as many rows as are wanted may reach the driver, however many tasks read them.
    share = min(1.0, 1.2 * rows / max(1, usable.count()))
    usable = usable if share >= 1 else usable.where(order < int(-(2**63) + share * 2**64))
    taken = usable.select(order.alias("o"), *(F.col(f).cast("double") for f in FEATURES), F.col(label_col).cast("int")).orderBy("o", *FEATURES).limit(rows).collect()
    data = [tuple(r)[1:] for r in taken]
    prune = data[::3]
    grow = [r for k, r in enumerate(data) if k % 3]
    found = DecisionList()
    while len(found.rules) < MOST_RULES and any(not r[-1] for r in grow):
        rule = _grow(grow)
        if not rule:
            break
        best, worth = rule, _worth(prune, rule)
        while len(best) > 1 and (shorter := max((best[:k] + best[k + 1 :] for k in range(len(best))), key=lambda x: _worth(prune, x))) and _worth(prune, shorter) >= worth:
            best, worth = shorter, _worth(prune, shorter)
        hit, seen = _covers(grow, best), _covers(prune, best)
        sure = lambda x: sum(1 - r[-1] for r in x) >= LEAST_PRECISION * len(x)
        if not hit or not sure(hit) or not sure(seen):
            break
        found.rules.append([Condition(FEATURES[f], up, t) for f, up, t in best])
        grow = [r for r in grow if not all((r[f] > t) == up for f, up, t in best)]
        prune = [r for r in prune if not all((r[f] > t) == up for f, up, t in best)]
    return found


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: tuple[str, ...] = ()) -> tuple[DataFrame, DecisionList]:
    """Statistics of every row of ``docs`` with base_failed, rule (the first rejecting rule) and kept, and the list.

    Null, empty and short texts fail the base rules.  Repeated rows each get a row; a null id has no label but is
    judged like any other.  Conflicting labels of one id count as its lowest.
    """
    stats = settle(statistics(docs, id_col=id_col, text_col=text_col, carry=carry), "statistics")
    votes = labels.groupBy(labels[id_col].cast("long").alias("doc_id")).agg(F.min(label_col).alias("label"))
    found = learn(stats.where(~base_failed()).join(votes, "doc_id"), label_col="label")
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", found.rule_index())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), found
