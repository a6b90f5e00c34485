"""Quality rules: a decision list learned from labelled documents, with built-in functions only.

Sequential covering: a rule is a conjunction of thresholds on a document's statistics. It grows on
two thirds of the labelled rows, each time by the threshold with the greatest information gain, and
is cut back to the beginning that does best on the other third. Rows it covers are set aside and the
next rule is sought, until one is not precise enough. The list becomes one ordered CASE expression.

Thresholds are quantiles, so a row counts by the bins its statistics fall in. One aggregate over the
bins gives the counts of every threshold of every statistic at once; the driver sees only those.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed

# At most about so many labelled documents are learned from, chosen by a hash of their id.
LEARN_DOCS = 500_000
BINS = 32
MAX_RULES, MAX_CONDITIONS = 8, 4
# A rule is kept if so large a part of what it covers was labelled bad, and it covers so many.
LEAST_PRECISION, LEAST_COVERED = 0.95, 5

SPACE = r"[ \t-\r]+"
WINDOW = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_upper", "n_marks", "n_bars"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """How many words are in a window of WINDOW words that the text has twice or more."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW),
                         lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))

    def covered(at: Column) -> Column:
        """The words covered by windows that begin at these places, in order."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
        return F.aggregate(at, start, lambda acc, i: F.struct(
            (acc["n"] + i + WINDOW - F.greatest(i, acc["reach"])).alias("n"),
            (i + WINDOW).alias("reach")), lambda acc: acc["n"])

    def repeated(hashes: Column) -> Column:
        # Equal hashes stand next to each other once sorted.
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: covered(F.sort_array(F.transform(
            F.filter(p, lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"]))
                     | ((i < F.size(p) - 1) & (F.get(p, i + 1)["h"] == x["h"]))),
            lambda x: x["i"]))))

    return F.when(n < WINDOW, 0).otherwise(let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(repeated(h))))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text; a null text has no words.

    Words are runs of other than white space. `n_dup_lines`: lines with a word that equal an earlier
    line. `n_upper`, `n_marks` and `n_bars`: characters A-Z, any of ! and ?, and |.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(docs["doc_id"], docs["text"]).select(
        "doc_id", text.alias("text"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]")).alias("lines"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("words")),
        "n_upper": F.regexp_count("text", F.lit("[A-Z]")),
        "n_marks": F.regexp_count("text", F.lit("[!?]")),
        "n_bars": F.regexp_count("text", F.lit(r"\|")),
    }
    return split.select("doc_id", *[counts[n].cast("long").alias(n) for n in COUNTS])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _features() -> dict[str, Column]:
    """What rules test, found from the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {"n_words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / words,
            "symbols": F.col("n_symbols") / chars, "dup_lines": F.col("n_dup_lines") / words,
            "repeats": F.col("n_repeat_words") / words, "upper": F.col("n_upper") / chars,
            "marks": F.col("n_marks") / words, "bars": F.col("n_bars") / words}


@dataclass(frozen=True)
class Condition:
    """feature > threshold if `above`, else feature <= threshold."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = _features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = list[Condition]


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


class _Learner:
    """Rows as arrays of bins with their label, and the rules found so far."""

    def __init__(self, labelled: DataFrame):
        features = _features()
        self.names = list(features)
        values = labelled.select(F.array(*features.values()).alias("x"), "bad", "grow")
        cuts = values.agg(*[F.percentile_approx(
            F.col("x")[i], [k / BINS for k in range(1, BINS)], 10_000) for i in range(len(features))
        ]).first()
        self.cuts = [sorted({c for c in (row or [])}) for row in cuts]
        # A value's bin: how many thresholds it exceeds.
        bins = F.array(*[sum((F.col("x")[i] > c).cast("int") for c in own) if own else F.lit(0)
                         for i, own in enumerate(self.cuts)])
        self.rows = checkpointed(values.select(bins.alias("bins"), "bad", "grow")
                                 .groupBy("bins", "bad", "grow").agg(F.count("*").alias("n")))

    def _test(self, condition: Condition) -> Column:
        i = self.names.index(condition.feature)
        place = self.cuts[i].index(condition.threshold)
        own = F.col("bins")[i]
        return own > place if condition.above else own <= place

    def _covers(self, rule: Rule) -> Column:
        return reduce(lambda a, b: a & b, [self._test(c) for c in rule], F.lit(True))

    def _best(self, rows: DataFrame, rule: Rule) -> Condition | None:
        """The condition to add with the greatest gain over the rule as it is."""
        table = {(r.i, r.bin): (r.bad, r.good) for r in rows.where(
            F.col("grow") & self._covers(rule)).select(F.posexplode("bins").alias("i", "bin"),
                                                       "bad", "n").groupBy("i", "bin").agg(
            F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("good")).collect()}
        best, most = None, 1e-9
        for i, name in enumerate(self.names):
            own = [table.get((i, b), (0, 0)) for b in range(len(self.cuts[i]) + 1)]
            all_bad, all_good = sum(o[0] for o in own), sum(o[1] for o in own)
            if not all_bad:
                return None
            bad = good = 0
            for place, threshold in enumerate(self.cuts[i]):
                bad, good = bad + own[place][0], good + own[place][1]
                for above, b, g in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                    gain = _gain(b, g, all_bad, all_good)
                    if gain > most:
                        best, most = Condition(name, above, threshold), gain
        return best

    def _pruned(self, rows: DataFrame, rule: Rule) -> tuple[Rule, float, int]:
        """The beginning of a rule that does best on rows it did not grow on."""
        sums = rows.where(~F.col("grow")).agg(*[
            F.coalesce(F.sum(F.when(self._covers(rule[:k]) & test, F.col("n"))), F.lit(0))
            for k in range(1, len(rule) + 1) for test in (F.col("bad"), ~F.col("bad"))]).first()
        pairs = list(zip(sums[::2], sums[1::2], strict=True))
        worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in pairs]
        k = max(range(len(rule)), key=lambda i: (worth[i], -i))
        bad, good = pairs[k]
        return rule[:k + 1], bad / (bad + good) if bad + good else 0.0, bad

    def rules(self) -> list[Rule]:
        found: list[Rule] = []
        rows = self.rows
        while len(found) < MAX_RULES:
            rule: Rule = []
            while len(rule) < MAX_CONDITIONS:
                condition = self._best(rows, rule)
                if condition is None or condition in rule:
                    break
                rule.append(condition)
            if not rule:
                break
            rule, precision, covered = self._pruned(rows, rule)
            if precision < LEAST_PRECISION or covered < LEAST_COVERED:
                break
            found.append(rule)
            rows = rows.where(~self._covers(rule))
        return found


def learn(stats: DataFrame, labels: DataFrame, learn_docs: int = LEARN_DOCS) -> list[Rule]:
    """Rules for bad documents from `labels` (doc_id, quality: 0 bad, else good).

    Learns from about `learn_docs` labelled rows. Null labels and ids are passed over; of several
    labels of an id the lowest counts. Without bad rows there are no rules.
    """
    quality = labels.select(labels["doc_id"], labels["quality"]).where(
        "doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    number = quality.count()
    scale = 1_000_000
    chosen = F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(scale)) < F.lit(
        min(scale, scale * learn_docs // max(1, number)))
    labelled = stats.join(quality.where(chosen), "doc_id").select(
        *COUNTS, (F.col("quality") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) > 0).alias("grow"))
    return _Learner(labelled).rules()


def verdict(rules: list[Rule]) -> Column:
    """True for documents to keep: the first rule that fits decides, all of them drop."""
    cases = None
    for rule in rules:
        fits = reduce(lambda a, b: a & b, [c.column() for c in rule])
        cases = F.when(fits, F.lit(False)) if cases is None else cases.when(fits, F.lit(False))
    return F.lit(True) if cases is None else cases.otherwise(F.lit(True))


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics with `base_failed` and `kept`: neither that nor dropped by a rule."""
    return stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics and verdict of every row of `docs`; the texts are read once.

    A null text has no words and fails. Repeated rows stay. No rows give no rows.
    """
    stats = checkpointed(statistics(docs))
    return judge(stats, learn(stats, labels)).select("doc_id", *BASE, "base_failed", "kept")
