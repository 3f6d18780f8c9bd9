"""Quality rules: a decision list learned from labelled statistics, applied as Spark conditions.

``statistics`` measures texts with DataFrame functions. ``learn`` builds rules for the rejected class
by sequential covering: a rule grows threshold by threshold on two thirds of the labelled rows while
its information gain rises, is pruned on the other third, and the rows it covers are taken out before
the next one. ``verdict`` writes the list as one ordered conditional expression.

Learning uses the ``sample_rows`` labelled documents with the smallest hash of doc_id.

Defined results: a null or blank text has zero in every statistic (shares of nothing are 0);
repeated rows are measured each; a doc_id labelled both ways counts as rejected; without labelled rows
of both classes the list is empty and accepts; an empty table gives no rows; further columns are kept
by ``statistics`` unless their names are those of statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 4000
THRESHOLDS = 64
MAX_RULES = 24
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
MIN_COVER = 4

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [
    "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share",
    "mark_share", "stop_share", "line_words",
]
FEATURES = ["n_words", *SHARES]
WHITE = " \t\n\x0b\f\r"
# Fixed list: frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for der die und das von zu den mit le la les de et un une que el los y en por con"
).split()


def _without(text: Column, letters: str) -> Column:
    return F.char_length(F.translate(text, letters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with BASE (long) and SHARES (double) of the column text.

    Arrays that a lambda looks into are columns of an earlier step, so each is made once per row. Equal
    three-word windows are found by sorting their 64-bit hashes with their positions.
    """
    names = [c for c in docs.columns if c not in (*BASE, *SHARES)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        *names,
        text.alias("_text"),
        F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: F.translate(line, WHITE, "") != "").alias("_lines"),
    )
    windows = F.slice(
        F.transform("_words", lambda w, i: F.struct(F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i"))),
        1, F.greatest(F.size("_words") - 2, F.lit(0)),
    )
    sorted_ = split.withColumn("_windows", F.sort_array(windows))

    def twice(x: Column, k: Column) -> Column:
        same = lambda other: F.coalesce(F.get("_windows", other)["h"] == x["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    found = sorted_.withColumn("_found", F.sort_array(F.transform(F.filter("_windows", twice), lambda x: x["i"])))
    covered = F.transform("_found", lambda p, k: F.coalesce(F.least(F.get("_found", k + 1) - p, F.lit(3)), F.lit(3)))
    base = found.select(
        *names, "_text", "_words", "_lines",
        F.size("_words").cast("long").alias("n_words"),
        _without(F.col("_text"), WHITE).cast("long").alias("word_chars"),
        (F.char_length("_text") - _without(F.col("_text"), "#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )
    lower = F.lower("_text")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))

    chars, words, lines = F.col("word_chars"), F.col("n_words"), F.size("_lines")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    measured = [
        *BASE,
        share(chars, words).alias("word_length"),
        share(F.col("n_symbols"), chars).alias("symbol_share"),
        share(F.col("n_dup_lines"), lines).alias("dup_line_share"),
        share(F.col("n_repeat_words"), words).alias("repeat_share"),
        share(F.size(F.array_distinct("_words")), words).alias("distinct_share"),
        share(F.char_length("_text") - _without(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars).alias("upper_share"),
        share(F.char_length("_text") - _without(F.col("_text"), "0123456789"), chars).alias("digit_share"),
        share(F.char_length("_text") - _without(F.col("_text"), "!?"), words).alias("mark_share"),
        share(F.size(F.array_intersect(F.split(lower, "[ \\t-\\r]+"), stop)), F.lit(len(STOP_WORDS))).alias("stop_share"),
        share(words, lines).alias("line_words"),
    ]
    # a filter on a statistic stays above this step; pushed further it would repeat the arrays
    return base.select(*names, F.inline(F.array(F.struct(*measured))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= value, else feature <= value
    value: float

    def mask(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        x = columns[self.feature]
        return x >= self.value if self.above else x <= self.value

    def column(self) -> Column:
        x = F.col(self.feature)
        return x >= F.lit(self.value) if self.above else x <= F.lit(self.value)


Rule = list[Condition]


def covers(rule: Rule, columns: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(columns.values()))), bool)
    for c in rule:
        out &= c.mask(columns)
    return out


def _candidates(columns: dict[str, np.ndarray]) -> list[Condition]:
    out = []
    for name, x in columns.items():
        steps = np.unique(np.quantile(x, np.linspace(0, 1, THRESHOLDS), method="nearest"))
        for low, high in zip(steps, steps[1:]):
            middle = float((low + high) / 2)
            out += [Condition(name, True, middle), Condition(name, False, middle)]
    return out


def _grow(columns: dict[str, np.ndarray], bad: np.ndarray, candidates: list[Condition], masks: np.ndarray) -> Rule:
    rule, now = [], np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = (now & bad).sum(), (now & ~bad).sum()
        if not p0 or not n0:
            break
        p, n = masks[:, now & bad].sum(1), masks[:, now & ~bad].sum(1)
        gain = p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - np.log2(p0 / (p0 + n0)))
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9:
            break
        rule.append(candidates[best])
        now &= masks[best]
    return rule


def _prune(rule: Rule, columns: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = covers(r, columns)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n + 1)

    ends = range(len(rule), 0, -1)
    best = max(ends, key=lambda k: (worth(rule[:k]), k))
    return rule[:best]


def learn(columns: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules whose rows are rejected. A rule is kept if, on all rows that no earlier rule
    covers, it hits MIN_COVER rejected ones at least and is right in MIN_PRECISION of its hits."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < MAX_RULES and (left & bad).any() and (~bad).any():
        grow, check = left & ~third, left & third
        part = {k: v[grow] for k, v in columns.items()}
        candidates = _candidates(part)
        if not candidates:
            break
        rule = _grow(part, bad[grow], candidates, np.stack([c.mask(part) for c in candidates]))
        if not rule:
            break
        rule = _prune(rule, {k: v[check] for k, v in columns.items()}, bad[check]) if check.any() else rule
        hit = covers(rule, columns) & left
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False where a rule covers the row, tried in order; else true."""
    out = F
    for rule in rules:
        condition = F.lit(True)
        for c in rule:
            condition = condition & c.column()
        out = out.when(condition, F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from labels (doc_id, quality 0 or 1) of ``docs`` (doc_id, text)."""
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )  # sample_rows rows
    rows = statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    found = sorted(rows.dropDuplicates(["doc_id"]).select("doc_id", "_quality", *FEATURES).collect())
    columns = {name: np.array([r[name] for r in found], float) for name in FEATURES}
    return learn(columns, np.array([r["_quality"] == 0 for r in found], bool))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics and accepted, the list's verdict."""
    return statistics(docs).withColumn("accepted", verdict(rules))
