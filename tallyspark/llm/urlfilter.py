"""URL filter: rules for hosts and paths, and a ratio of two character language models elsewhere.

Both models are variable-order Markov models with Witten-Bell smoothing: a character is predicted from
the longest known context of up to ``ORDER`` - 1 characters, and each context hands the weight of what
it has not seen to the next shorter one. One model is of accepted, one of rejected urls; the score is
the difference of their log-likelihoods per character, and a url is blocked below a threshold that is
calibrated so that at most ``FALSE_BLOCKS`` of the accepted urls kept for calibration fall below it.

Rejected urls are those that a rule blocks and those without a rule whose host has a marker word;
accepted ones are all others but those that a rule allows in spite of a marker. Since a url is thus
among those it is compared with, n-grams of two or more characters that a model met once are left out.
N-grams are counted over all of them but the calibration share, and both models stay tables: nothing of them is
broadcast or brought to the driver, however many n-grams there are. A character and its longest context are
a window; the score of every window that occurs is made level by level, each n-gram from the one a character shorter,
and urls are joined to the scores of their windows. The threshold is a quantile over all calibration urls.

Defined results: a url that is null or has no ``://`` has empty host and path and is judged by the
models as an empty text, whose score is 0: it is allowed; equal urls get equal verdicts; without
accepted or rejected urls there is no model and the verdict is allow; an empty table gives no rows;
further columns are kept, except those with the names of results.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

ORDER = 6
CLASSES = ("accepted", "rejected")
RESULTS = ["host", "path", "rule", "score", "verdict"]
FALSE_BLOCKS = 0.01
CALIBRATION = 5  # one labelled url in so many
ALPHABET = 256.0
START = "\x02"

# A choice of rules (host and path -> verdict), and words of unwanted hosts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
MARKERS = ["adult", "casino", "porn", "xxx", "bet", "poker", "viagra", "spam", "malware", "phish", "torrent", "warez"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    host, path = part(1), part(2)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with its path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def with_rules(pages: DataFrame, rules: dict[str, str], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and ruled, the rule's verdict or null."""
    host, path = host_and_path(F.col(url).cast("string"))
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "ruled")]
    placed = pages.select(*names, host.alias("host"), path.alias("path"))
    says = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else F.create_map(F.lit(""), F.lit(""))
    return placed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("ruled", says[F.col("rule")])


def model_text(url: Column) -> Column:
    """What the models read: the url after ``://``, in lower case."""
    at = F.instr(url, "://")
    return F.lower(F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.char_length(url))), F.lit("")))


def count_grams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, accepted, rejected): n-grams of 1 to ``order`` characters over all rows (text, rejected).
    Tasks add up their own counts before the shuffle."""

    def run(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for text, rejected in zip(batch["text"].to_pylist(), batch["rejected"].to_pylist()):
                own, padded = counts[bool(rejected)], START * (order - 1) + text + START
                for n in range(1, order + 1):
                    own.update([padded[i - n + 1 : i + 1] for i in range(order - 1, len(padded))])
            grams = list(counts[0] | counts[1])
            columns = [pa.array(grams, pa.string()), *(pa.array([c[g] for g in grams], pa.int64()) for c in counts)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "accepted", "rejected"])

    parts = labelled.select("text", "rejected").mapInArrow(run, "gram string, accepted long, rejected long")
    return parts.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


@dataclass(frozen=True)
class Markov:
    """One model in memory, for a small set of urls; the tables of ``window_scores`` give the same values."""

    order: int
    seen: dict[str, float]  # gram -> log probability of its last character after the others
    handed: dict[str, float]  # context -> log of the weight handed to the shorter context

    @classmethod
    def of(cls, counts: dict[str, int], order: int) -> "Markov":
        followers, totals = defaultdict(int), defaultdict(int)
        for gram, n in counts.items():
            followers[gram[:-1]] += 1
            totals[gram[:-1]] += n
        share: dict[str, float] = {}
        for gram in sorted(counts, key=len):
            context = gram[:-1]
            whole = totals[context] + followers[context]
            shorter = share.get(gram[1:], 0.0) if len(gram) > 1 else 1 / ALPHABET
            share[gram] = (counts[gram] + followers[context] * shorter) / whole
        handed = {c: math.log(followers[c] / (totals[c] + followers[c])) for c in totals}
        return cls(order, {g: math.log(p) for g, p in share.items() if p > 0}, handed)

    def log_likelihood(self, text: str) -> float:
        padded, total, order = START * (self.order - 1) + text + START, 0.0, self.order
        seen, handed = self.seen, self.handed
        for i in range(order - 1, len(padded)):
            for n in range(order, 0, -1):
                gram = padded[i - n + 1 : i + 1]
                p = seen.get(gram)
                if p is not None:
                    total += p
                    break
                total += handed.get(gram[:-1], 0.0)
            else:
                total -= math.log(ALPHABET)
        return total


def labelled_urls(ruled: DataFrame, markers: list[str], url: str) -> DataFrame:
    """(text, rejected, held): urls that are accepted or rejected, once each."""
    marked = F.col("host").rlike("(?:^|[.-])(?:" + "|".join(markers) + ")(?:[.-]|$)") if markers else F.lit(False)
    rejected = F.when(F.col("ruled") == "block", F.lit(True)).when(~marked, F.lit(False)).when(F.col("ruled").isNull(), F.lit(True))
    rows = ruled.select(model_text(F.col(url).cast("string")).alias("text"), rejected.alias("rejected"))
    rows = rows.where(F.col("rejected").isNotNull() & (F.col("text") != "")).distinct()
    return rows.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0)


def known_grams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``count_grams`` of what the models learn from; a count of 0 is an n-gram that a model does not know."""
    counts = count_grams(labelled.where(~F.col("held")), order)
    kept = [F.when(F.col(c) > (F.char_length("gram") > 1).cast("int"), F.col(c)).otherwise(0).alias(c) for c in CLASSES]
    return counts.select("gram", *kept).where(" or ".join(f"{c} > 0" for c in CLASSES))


def contexts(grams: DataFrame) -> DataFrame:
    """(context, accepted_total, accepted_next, rejected_total, rejected_next): occurrences and distinct followers."""
    context = F.expr("left(gram, char_length(gram) - 1)").alias("context")
    sums = [x for c in CLASSES for x in (F.sum(c).alias(f"{c}_total"), F.count_if(F.col(c) > 0).alias(f"{c}_next"))]
    return grams.groupBy(context).agg(*sums)


def windows(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, window, n): the characters of each text (id, text) with their longest contexts, counted."""

    def run(batches):
        for batch in batches:
            ids, found, counts = [], [], []
            for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                padded = START * (order - 1) + text + START
                own = Counter(padded[k : k + order] for k in range(len(text) + 1))
                ids += [i] * len(own)
                found += own.keys()
                counts += own.values()
                if len(ids) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["id", "window", "n"])
                    ids, found, counts = [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["id", "window", "n"])

    return texts.select("id", "text").mapInArrow(run, "id long, window string, n long")


def window_scores(occurring: DataFrame, grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(window, score) of distinct windows: the log-probability of the last character under the accepted model, less
    that under the rejected one."""
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(order)), lambda n: F.right("window", n))
    needed = occurring.select(F.explode(suffixes).alias("gram")).distinct()
    context = F.expr("left(gram, char_length(gram) - 1)")
    stats = materialise(
        needed.join(grams, "gram", "left").withColumn("context", context).join(contexts(grams), "context", "left").drop("context")
    )
    level = None
    for n in range(1, order + 1):
        own = stats.where(F.char_length("gram") == n)
        if level is None:
            own = own.select("*", *[F.lit(1 / ALPHABET).alias(f"{c}_shorter") for c in CLASSES])
        else:  # a suffix has few n-grams that are a character longer, so no key is hot
            shorter = level.select(F.col("gram").alias("suffix"), *[F.col(f"{c}_p").alias(f"{c}_shorter") for c in CLASSES])
            own = own.withColumn("suffix", F.expr("right(gram, char_length(gram) - 1)")).join(shorter, "suffix")
        level = own.select("gram", *[_smoothed(c).alias(f"{c}_p") for c in CLASSES])
    return level.select(F.col("gram").alias("window"), (F.ln("accepted_p") - F.ln("rejected_p")).alias("score"))


def _smoothed(c: str) -> Column:
    """Witten-Bell: the shorter n-gram's probability has the weight of the context's distinct followers; an unknown
    context hands on all of it."""
    total, following, shorter = F.col(f"{c}_total"), F.col(f"{c}_next"), F.col(f"{c}_shorter")
    return F.when(total > 0, (F.coalesce(c, F.lit(0)) + following * shorter) / (total + following)).otherwise(shorter)


def scores(texts: DataFrame, grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, score) of ``texts`` (id, text), not empty: the ratio per character."""
    found = materialise(windows(texts, order))
    known = materialise(window_scores(found.select("window").distinct(), grams, order))
    return found.join(known, "window").groupBy("id").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("score"))


def threshold(held: DataFrame) -> float:
    """Below it lie FALSE_BLOCKS of the accepted urls of the calibration share (score)."""
    low = held.agg(F.percentile_approx("score", FALSE_BLOCKS, 10_000)).first()[0]
    return min(0.0, low) if low is not None and np.isfinite(low) else 0.0


def judge(pages: DataFrame, rules: dict[str, str] = RULES, markers: list[str] = MARKERS, url: str = "url", order: int = ORDER) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict: the rule's, else block below the threshold."""
    names = [c for c in pages.columns if c not in RESULTS]
    own = [c if c == url else f"c{i}" for i, c in enumerate(names)]  # so that no name clashes with one made here
    ruled = with_rules(pages.select(*names).toDF(*own), rules, url)
    labelled = materialise(labelled_urls(ruled, markers, url))
    grams = materialise(known_grams(labelled, order))
    met = grams.agg(*[F.max(F.col(c)).alias(c) for c in CLASSES]).first()
    if not all(met):
        scored, low = ruled.withColumn("score", F.lit(0.0)), 0.0
    else:
        read = model_text(F.col(url).cast("string"))
        texts = materialise(ruled.select(read.alias("text")).where(read != "").distinct().withColumn("id", F.monotonically_increasing_id()))
        judged = materialise(texts.join(scores(texts, grams, order), "id").select("text", "score"))
        low = threshold(judged.join(labelled.where("held and not rejected").select("text"), "text"))
        to_text = judged.select(F.col("text").alias("_read"), F.col("score").alias("_score"))
        scored = (
            ruled.withColumn("_read", read).join(to_text, "_read", "left")
            .select(*ruled.columns, F.coalesce("_score", F.lit(0.0)).alias("score"))
        )
    by_score = F.when(F.col("score") < low, "block").otherwise("allow")
    judged = scored.withColumn("verdict", F.coalesce("ruled", by_score))
    return judged.select(*own, *RESULTS).toDF(*names, *RESULTS)
