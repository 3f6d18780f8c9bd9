"""The audit of source divergence against a plain version; DuckDB's answer is compared with the other queries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyspark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_docs=10, top=10):
    docs = [tuple(x or "" for x in d) for d in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        counts, in_docs = defaultdict(Counter), Counter()
        for _, source, text in (d for d in docs if d[0] == lang):
            found = [t.translate(LOWER) for t in TERM.findall(text)]
            counts[source].update(found)
            in_docs.update(set(found))
        kept = sorted(t for t, n in in_docs.items() if n >= min_docs)
        v, size = len(kept), {s: sum(c[t] for t in kept) for s, c in counts.items()}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        p = lambda n, total: 1 + 10**9 * (n + 2) // (total + 2 * v)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for source, own in counts.items():
            pairs = [(-sum(f(p(own[t], size[source]), p(c[t], size[o])) for t in kept), o) for o, c in counts.items() if o != source]
            terms = [(-f(p(own[t], size[source]), p(whole[t], sum(whole.values()))), t) for t in kept
                     if own[t] and p(own[t], size[source]) > p(whole[t], sum(whole.values()))]
            for part, rows in (("pair", pairs), ("term", terms)):
                ranked = sorted(rows, key=lambda r: (r[0], r[1].encode()))
                out |= {(lang, source, part, item, -value, k + 1) for k, (value, item) in enumerate(ranked) if part == "pair" or k < top}
    return out


def documents(rng, n):
    words = ["the", "The", "Straße", "naïve", "日本", "x1y", "a_b", *(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60))]
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["hot", "hot", "hot", "s1", "s2", None])
        yield lang, source, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_audit_is_that_of_a_plain_version(spark, block):
    rng = random.Random(block)
    rows = [*documents(rng, 300), ("fr", "alone", "un deux"), ("it", "a", None), ("it", "b", "!!"), ("en", "silent", ""), ("en", "s1", "the " * 5000)]
    rows += rows[:20]  # repeated rows are documents of their own
    frame = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    extra = frame.selectExpr("*", "1 AS n", "2 AS size", "3 AS item")
    got = {tuple(r) for r in divergence.audit(extra, block=block).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == plain(rows)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_runs_are_sorted_and_merge_to_the_same_index(spark):
    rng = random.Random(2)
    frame = spark.createDataFrame([(a or "", b or "", t) for a, b, t in documents(rng, 200)], "lang string, source string, text string").repartition(4)
    spilled = divergence.runs(frame, 8, block=100, chunk=3).collect()
    assert len({r.shard for r in spilled}) > 1 and max(len(r["keys"]) for r in spilled) <= 3
    assert all(r["keys"] == sorted(r["keys"]) and bytes(r["head"]) == bytes(r["keys"][0]) for r in spilled)
    one = {(r.lang, r.term, r.docs, r.total, tuple(zip(r.sources, r.counts))) for r in divergence.frequencies(frame, 2, block=100, chunk=3).collect()}
    other = {(r.lang, r.term, r.docs, r.total, tuple(zip(r.sources, r.counts))) for r in divergence.frequencies(frame, 2).collect()}
    assert one == other and one


def test_probabilities_are_exact_for_large_counts(spark):
    rows = [(0, 0, 1), (5, 9, 3), (10**12, 3 * 10**13, 10**9), (7 * 10**13, 8 * 10**13, 12345)]
    got = spark.createDataFrame(rows, "n long, size long, kept long").select("n", "size", "kept", divergence.probability("n", "size", "kept").alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (n + 2) // (size + 2 * kept) for n, size, kept in rows]


def test_terms_of_very_many_sources(spark):
    """Terms with more sources than a matrix holds are corrected in pairs of slices."""
    rows = [("en", f"s{i}", f"t{'abc'[j]}", 100 + 7 * i + j, 50 + i) for i in range(9) for j in range(3)]
    frame = spark.createDataFrame(rows, "lang string, source string, term string, p long, low long")
    wide = {tuple(r) for r in divergence.corrections(frame, cells=16).collect()}
    assert wide == {tuple(r) for r in divergence.corrections(frame).collect()} and len(wide) == 72
    assert divergence._f(np.array([5]), np.array([9]))[0] == 16 // 14
