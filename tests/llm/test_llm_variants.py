"""Spelling variants against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyspark.llm import queries, variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, min_length=7, min_count=2, dominance=10, damage=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    close = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= dominance * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(close[w]), n.get(form[w])) for w in n}


def rows_of(frame):
    return {tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_query_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(queries.QUERIES["op13_spelling_variants"](spark, SMALL))
    assert got == plain(docs) and len(got) > 1000


def mutated(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abcéÀ")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


@pytest.mark.parametrize("tile", [2048, 8])
def test_groups_of_mutated_words(spark, tile):
    rng = random.Random(tile)
    words = ["samestart" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(40)] + ["".join(rng.choice("abcdéÿ") for _ in range(rng.randrange(6, 14))) for _ in range(30)]
    words += [mutated(rng, w) for w in words for _ in range(3)]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "", ",", "×", "œ", "9"]) for _ in range(60))) for i in range(120)]
    frequent = words[0]
    rows += [(200 + i, (frequent + " ") * 50) for i in range(4)] + [(300, (mutated(rng, frequent).upper() + ".") * 3), (None, "withoutid withoutid withoutix"), (301, None), (302, "")]
    rows += rows[:5] + [(400, "a" * 300 + " " + "a" * 299 + "b " + "a" * 300 + " " + "a" * 299 + "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).repartition(3)
    assert rows_of(variants.group_variants(frame, tile=tile)) == plain(rows)


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 30, "aaaaaabb": 400, "zzzzzzz": 3}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    got = {r[0]: r for r in rows_of(variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), damage=1 << 40))}
    assert got["aaaaaaaa"] == ("aaaaaaaa", "aaaaaaab", "aaaaaabb", 2, 1, 30)
    assert got["aaaaaabb"][1:3] == (None, "aaaaaabb") and got["zzzzzzz"] == ("zzzzzzz", None, "zzzzzzz", 3, 0, None)


def test_empty_table(spark):
    assert variants.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
