"""The pipeline's near_dedup stage against brute-force Jaccard similarity."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyspark.llm import jaccard

MIDDLE = SMALL.replace("0.001", "0.01")


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_of_groups(texts):
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        x, y = sets[i], sets[j]
        if x == y or min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) / len(x | y) >= 0.8:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return {root(i) for i in sets}


def stage():
    return dict(pytest.importorskip("corpus_pipeline").STAGES)["near_dedup"]


def test_near_dedup_of_the_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = stage()(spark, docs, MIDDLE)
    assert got.columns == docs.columns
    ids = {r.doc_id for r in got.select("doc_id").collect()}
    assert ids == smallest_of_groups({r.doc_id: r.text for r in docs.collect()})
    assert not {56, 914} <= ids  # similarity 0.967, five bits apart


def test_near_dedup_follows_chains_and_keeps_the_rest(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(8):  # each a little further from the first
            texts.append(" ".join(words))
            for i in rng.sample(range(200), rng.randrange(1, 7)):
                words[i] = f"v{rng.randrange(5000)}"
    texts += ["same start of a license " * 3 + f"x{i} y{i} z{i}" for i in range(20)] + ["a b", "A  b", "a c", "", None]
    rng.shuffle(texts)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = stage()(spark, docs, MIDDLE)
    assert {r.doc_id for r in got.collect()} == smallest_of_groups(dict(enumerate(texts)))
    assert stage()(spark, docs.where(F.lit(False)), MIDDLE).count() == 0


def put_out(spark, monkeypatch, n):
    """Rows that leave the groups of ``n`` texts with a common passage, some of them copies."""
    rng = random.Random(n)
    passage = " ".join(f"p{i}" for i in range(90))
    texts = [passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(n)]
    texts += [t + " one" for t in texts[: n // 10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_row", F.lit(5)).withColumn("_set", F.lit(6))
    seen, plain_links = [], jaccard.open_links

    def counted(*args, **kwargs):
        found = plain_links(*args, **kwargs)
        seen.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "open_links", counted)
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns and kept.where("_row = 5 AND _set = 6").count() == len(smallest_of_groups(dict(enumerate(texts))))
    monkeypatch.undo()
    return seen[0]


def test_rows_grow_with_the_members(spark, monkeypatch):
    few, more, many = (put_out(spark, monkeypatch, n) for n in (60, 120, 240))
    assert few <= 66 and more <= 132 and many <= 264


def test_tiles_find_what_one_group_finds():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: 60 - k], rng.integers(0, 1 << 63, k, dtype=np.uint64)])) for k in (0, 3, 6, 9, 30, 60)]
    sets.append(sets[4])
    fps = np.array([jaccard.set_fingerprint(s) for s in sets], np.uint64)
    table = np.zeros((7, 2), np.int8)
    signed = [s.view(np.int64) for s in sets]
    whole = {tuple(sorted(p)) for p in jaccard.group_links(fps, table, signed, np.arange(7), 7, 0.8, 64)}
    assert {frozenset(x for p in whole for x in p if (x in (4, 6)) == side) for side in (False, True)} == {frozenset({0, 1, 2}), frozenset({4, 6})}
    assert jaccard.group_links(fps, table, signed, np.arange(7), 1, 0.8, 64) == [(0, k) for k in (1, 2)]


def test_distance_tables_propose_close_copies_by_themselves(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(15):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        for k in (0, 1, 1, 2):
            own = list(words)
            for i in rng.sample(range(400), k):
                own[i] = f"v{rng.randrange(5000)}"
            texts.append(" ".join(own))
    texts += ["", "one", "two words", None]
    made = jaccard.with_bands(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = {r._set: r for r in made.collect()}
    nodes = made.select(F.col("_set").alias("node"), F.col("_fp").alias("fp"), F.array().cast("array<long>").alias("bands")).distinct()
    found = jaccard.links(nodes, made.select(F.col("_set").alias("node"), "text").dropDuplicates(["node"])).collect()

    def alike(a, b):
        x, y = plain_shingles(rows[a].text), plain_shingles(rows[b].text)
        return len(x & y) / len(x | y) >= 0.8

    def bits(a, b):
        return ((rows[a]._fp ^ rows[b]._fp) & (1 << 64) - 1).bit_count()

    assert all(alike(r.a, r.b) for r in found)
    near = [(a, b) for a, b in combinations(sorted(rows), 2) if rows[a].text and bits(a, b) <= 3 and alike(a, b)]
    linked = {x for r in found for x in r}
    assert len(near) >= 10 and all(a in linked and b in linked for a, b in near)
