"""What the driver holds to learn languages."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from tallyspark.llm import langid


def test_learning_holds_no_table_of_rows_by_places(spark):
    rng = random.Random(5)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(400)] for lang, letters in zip("abcd", ("abcdefghij", "fghijklmno", "klmnopqrst", "pqrstuvwxy"))}
    rows = [(i, " ".join(rng.choices(words["abcd"[i % 4]], k=60)), "abcd"[i % 4]) for i in range(langid.SAMPLE_ROWS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = langid.train(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.langs == list("abcd")
    # two square tables of the sample's rows for the equations, and the features that are not zero
    assert peak < 100e6


def test_parts_of_rows_are_those_of_the_scaled_counts():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.05, (9, langid.DIMS))
    counts[4] = 0
    made = langid.gathered([(np.flatnonzero(c), c[np.flatnonzero(c)]) for c in counts])
    want = np.stack([langid.scaled(c.astype(np.float32)) for c in counts])
    rows = np.array([8, 0, 4, 3])
    assert (made.dense(rows) == want[rows]).all()
    assert (made.dense(rows, 1024, 2048) == want[rows, 1024:2048]).all()
    assert langid.gathered([]).dense(np.zeros(0, int)).shape == (0, langid.DIMS)
