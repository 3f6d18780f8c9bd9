"""A table of more than 64 languages."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyspark.llm import langid


def test_every_language_has_a_codeword(spark):
    rng = random.Random(1)
    rows = []
    for i in range(70):
        words = ["".join(chr(0x4E00 + 40 * i + rng.randrange(40)) for _ in range(4)) for _ in range(30)]
        rows += [(100 * i + k, " ".join(rng.choices(words, k=60)), f"l{i:02d}") for k in range(12 if i < 64 else 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.langs) == 70
    got = langid.predict(docs, model)
    assert got.where(F.col("lang") == F.col("lang_pred")).count() > 0.95 * len(rows)
    assert got.where("lang >= 'l64' and lang = lang_pred").count() > 45
