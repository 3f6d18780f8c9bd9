"""Short secrets after a name, and secrets that look like addresses."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import secrets


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_words_after_a_secrets_name_are_found(spark):
    shorts = {"password = Secret12": "Secret12", "pwd: hunter2": "hunter2", "secret: correcthorsebatterystaple": "correcthorsebatterystaple", "the password is Tr0ub4dor": "Tr0ub4dor"}
    texts = [f"some words {t} and a rest" for t in shorts]
    texts += [f"mail user.{i}@mail8.example.com or 4668656817{i:06d} at http://a.org/x/{i}/page" for i in range(40)]
    docs = documents(spark, texts)
    trees = secrets.train(docs)
    assert trees
    got = {r.doc_id: r.text for r in secrets.redact(docs, trees).collect()}
    assert [got[i] for i in range(4)] == [t.replace(v, secrets.MASK) for t, v in zip(texts, shorts.values())]
    assert [got[i] for i in range(4, 44)] == texts[4:]


def test_ordinary_words_stay_where_no_name_is_before(spark):
    docs = documents(spark, ["pwd: cat and concatenate the cat", "secret garden"])
    got = [r.text for r in secrets.redact(docs, []).orderBy("doc_id").collect()]
    assert got == [f"pwd: {secrets.MASK} and concatenate the cat", "secret garden"]


def test_secrets_with_slashes_and_at_signs_are_labelled_so(spark):
    words = ["aws_secret_access_key=ab/Cd3/efGh1/jKl", "postgres://user:pass@host", "key http://example.org/a/12345/page", "user.83@mail8.example.com"]
    found = secrets.scanned(documents(spark, words)).select("doc_id", F.explode("_found").alias("c"))
    got = {r.doc_id: (r.value, r.label) for r in found.select("doc_id", "c.value", secrets.certain_label(F.col("c")).alias("label")).collect()}
    assert got[0] == ("ab/Cd3/efGh1/jKl", 1) and got[1] == ("pass", 1)
    assert [got[i][1] for i in (2, 3)] == [0, 0]
    assert secrets.redact(documents(spark, words[1:2]), []).first().text == f"postgres://user:{secrets.MASK}@host"


def test_form_alone_tells_planted_findings(spark):
    """Labels come from names and formats; with those hidden, held-out findings are still told apart by their form."""
    rng = random.Random(8)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = []
    for i in range(120):
        secret = draw(hexes, 40) if i % 2 else draw(mixed, 36)
        plain = rng.choice([f"/usr/share/garden/page{i}/index", f"mail{i}@museum.example.org", f"2021-03-{i % 28 + 1:02d}/10:15:{i % 60:02d}", f"https://library.org/book/{i}"])
        texts += [f"here token = {secret} is used", f"see {plain} for more"]
    x, y = secrets.labelled_rows(documents(spark, texts))
    assert len(y) >= 200 and 0.3 < y.mean() < 0.7
    precision, recall = secrets.agreement(x, y)
    assert precision >= 0.95 and recall >= 0.95
    hidden = secrets.without_evidence(x)
    names = [secrets.FEATURES.index(n) for n in secrets.EVIDENCE]
    assert (hidden[:, names] == 0).all() and (np.delete(hidden, names, 1) == np.delete(x, names, 1)).all()


def plain_features(value):
    """Features of a value alone."""
    n = max(1, len(value))
    kinds = re.sub("[a-z]+", "7", re.sub("[A-Z]+", "8", re.sub("[0-9]+", "9", value)))
    return {
        "n_chars": len(value), "digit_share": sum(c in "0123456789" for c in value) / n, "upper_share": sum("A" <= c <= "Z" for c in value) / n,
        "lower_share": sum("a" <= c <= "z" for c in value) / n, "transitions": len(kinds) / n, "distinct": len(set(value)) / n,
        "longest_word": max(map(len, re.split("[^a-z]+", value))), "hex_only": float(bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", value))),
        "covered": sum(len(m) for m in re.findall(secrets.COMMON_PARTS, value.lower())) / n,
    }


def test_features_and_masks_are_those_of_a_plain_version(spark):
    rng = random.Random(9)
    letters = "abcXYZ019-_the.ing"
    values = ["".join(rng.choice(letters) for _ in range(rng.randrange(15, 40))) + "7" for _ in range(60)]
    texts = [f"word {v} and {v} again\n" for v in values]
    docs = documents(spark, texts).withColumn("_words", F.lit("own")).withColumn("_found", F.lit(1)).withColumn("findings", F.lit(2))
    found = secrets.scanned(docs.select("doc_id", "text")).select("doc_id", F.explode("_found").alias("c")).select("doc_id", "c.*").collect()
    assert len(found) == 120
    for r in found:
        for name, want in plain_features(r.value).items():
            assert abs(r[name] - want) < 1e-9, (name, r.value)
    trees = secrets.forest(np.array([[float(i)] * len(secrets.FEATURES) for i in range(40)]), np.array([float(i >= 20) for i in range(40)]))
    said = {(r.doc_id, r.value) for r in secrets.findings(docs, trees).collect() if r.is_secret}
    masked = secrets.redact(docs, trees)
    assert masked.columns == [*docs.columns, "n_secrets"] and masked.where("_words = 'own' AND _found = 1 AND findings = 2").count() == len(texts)
    for r in masked.collect():
        text = texts[r.doc_id]
        for _, value in sorted((p for p in said if p[0] == r.doc_id), key=lambda p: -len(p[1])):
            text = text.replace(value, secrets.MASK)
        assert r.text == text and r.n_secrets == len({p for p in said if p[0] == r.doc_id})
