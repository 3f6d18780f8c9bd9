"""Every document is encoded and decoded."""

from __future__ import annotations

import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyspark.llm import lattice, queries


def test_every_document_has_the_librarys_ids(spark):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op8_document_lattice"](spark, SMALL).collect()
    assert {r.doc_id: r.ids for r in got} == {i: model.encode(t) for i, t in texts.items()}
    assert len(got) == len(texts) and all(r.round_trip for r in got)


def test_a_text_sends_each_word_once(spark):
    texts = spark.createDataFrame([(1, ["a", "b", "a"]), (2, [])], "_row long, words array<string>")
    assert sorted(map(tuple, lattice.placed_words(texts).collect())) == [(1, "a", [0, 2]), (1, "b", [1])]


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces.load()


def cut(texts, pattern):
    return texts.select(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("words"))


def test_words_are_cut_where_no_longer_piece_crosses(spark, pieces):
    joined = {c for piece, _, _ in pieces.rows if len(piece) > 1 for c in piece} - {lattice.SPACE}
    rng = random.Random(5)
    some = [lattice.SPACE, *rng.sample(sorted(joined), 60), *"ÿĀğ中文😀\u0300 \n\t07-]^&[\\"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(200)] + ["жdж" * 20_000]

    def plain(text):
        words = []
        for c in text:
            last = words[-1][-1] if words else ""
            grows = last and (c == lattice.SPACE == last or c in joined and (last in joined or last == lattice.SPACE))
            words[-1:] = [words[-1] + c] if grows else words[-1:] + [c]
        return words

    got = cut(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), pieces.word_pattern()).collect()
    assert [r.words for r in got] == [plain(t) for t in texts]


def test_latin_runs_are_cut_by_a_class_of_their_own(pieces):
    runs = pieces.word_pattern().split("]++")[0]  # Java tests a class of characters below U+0100 by one look into a table
    assert runs.startswith(f"{lattice.SPACE}++(?:[") and max(runs[len(lattice.SPACE) :]) < "\u0100"
