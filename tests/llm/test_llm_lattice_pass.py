"""Texts are encoded in one pass, with the words' lattices in arrays."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from conftest import SMALL

from tallyspark.llm import lattice, queries


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces.load()


@pytest.fixture(scope="module")
def model():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def some_texts():
    rng = random.Random(11)
    mixed = ["".join(rng.choice("entionhas éü漢😀\n-") for _ in range(rng.randrange(80))) for _ in range(300)]
    unbroken = ["".join(rng.choice("entionhas") for _ in range(n)) for n in (510, 511, 512, 513, 1500)]
    return [None, "", " ", "a", "  x ", "é 漢字かな 😀👍🏽", "in" * 20_000, "zzzz" * 400, *mixed, *unbroken]


def test_no_row_is_shuffled_or_stored(spark):
    query = queries.QUERIES["op8_document_lattice"](spark, SMALL)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1 and "documents.parquet" in plan


@pytest.mark.parametrize("most", [0, 40, lattice.KNOWN])
def test_ids_do_not_depend_on_the_words_kept(pieces, model, most):
    encoder, texts = lattice.TextEncoder(pieces, lattice.Lattice(pieces), most), some_texts()
    for i in range(0, len(texts), 23):
        ids, ends = encoder.texts(texts[i : i + 23])
        begin = 0
        for text, end in zip(texts[i : i + 23], ends.tolist()):
            assert ids[begin:end].tolist() == model.encode(text or "")
            begin = end
        assert begin == len(ids)


def test_arrays_and_rows_agree(spark, pieces):
    texts = spark.createDataFrame(list(enumerate(t for t in some_texts()[:60] if len(t or "") < 100)), "i int, text string").repartition(3)
    got = {r.i: r.ids for r in lattice.encode(texts, pieces).collect()}
    assert got == {r.i: r.ids for r in lattice.encode_rows(texts, pieces).collect()}
    assert None in got.values() and [] in got.values()


def test_equal_scores_go_to_the_leftmost_edge():
    table = [("a", 0, 0.0), ("b", 1, 0.0), ("ab", 2, -1.0), ("ba", 3, -1.0), ("aba", 4, -2.0)]
    own = lattice.Lattice(lattice.Pieces(table, [100 + i for i in range(256)], [p for p, _, _ in table], 3))
    ids, starts, counts = own.words(["bab", "abab", "aba", "cé", "a"])
    assert [ids[s : s + n].tolist() for s, n in zip(starts, counts)] == [[3, 1], [2, 2], [4], [100 + b for b in "cé".encode()], [0]]


def test_slices_hold_every_row():
    texts = ["a" * n for n in (3, 9, 1, 1, 30, 0)] + [None, "a"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = [part.column(0).to_pylist() for part in lattice.slices(batch, "text", 10)]
    assert parts == [texts[:1], texts[1:3], texts[3:4], texts[4:5], texts[5:]]
