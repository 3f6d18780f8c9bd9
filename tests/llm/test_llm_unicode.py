"""Token ids and counts equal the library's over all of Unicode, also where its tables differ from Python's."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing, tokencount


def texts(seed, n):
    rng = random.Random(seed)

    def one():
        kind = rng.random()
        if kind < 0.3:
            return chr(rng.randrange(32, 127))
        if kind < 0.5:
            return chr(rng.randrange(0x80, 0x3000))
        if kind < 0.9:
            c = rng.randrange(0x110000)
            return "x" if 0xD800 <= c < 0xE000 else chr(c)
        return rng.choice([" ", "\n", "é", "Σ", "İ", "ǅ", "ﬁ", "'s", "ཱ࣍"])

    made = ["".join(one() for _ in range(rng.randrange(1, 25))) for _ in range(n)]
    return [*made, *(f"{chr(c)}a{chr(c)}1{chr(c)}" for c in packing.unassigned()[seed % 7 :: 7])]


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_are_the_librarys(seed):
    path, rows = public_tokenizers.path("word_bpe_49k.json"), texts(seed, 3000)
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(rows, add_special_tokens=False)]
    got = [g.tolist() for g in packing.WordEncoder(path).encode(rows)]
    assert [g[: len(w)] for g, w in zip(got, want)] == want and {len(g) - len(w) for g, w in zip(got, want)} <= {0, 1}


@pytest.mark.parametrize("seed", [3, 4])
def test_counts_are_the_librarys(seed):
    path, rows = public_tokenizers.path("byte_bpe_50k.json"), texts(seed, 3000)
    want = [len(x.ids) for x in Tokenizer.from_file(path).encode_batch(rows, add_special_tokens=False)]
    assert tokencount.transducer("byte_bpe_50k.json").counts(rows).tolist() == want
