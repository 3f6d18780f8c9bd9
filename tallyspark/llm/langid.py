"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier per bit, on hashed counts of character 1- to
3-grams, predicts that bit. Decoding sums, over the bits, the exponential loss of the margin against
the codeword's bit, weighted by how well that bit's classifier did on held-back rows of the language;
the language with the least loss is chosen. If the second is nearly as near, the row is ambiguous.

Learning uses a bounded sample per language: an even share of ``sample_rows`` rows, but ``LEAST_ROWS`` where
there are many languages, those with the smallest hash of doc_id. Every language of the learning rows has a
codeword. Prediction reads whole texts and nothing else.

Defined results: a null text or one without a letter is ``und`` with score 0, as is every text if
nothing was learned; languages tied in loss go to the alphabetically first; repeated rows are
predicted each; null languages are not learned from; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UNKNOWN = "und"
DIMS = 1 << 13
SAMPLE_ROWS = 2000
LEAST_ROWS = 6  # of a language, so that rows are left to measure its classifiers
RIDGE = 0.05
CLEAR_GAP = 0.02


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """Counts of hashed letter 1- to 3-grams; runs of other characters are one word border.
    None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 0)
    codes = codes[letter | np.r_[True, letter[:-1]]].astype(np.uint64)  # one border per run
    codes = np.r_[np.zeros(1, np.uint64), codes, np.zeros(1, np.uint64)]
    mixed = [codes[codes > 0]]
    mixed.append(codes[:-1] * np.uint64(0x1F0A3) + codes[1:] + np.uint64(1 << 40))
    mixed.append((codes[:-2] * np.uint64(0x1F0A3) + codes[1:-1]) * np.uint64(0x1F0A3) + codes[2:] + np.uint64(2 << 40))
    hashed = (np.concatenate(mixed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(dims).bit_length() + 1)
    return np.bincount(hashed.astype(np.int64), minlength=dims)


def scaled(counts: np.ndarray) -> np.ndarray:
    roots = np.sqrt(counts, dtype=np.float32)
    return roots / max(float(np.linalg.norm(roots)), 1e-9)


def codewords(n: int) -> np.ndarray:
    """Codewords of -1 and 1, one row per language: every split of up to six languages, else the
    best separated of several random codes. No bit is constant."""
    if n <= 6:
        splits = range(1, max(2, 1 << (n - 1)))
        return np.array([[1 if i and (s >> (i - 1)) & 1 else -1 for s in splits] for i in range(n)], np.float32)
    bits, best, width = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits)).astype(np.float32)
        if (np.abs(code.sum(0)) == n).any():
            continue
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if apart > width:
            best, width = code, apart
    return best


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # dimension x bit
    bias: np.ndarray
    trust: np.ndarray  # language x bit, each row sums to 1

    def losses(self, x: np.ndarray) -> np.ndarray:
        margins = np.clip(x @ self.weights + self.bias, -2, 2)
        return (self.trust[None] * np.exp(-2 * margins[:, None, :] * self.code[None])).sum(2)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, score between 0 and 1, and whether another is as near."""
        loss = self.losses(x)
        best = loss.argmin(1)
        share = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        score = 1 / share.sum(1)
        if loss.shape[1] < 2:
            return best, score, np.zeros(len(x), bool)
        two = np.partition(loss, 1, axis=1)
        return best, score, two[:, 1] - two[:, 0] < CLEAR_GAP


@dataclass(frozen=True)
class Rows:
    """Scaled features of rows: of each, the places that are not zero, ascending, and their values. A table of all
    places would be most of what the driver holds."""

    ends: np.ndarray  # where each row begins, and the last ends
    places: np.ndarray
    values: np.ndarray

    def dense(self, rows: np.ndarray, low: int = 0, high: int = DIMS) -> np.ndarray:
        """The places from ``low`` to ``high`` of some rows."""
        out = np.zeros((len(rows), high - low), np.float32)
        for row, a, b in zip(out, self.ends[rows], self.ends[rows + 1]):
            first, last = a + np.searchsorted(self.places[a:b], (low, high))
            row[self.places[first:last] - low] = self.values[first:last]
        return out


def gathered(counts: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
    """Rows of (places, counts at them)."""
    ends = np.cumsum([0, *(len(own) for own, _ in counts)])
    places, values = np.zeros(ends[-1], np.int32), np.zeros(ends[-1], np.float32)
    row = np.zeros(DIMS, np.float32)
    for (own, found), a, b in zip(counts, ends[:-1], ends[1:]):
        row[:] = 0
        row[own] = found
        places[a:b], values[a:b] = own, scaled(row)[own]
    return Rows(ends, places, values)


def fit(features: Rows, labels: list[str], ridge: float = RIDGE) -> Model | None:
    """Least-squares classifiers per bit; every third row measures how far each bit is trusted."""
    langs = sorted(set(labels))
    if not langs:
        return None
    y = np.array([langs.index(x) for x in labels])
    code = codewords(len(langs))
    order = np.argsort(y, kind="stable")  # every third row of each language
    held = np.zeros(len(y), bool)
    held[order[2::3]] = True

    def solve(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = code[y[rows]].astype(np.float64)
        bias = t.mean(0)
        # a part of the features, and of their products, at a time
        parts = [(at, at + 1024) for at in range(0, DIMS, 1024)]
        inner = ridge * np.eye(len(rows))
        for part in parts:
            x = features.dense(rows, *part).astype(np.float64)
            for at in range(0, len(rows), 256):
                inner[at : at + 256] += x[at : at + 256] @ x.T
            del x
        dual = np.linalg.solve(inner, t - bias)
        del inner
        weights = np.concatenate([features.dense(rows, *part).astype(np.float64).T @ dual for part in parts])
        return weights.astype(np.float32), bias.astype(np.float32)

    weights, bias = solve(np.flatnonzero(~held))
    right = np.zeros((len(y), code.shape[1]), bool)
    for at in range(0, len(y), 256):
        rows = np.flatnonzero(held[at : at + 256]) + at
        right[rows] = (features.dense(rows) @ weights + bias) * code[y[rows]] > 0
    trust = np.array([(right[y == i].sum(0) + 1) / ((held & (y == i)).sum() + 2) for i in range(len(langs))])
    trust = (trust / trust.sum(1, keepdims=True)).astype(np.float32)
    weights, bias = solve(np.arange(len(y)))
    return Model(langs, code, weights, bias, trust)


def training_rows(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Rows, list[str]]:
    """Scaled features and languages of the bounded sample of ``docs`` (doc_id, text, lang)."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").count()
    share = max(LEAST_ROWS, sample_rows // max(1, sizes.count()))
    # about three times the share of a language by hash, but no fewer than 16 hashes' worth, then exactly the share
    chance = sizes.select("lang", F.least(F.lit(1.0), 3 * F.lit(max(share, 16)) / F.col("count")).alias("chance"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        rows.select("doc_id", "lang").join(F.broadcast(chance), "lang")
        .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("chance") * (1 << 20)).select("doc_id", "lang")
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= share).select("doc_id", "lang").distinct()
    )  # at most share rows a language

    def run(batches):
        for batch in batches:
            found = [(lang, g) for lang, g in zip(batch["lang"].to_pylist(), map(grams, batch["text"].to_pylist())) if g is not None]
            at = [np.flatnonzero(g) for _, g in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([i.tolist() for i in at], pa.list_(pa.int32())),
                    pa.array([g[i].tolist() for i, (_, g) in zip(at, found)], pa.list_(pa.int32())),
                ],
                ["lang", "at", "n"],
            )

    sampled = rows.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").select("lang", "text")
    table = sampled.mapInArrow(run, "lang string, at array<int>, n array<int>").toArrow()
    at, n = (table[c].combine_chunks() for c in ("at", "n"))
    ends, places, counts = at.offsets.to_numpy(), at.values.to_numpy(), n.values.to_numpy()
    rows = [(lang, places[a:b], counts[a:b]) for lang, a, b in zip(table["lang"].to_pylist(), ends[:-1], ends[1:])]
    rows.sort(key=lambda r: (r[0], r[1].astype(">i4").tobytes(), r[2].astype(">i4").tobytes()))
    return gathered([r[1:] for r in rows]), [r[0] for r in rows]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    return fit(*training_rows(docs, sample_rows))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous, from the column text alone."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    source = docs.select(*names)
    schema = StructType(source.schema.fields[:]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = source.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        learned = shared.value
        for batch in batches:
            texts = batch["text"].to_pylist()
            lang, score, unclear = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            for at in range(0, len(texts) if learned else 0, 256):
                found = [(i, g) for i, g in ((i, grams(texts[i])) for i in range(at, min(at + 256, len(texts)))) if g is not None]
                if found:
                    best, sure, near = learned.decode(np.stack([scaled(g) for _, g in found]))
                    for (i, _), b, s, a in zip(found, best, sure, near):
                        lang[i], score[i], unclear[i] = learned.langs[b], float(s), bool(a)
            more = [pa.array(lang), pa.array(score), pa.array(unclear)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with held_out, lang_pred, score and ambiguous; learns from the rows not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), sample_rows)
    return predict(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
