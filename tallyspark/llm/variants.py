"""Groups of spelling variants by blocked Gram matrices of letter counts.

Words are counted over all texts. Two words that differ by one inserted, deleted or replaced letter have letter
counts at a squared distance of two at most, and lengths that are equal or adjacent. A block of words is a
matrix of letter counts; one NumPy product of two blocks, extended by two columns for the squared norms, gives
all squared distances between them. Pairs at most two apart are verified by their letters.

Blocks hold words of a length and of the next one that share their first or their last half: one edit leaves one
of the halves as it is, so no pair is lost, and a pair with an equal first half is left out of the blocks of
last halves, so each is met once. A block above ``TILE`` words is cut into tiles, and every two tiles are a
group of their own, which bounds memory and spreads a hot block. Only sums per word leave a group, never pairs.

Defined results: a null text has no words, a null doc_id is written as nothing before the colon; repeated rows count
each; of near words of equal count the smaller in code-point order is the form; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

MIN_LENGTH = 7
MIN_COUNT = 2
#: The form of a word is at least as many times as frequent.
DOMINANCE = 10
#: A run whose checksum this divides loses a letter.
DAMAGE = 31
TILE = 2048
#: Words counted in a task before they are put out.
BLOCK = 400_000
#: Letters held in a matrix at once.
MATRIX = 1 << 24
#: Columns of the letter counts: a-z, and the letters above them dealt over the rest.
DIMENSIONS = 32

#: In Latin-1: A-Z lower-cased, a-z and U+00C0 to U+00FF; all else separates, as do characters beyond.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
CLASSES = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])


def words_of(doc_id: int | None, text: str, min_length: int = MIN_LENGTH, damage: int = DAMAGE) -> Counter:
    """Words of a text, in Latin-1, after the damage that its doc_id gives."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = [w for w in text.encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= min_length]
    out: Counter = Counter()
    for word, n in Counter(found).items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
        if h % damage == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < min_length:
                continue
        out[word] += n
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) over all ``docs`` (doc_id, text)."""

    def put_out(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                held.update(words_of(doc_id, text or "", min_length, damage))
                if len(held) >= BLOCK:
                    yield put_out(held)
                    held = Counter()
        yield put_out(held)

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def blocks(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(side, length, half, a, b, second, role, word, n): each word in its blocks, dealt over pairs of tiles.

    ``length`` is that of the shorter words of the block, role 0 are words of it, role 1 those one longer; ``half`` is a
    hash of the half. ``second`` tells the rows of tile b where the tiles differ."""
    size = F.length("word")
    entries = []
    for role in (0, 1):
        length = size - role
        first = F.floor(length / 2).cast("int")
        for side, half in ((0, F.substring("word", F.lit(1), first)), (1, F.right("word", length - first))):
            entries.append(F.struct(F.lit(side).alias("side"), length.alias("length"), F.xxhash64(half).alias("half"), F.lit(role).alias("role")))
    keys = ["side", "length", "half"]
    keyed = words.select("word", "n", F.explode(F.array(*entries)).alias("e")).select("e.*", "word", "n")
    crowded = (
        keyed.groupBy(*keys).agg(F.count("*").alias("members")).where(F.col("members") > tile)
        .select(*keys, F.ceil(F.col("members") / tile).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    return (
        keyed.join(crowded, keys, "left")
        .withColumn("own", F.pmod(F.xxhash64("word"), tiles).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select(*keys, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                (F.col("own") > F.col("other")).alias("second"), "role", "word", "n")
    )


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words as a matrix padded by zeros, and their lengths."""
    encoded = np.array([w.encode("latin-1") for w in words])
    sizes = np.array([len(w) for w in words])
    return encoded.view(np.uint8).reshape(len(words), -1), sizes


def letter_counts(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(matrix)), sizes)
    present = matrix[np.arange(matrix.shape[1])[None, :] < sizes[:, None]]
    flat = np.bincount(rows * DIMENSIONS + CLASSES[present], minlength=len(matrix) * DIMENSIONS)
    return flat.reshape(-1, DIMENSIONS).astype(np.float32)


def close_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs whose letter counts have a squared distance of two at most."""
    one = np.ones((len(left), 1), np.float32)
    other = np.ones((len(right), 1), np.float32)
    a = np.hstack([-2 * left, (left * left).sum(1, keepdims=True), one])
    b = np.hstack([right, other, (right * right).sum(1, keepdims=True)])
    found = []
    step = max(1, (1 << 22) // max(1, len(right)))
    for at in range(0, len(left), step):
        i, j = np.nonzero(a[at : at + step] @ b.T < 2.5)
        found.append((i + at, j))
    i, j = (np.concatenate(x) for x in zip(*found))
    return i, j


def one_edit(x: np.ndarray, y: np.ndarray, longer: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether row pairs of letters differ by one edit; ``sizes`` are those of ``x``, and ``y`` has a letter more where ``longer``."""
    differ = x != y
    replaced = differ.sum(1) == 1
    width = x.shape[1]
    same_before = np.where(differ.any(1), differ.argmax(1), width)
    shifted = np.zeros_like(differ)
    shifted[:, : width - 1] = x[:, : width - 1] != y[:, 1:]
    place = np.arange(width)[None, :]
    # all letters from the first difference on stand one place further in the longer word
    inserted = ~(shifted & (place >= same_before[:, None]) & (place < sizes[:, None])).any(1)
    return np.where(longer, inserted, replaced)


GROUP = ["side", "length", "half", "a", "b"]


def _between(counts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs of one group. ``ends`` limits its rows: short and long words of tile a, then of tile b."""
    s, short, e, short_b, e_b = ends.tolist()
    out = []
    if e == e_b:  # one tile
        if short > s and e - s > 1:
            i, j = close_pairs(counts[s:short], counts[s:e])
            out.append((i[i < j] + s, j[i < j] + s))
    else:
        for left, right in (((s, short), (e, e_b)), ((e, short_b), (short, e))):
            if left[0] < left[1] and right[0] < right[1]:
                i, j = close_pairs(counts[slice(*left)], counts[slice(*right)])
                out.append((i + left[0], j + right[0]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*out))


def frame_pairs(frame: pd.DataFrame, starts: np.ndarray, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near words (row numbers) within the groups that begin at ``starts``; the first is no longer than the second."""
    counts = letter_counts(chars, sizes)
    role, side = frame["role"].to_numpy(), frame["side"].to_numpy()
    part = 2 * frame["second"].to_numpy() + role
    per_part = [np.add.reduceat(part == k, starts) for k in range(4)]
    limits = np.cumsum([starts, *per_part], axis=0).T
    found = [_between(counts, ends) for ends in limits if ends[-1] - ends[0] > 1]
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    i, j = (np.concatenate(x) for x in zip(*found))
    first = np.arange(chars.shape[1])[None, :] < (frame["length"].to_numpy() // 2)[:, None]
    keep = np.zeros(len(i), bool)
    step = max(1, (1 << 24) // chars.shape[1])
    for at in range(0, len(i), step):
        p, q = i[at : at + step], j[at : at + step]
        x, y = chars[p], chars[q]
        same_half = ~((x != y) & first[p]).any(1)  # such pairs are met in a block of first halves
        keep[at : at + step] = (same_half == (side[p] == 0)) & one_edit(x, y, role[q] == 1, sizes[p])
    return i[keep], j[keep]


def _near(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame | None:
    """Per word and group with a near word: their number and the most frequent."""
    words, n = frame["word"].to_numpy(), frame["n"].to_numpy()
    chars, sizes = letters(words.tolist())
    i, j = frame_pairs(frame, starts, chars, sizes)
    if not len(i):
        return None
    order = np.argsort(chars.view(f"S{chars.shape[1]}").ravel(), kind="stable")
    place = np.empty(len(words), int)
    place[order] = np.arange(len(words))
    x, y = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((place[y], -n[y], x))
    x, y = x[order], y[order]
    firsts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    near = np.diff(np.r_[firsts, len(x)])
    return pd.DataFrame({"word": words[x[firsts]], "n_near": near, "best_n": n[y[firsts]], "best": words[y[firsts]]})


def _parts(frame: pd.DataFrame, starts: np.ndarray):
    """Cuts a frame of whole groups, so that a matrix of its letters stays small; groups are sorted by length."""
    ends = np.r_[starts[1:], len(frame)]
    width = frame["length"].to_numpy()[starts] + 1
    at = 0
    for k in range(1, len(starts) + 1):
        if k == len(starts) or (ends[k] - starts[at]) * width[k] > MATRIX:
            yield frame.iloc[starts[at] : ends[k - 1]], starts[at:k] - starts[at]
            at = k


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) per word and group: how many near words, and the most frequent of them."""
    dealt = blocks(words, tile).repartition(*GROUP).sortWithinPartitions("length", *GROUP, "second", "role")

    def whole(frame: pd.DataFrame, starts: np.ndarray):
        for part, firsts in _parts(frame, starts):
            found = _near(part, firsts)
            if found is not None:
                yield found

    def run(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            starts = _starts(frame)
            if len(starts) > 1:
                yield from whole(frame.iloc[: starts[-1]], starts[:-1])
            rest = frame.iloc[starts[-1] :].reset_index(drop=True) if len(starts) else None
        if rest is not None:
            yield from whole(rest, np.zeros(1, int))

    return dealt.mapInPandas(run, "word string, n_near long, best_n long, best string")


def _starts(frame: pd.DataFrame) -> np.ndarray:
    if not len(frame):
        return np.zeros(0, np.int64)
    changed = np.zeros(len(frame), bool)
    changed[0] = True
    for name in GROUP:
        values = frame[name].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of the chain of forms. Each round doubles the steps taken."""
    found = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    while found.where("open").limit(1).count():
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"), F.col("open").alias("further_open"))
        found = materialise(
            found.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.coalesce("further_open", F.lit(False)).alias("open")
            ),
            instead_of=found,
        )
    return found.select("word", "root")


def group_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, dominance: int = DOMINANCE,
    damage: int = DAMAGE, tile: int = TILE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text)."""
    words = materialise(word_counts(docs, min_length, min_count, damage))
    near = near_words(words, tile).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    )
    enough = -F.col("best.n") >= dominance * F.col("n")
    judged = materialise(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n"),
        )
    )
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
