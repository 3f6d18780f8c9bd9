"""Near copies by the Jaccard similarity of their sets of word shingles.

The tables of distances of ``simhash.links``, over fingerprints of the sets, propose the close copies. Fingerprints of
64 bits cannot propose all texts of similarity 0.8: those differ in ten bits on average and in up to about twenty, and
equal blocks of so wide a radius hold three bits each. So ``BANDS`` keys per text propose as well,
each made of ``ROWS`` minimum hashes: two texts of similarity s share none with probability
(1 - s**ROWS)**BANDS, which is 5e-6 at 0.8 and less above. Every proposed link is then verified on the whole sets.

Equal sets are one node. A bucket proposes each member with its centre, the member that meets most others in
all its buckets (an original among its copies). Where the links found leave a bucket in several components, its
members meet in tiles with their sets, and every two tiles are a group of their own. There distances of SimHash
fingerprints to pivots discard pairs first (two texts of similarity 0.8 differ in over ``RADIUS`` of 64 bits once in
some ten millions), whole sets decide, and only links that join components leave the group, so rows put out
grow with the members. Comparisons inside a bucket that stays in many components grow with its square, in blocks.

Defined results: words are cut and lower-cased as in ``simhash.fingerprint``; a text of fewer words than a shingle
is one shingle; null and blank texts are equal; shingles are compared by hashes of 64 bits. Of a component the row
with the smallest doc_id stays, nulls last; of repeated rows, one; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from ..session import materialise
from . import simhash
from .components import connected
from .simhash import group_starts, named_apart, pivots

SIMILARITY = 0.8
SHINGLE = 5
BANDS = 40
ROWS = 6
#: Bits in which linked texts may differ, and members of a tile.
RADIUS = 28
TILE = 256
SEED = 42


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    n = min(shingle, len(words))
    mixed = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> list[int]:
    """A key per band: its number and its minimum hashes."""
    import xxhash

    if not len(hashes):
        return []
    rng = np.random.default_rng(SEED)
    mask, factor = rng.integers(0, 1 << 64, (2, bands * rows), dtype=np.uint64)
    factor |= np.uint64(1)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = (hashes[at : at + 1024, None] ^ mask) * factor
        np.minimum(low, mixed.min(0), out=low)
    parts = low.reshape(bands, rows)
    return [xxhash.xxh64_intdigest(part.tobytes(), i) for i, part in enumerate(parts)]


def _signed(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def with_bands(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with _set, a hash of the set of shingles, _fp, its fingerprint, and _bands."""
    import xxhash

    source = docs.drop("_set", "_fp", "_bands")
    schema = StructType(source.schema.fields[:]).add("_set", "long").add("_fp", "long").add("_bands", ArrayType(LongType()))

    def run(batches):
        for batch in batches:
            found = [shingles(t, shingle) for t in batch["text"].to_pylist()]
            sets = _signed(np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in found], np.uint64))
            prints = _signed(np.array([set_fingerprint(h) for h in found], np.uint64))
            bands = [_signed(np.array(band_keys(h), np.uint64)) for h in found]
            columns = [pa.array(sets), pa.array(prints), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "_set", "_fp", "_bands"])

    return source.mapInArrow(run, schema)


def set_fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set of shingles: a bit is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_shingles(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, fp, hashes) of ``texts`` (node, text): the fingerprint and the set of shingles."""

    def run(batches):
        for batch in batches:
            found = [shingles(t, shingle) for t in batch["text"].to_pylist()]
            prints = _signed(np.array([set_fingerprint(h) for h in found], np.uint64))
            columns = [batch["node"], pa.array(prints), pa.array([_signed(h) for h in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "fp", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node long, fp long, hashes array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets of shingles are as similar; ``sets`` has (node, hashes)."""
    hashes = sets.select("node", "hashes")
    both = pairs.join(hashes.toDF("a", "_x"), "a").join(hashes.toDF("b", "_y"), "b")
    shared = F.size(F.array_intersect("_x", "_y"))
    return both.where(shared / (F.size("_x") + F.size("_y") - shared) >= similarity).select("a", "b")


def group_links(fps: np.ndarray, table: np.ndarray, sets: list[np.ndarray], roots: np.ndarray, left: int, similarity: float, radius: int = RADIUS):
    """Links (row numbers) that join the components of one group's rows. The first ``left`` rows and the others are two
    tiles, compared with each other, or one tile if ``left`` is all rows."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    _, label = np.unique(roots, return_inverse=True)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if sizes.sum() else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 0, bool)
    rows, first = [], 0 if left == n else left
    for i in range(left):
        j = np.arange(max(first, i + 1), n)
        j = j[label[j] != label[i]]
        j = j[(np.abs(table[j] - table[i]) <= radius).all(1)]
        j = j[np.bitwise_count(fps[j] ^ fps[i]) <= radius]
        j = j[np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i])]
        if not len(j):
            continue
        own = flat[ends[i] - sizes[i] : ends[i]]
        mark[own] = True
        shared = np.array([np.count_nonzero(mark[flat[ends[k] - sizes[k] : ends[k]]]) for k in j])
        mark[own] = False
        for k in j[shared >= similarity * (sizes[i] + sizes[j] - shared)]:
            if label[k] != label[i]:
                label[label == label[k]] = label[i]
                rows.append((i, k))
    return rows


GROUP = ["key", "t1", "t2"]


def open_links(members: DataFrame, sets: DataFrame, similarity: float, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join the components of ``members`` (key, node, root) of one key."""
    crowded = (
        members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        .select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    dealt = (
        members.join(crowded, "key", "left")
        .withColumn("own", F.pmod(F.xxhash64("node"), tiles).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("key", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"),
                (F.col("own") > F.col("other")).alias("second"), "node", "root")
    )
    placed = dealt.join(sets, "node").repartition(*GROUP).sortWithinPartitions(*GROUP, "second", "node")
    references = np.array(pivots(), np.uint64)

    def found(frame: pd.DataFrame):
        second = frame["second"].to_numpy()
        left = int((~second).sum())
        if left < 1 or frame["root"].nunique() < 2:
            return
        fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
        table = np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)
        nodes = frame["node"].to_numpy()
        pairs = group_links(fps, table, frame["hashes"].tolist(), frame["root"].to_numpy(), left, similarity)
        if pairs:
            i, j = np.array(pairs).T
            yield pd.DataFrame({"a": nodes[i], "b": nodes[j]})

    def run(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            starts = group_starts(frame, GROUP)
            for s, e in zip(starts[:-1], starts[1:]):
                yield from found(frame.iloc[s:e])
            rest = frame.iloc[starts[-1] :].reset_index(drop=True) if len(starts) else None
        if rest is not None:
            yield from found(rest)

    return placed.mapInPandas(run, "a long, b long").distinct()


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b), a > b, of ``nodes`` (node, fp) that ``simhash.links`` proposes: each node with the first of its
    fingerprint, and the first of a fingerprint with that of the smallest one it reaches."""
    first = materialise(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    equal = nodes.join(first.where("n > 1"), "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    reached = simhash.links(first.select("fp")).distinct()
    named = reached.join(first.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    return equal.unionByName(named.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).distinct()


def links(nodes: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """Verified links (a, b) between ``nodes`` (node, fp, bands): their components are those of all pairs as similar."""
    close = materialise(fingerprint_pairs(nodes.select("node", "fp")))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = materialise(keyed.join(shared, "key"))
    meetings = members.select("node", "n").unionByName(close.select(F.explode(F.array("a", "b")).alias("node"), F.lit(0).cast("long").alias("n")))
    needed = materialise(meetings.groupBy("node").agg(F.sum("n").alias("met")))
    sets = materialise(with_shingles(texts.join(needed, "node", "left_semi"), shingle))
    centres = members.join(needed, "node").groupBy("key").agg(F.max(F.struct("met", "node")).getField("node").alias("centre"))
    stars = members.join(centres, "key").where("node <> centre").select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
    found = materialise(verified(stars.unionByName(close).distinct(), sets, similarity))
    root = materialise(connected(found))
    named = materialise(members.join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
    several = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return found.unionByName(open_links(named.join(several, "key", "left_semi"), sets, similarity, tile))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component of texts that are as similar: that with the smallest doc_id."""
    names = docs.columns
    own = named_apart(docs)
    stored = materialise(with_bands(own, shingle).withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    nodes = materialise(
        stored.groupBy(F.col("_set").alias("node")).agg(F.min(order).alias("first"), F.first("_fp").alias("fp"), F.first("_bands").alias("bands"))
    )
    texts = stored.join(nodes.select("node", F.col("first.row").alias("_row")), "_row").select("node", "text")
    root = connected(links(nodes.select("node", "fp", "bands"), texts, similarity, shingle))
    grouped = nodes.select("node", "first").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = grouped.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    return stored.join(kept, "_row", "left_semi").select(*own.columns).toDF(*names)
