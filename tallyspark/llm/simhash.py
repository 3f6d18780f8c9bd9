"""Near-duplicate documents by SimHash fingerprints and tables of distances to pivots.

Every distinct fingerprint gets a row of Hamming distances to reference fingerprints. Two kinds of
reference are used. Unit references, one per bit, differ from the zero reference in that bit alone;
their distances tell the bits, so fingerprints that agree on all unit references of some blocks have
an equal join key. With blocks >= radius + 1, fingerprints within the radius agree on at least
blocks - radius blocks, so every link shares a bucket of one choice of blocks. Inside a bucket,
the distances to the random pivots decide first: by the triangle inequality, a pair with a
coordinate difference above the radius is no link. What survives is verified by its bits.

A bucket links each member to the smallest one it reaches there, so the links kept grow with the
members, not with their pairs. Buckets above ``tile`` members are cut into tiles, and every pair of
tiles is a group of its own, which bounds memory and spreads a hot bucket.

Defined results: null and blank texts have fingerprint zero and are linked like any other; repeated
rows and equal fingerprints are one component; the id is the smallest, nulls last; an empty table
gives no rows. Further columns are ignored by ``fingerprints`` and kept by ``keep_first``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from .components import connected

RADIUS = 3
BLOCKS = 6
PIVOTS = 16
TILE = 2048
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash over word shingles, repeats included: a bit is set in over half of the hashes."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(w) for w in zip(*(words[i:] for i in range(shingle)))] if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), ">u8", len(shingles))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, shingle: int = 3, fp: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of the column text; its 64 bits are held as a signed long."""
    source = docs.drop(fp)
    schema = StructType(source.schema.fields[:]).add(fp, "long")

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], [*batch.schema.names, fp])

    return source.mapInArrow(run, schema)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivots(n: int = PIVOTS) -> list[int]:
    rng = np.random.default_rng(SEED)
    return [int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64)]


def pivot_table(fps: DataFrame, references: list[int]) -> DataFrame:
    """``fps`` with the distance to each reference, eight to a long: columns t0, t1, ..."""
    columns = []
    for at in range(0, len(references), 8):
        packed = F.lit(0).cast("long")
        for i, p in enumerate(references[at : at + 8]):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p)))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(distance, 8 * i))
        columns.append(packed.alias(f"t{at // 8}"))
    return fps.select("fp", *columns)


def choices(radius: int, blocks: int) -> list[int]:
    """Bit masks of all choices of ``blocks - radius`` blocks."""
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, blocks - radius)]


def _tile_links(fps: np.ndarray, table: np.ndarray, left: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member reached) among the rows of one group. The first ``left`` rows
    and the others are two tiles, compared with each other, or one tile if ``left`` is all rows."""
    n = len(fps)
    label = np.arange(n)
    first, second = np.arange(left), np.arange(left, n) if left < n else np.arange(n)
    pairs = []
    step = max(1, (1 << 21) // max(1, len(second)))
    for at in range(0, len(first), step):
        rows = first[at : at + step]
        near = np.abs(table[rows, 0][:, None] - table[second, 0][None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = rows[i], second[j]
        if left == n:
            keep = i < j
            i, j = i[keep], j[keep]
        for k in range(1, table.shape[1]):
            keep = np.abs(table[i, k] - table[j, k]) <= radius
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(fps[i] ^ fps[j]) <= radius
        i, j = i[keep], j[keep]
        for _ in range(3):  # shortens the pairs kept; the loop below makes the labels final
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        open_ = label[i] != label[j]
        pairs.append((i[open_], j[open_]))
    i, j = (np.concatenate(x) for x in zip(*pairs))
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(n))
    return fps[member].view(np.int64), fps[label[member]].view(np.int64)


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, references: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp): their components are those of all pairs
    within ``radius``. Pairs themselves are not listed."""
    masks = choices(radius, blocks)
    table = pivot_table(fps, pivots(references))
    extra = [c for c in table.columns if c != "fp"]
    keyed = table.select(
        "fp", *extra, F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("choice", "key")
    )
    crowded = (
        keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        .select("choice", "key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    dealt = (
        keyed.join(crowded, ["choice", "key"], "left")
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("fp", *extra, "choice", "key", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    )
    groups = ["choice", "key", "a", "b"]
    sorted_groups = dealt.repartition(*groups).sortWithinPartitions(*groups, "own", "fp")

    def run(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            starts = group_starts(frame, groups)
            rest = frame.iloc[starts[-1] :] if len(starts) else frame
            yield from _frame_links(frame, starts, extra, radius)
        if rest is not None and len(rest):
            yield from _frame_links(rest.reset_index(drop=True), np.array([0, len(rest)]), extra, radius)

    return sorted_groups.mapInPandas(run, "a long, b long")


def group_starts(frame: pd.DataFrame, groups: list[str]) -> np.ndarray:
    if not len(frame):
        return np.zeros(0, np.int64)
    values = frame[groups].to_numpy(np.int64)
    return np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(1)])


def _frame_links(frame: pd.DataFrame, starts: np.ndarray, extra: list[str], radius: int):
    """Links of the groups between consecutive ``starts``; groups of one row have none."""
    fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
    table = np.ascontiguousarray(frame[extra].to_numpy(np.int64)).view(np.uint8).astype(np.int8)
    own, a = frame["own"].to_numpy(), frame["a"].to_numpy()
    out = []
    for s, e in zip(starts[:-1], starts[1:]):
        if e - s > 1:
            left = int((own[s:e] == a[s]).sum())
            if left:
                out.append(_tile_links(fps[s:e], table[s:e], left, radius))
    if out:
        x, y = (np.concatenate(c) for c in zip(*out))
        yield pd.DataFrame({"a": x, "b": y})


def fingerprint_roots(fps: DataFrame, radius: int, blocks: int, tile: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``fps``."""
    distinct = materialise(fps.select("fp").distinct())
    roots = connected(links(distinct, radius, blocks, tile=tile)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shingle: int = 3, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links."""
    prints = materialise(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"))
    roots = materialise(fingerprint_roots(prints, radius, blocks, tile))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("id"))  # a row per text, so that no component is hot
    lowest = first.join(roots, "fp").groupBy("root").agg(F.min("id").alias("component_id"))
    component = roots.join(lowest, "root").select("fp", "component_id")
    return prints.join(component, "fp").select("doc_id", "fp", "component_id")


def named_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but doc_id and text numbered, so that no name clashes with one made here."""
    return docs.toDF(*[n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(docs.columns)])


def keep_first(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shingle: int = 3, tile: int = TILE) -> DataFrame:
    """One row of ``docs`` per component: that with the smallest doc_id, nulls last; of repeated rows, one."""
    own = named_apart(docs)
    stored = materialise(with_fingerprint(own, shingle).withColumn("row", F.monotonically_increasing_id()))
    prints = stored.select("doc_id", "fp", "row")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), "row")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    roots = fingerprint_roots(prints, radius, blocks, tile)
    kept = first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    return stored.join(kept, "row", "left_semi").select(*own.columns).toDF(*docs.columns)


def hex_digits(fp) -> "F.Column":
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
