"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Vectors are dealt into shards of about ``shard_rows`` by row number, so equal vectors do not meet in
one. Each shard is one graph: points come in blocks, a greedy search over the graph so far proposes
neighbours, relaxed distance pruning keeps diverse ones (a neighbour is dropped if another kept one is
``ALPHA`` times nearer to it than the point is), and edges back are added, pruned where a row has too
many. ``PASSES`` above one repeat this over the finished graph. The graphs are stored; every block of queries then searches
each shard with a beam, and the best over all shards are kept.

Distances inside a shard are between unit vectors; the score is the cosine of the original vectors in
double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, neither do those whose length is not the most frequent one; ties go to the smaller id; a query
never finds rows of its own id; repeated rows are each found, and rows that share a query's id are queries with a list
of their own each; fewer candidates give fewer rows; an
empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

SHARD_ROWS = 8192
QUERY_ROWS = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
PASSES = 1
BLOCK = 256


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as arrays of double."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).alias("vec_id"), v.alias("v"))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def beam_search(
    points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and distances of the ``beam`` nearest points found for each query, nearest first;
    -1 and infinity fill up. In each round, every query expands its nearest point not yet expanded."""
    n, q = len(points), len(queries)
    found = np.full((q, beam), -1, np.int64)
    far = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    k = min(beam, len(entries))
    first = 2 - 2 * queries @ points[entries].T
    order = np.argsort(first, axis=1, kind="stable")[:, :k]
    found[:, :k], far[:, :k], done[:, :k] = entries[order], np.take_along_axis(first, order, 1), False
    seen = np.zeros((q, n), bool)
    seen[:, entries] = True
    active = np.arange(q)
    while len(active):
        waiting = np.where(done[active], np.inf, far[active])
        at = waiting.argmin(1)
        more = np.isfinite(waiting[np.arange(len(active)), at])
        active, at = active[more], at[more]
        if not len(active):
            break
        done[active, at] = True
        near = edges[found[active, at]]
        new = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None], np.where(near >= 0, near, found[active, at][:, None])] = True
        distance = 2 - 2 * np.matmul(points[near], queries[active][:, :, None])[:, :, 0]
        distance = np.where(new, distance, np.inf).astype(np.float32)
        all_far = np.concatenate([far[active], distance], 1)
        all_found = np.concatenate([found[active], np.where(new, near, -1)], 1)
        all_done = np.concatenate([done[active], ~new], 1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[active], found[active] = np.take_along_axis(all_far, order, 1), np.take_along_axis(all_found, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return found, far


def robust_prune(points: np.ndarray, rows: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each row out of its candidates (-1: none): the nearest is kept, and candidates
    that are ``alpha`` times nearer to it than to the row are dropped, again and again."""
    own = (candidates < 0) | (candidates == rows[:, None])
    ordered = np.sort(np.where(own, len(points), candidates), axis=1)
    repeated = np.zeros_like(own)
    repeated[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    gone = repeated | (ordered == len(points))
    candidates = np.where(gone, 0, ordered)
    vectors = points[candidates]
    far = np.where(gone, np.inf, 2 - 2 * np.matmul(vectors, points[rows][:, :, None])[:, :, 0])
    apart = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    out = np.full((len(rows), degree), -1, np.int64)
    each = np.arange(len(rows))
    for k in range(degree):
        best = far.argmin(1)
        open_ = np.isfinite(far[each, best])
        if not open_.any():
            break
        out[open_, k] = candidates[each, best][open_]
        far[alpha * apart[each, best] <= far] = np.inf
        far[each, best] = np.inf
    return out


def build_graph(
    points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, block: int = BLOCK, passes: int = PASSES
) -> np.ndarray:
    """Edges (rows x degree, -1: none) of the graph of unit vectors. Row 0 on is where searches enter."""
    n = len(points)
    edges = np.full((n, degree), -1, np.int64)
    for passed in range(passes):
        for at in range(0, n, block):
            rows = np.arange(at, min(at + block, n))
            known = rows[-1] + 1 if passed == 0 else n
            found, _ = beam_search(points[:known], edges[:known], entries(known), points[rows], beam)
            if passed == 0:  # the block's own points are no part of the graph yet
                near = np.argsort(2 - 2 * points[rows] @ points[rows].T, axis=1)[:, : degree + 1]
                found = np.concatenate([found, rows[near]], 1)
            edges[rows] = robust_prune(points, rows, np.concatenate([found, edges[rows]], 1), degree, alpha)
            source, target = np.repeat(rows, degree), edges[rows].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            to, starts, counts = np.unique(target, return_index=True, return_counts=True)
            back = np.full((len(to), counts.max(initial=0)), -1, np.int64)
            for i, (s, c) in enumerate(zip(starts, counts)):
                back[i, :c] = source[s : s + c]
            # a row takes its new edges as they are while there is room, and is pruned beyond that
            joined = np.concatenate([edges[to], back], 1)
            joined = np.take_along_axis(joined, np.argsort(joined < 0, axis=1, kind="stable"), 1)
            full = (joined >= 0).sum(1) > degree
            edges[to[~full]] = joined[~full][:, :degree]
            to, joined = to[full], joined[full]
            for i in range(0, len(to), block):
                edges[to[i : i + block]] = robust_prune(points, to[i : i + block], joined[i : i + block], degree, alpha)
    return edges


def entries(n: int) -> np.ndarray:
    """Where searches enter: the first rows, whose order is that of a hash."""
    return np.arange(min(n, 32))


def _nearest(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["vec_id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64)


def graphs(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, vec_id, v, edges): one graph per shard, rows in the order of their numbers in edges."""
    numbered = materialise(rows.withColumn("_row", F.xxhash64(F.monotonically_increasing_id())))
    shards = max(1, round(numbered.count() / shard_rows))
    dealt = numbered.withColumn("shard", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row").reset_index(drop=True)
        _, vectors = _nearest(pdf)
        edges = build_graph(unit(vectors))
        return pd.DataFrame({"shard": pdf["shard"], "place": np.arange(len(pdf)), "vec_id": pdf["vec_id"], "v": pdf["v"], "edges": list(edges)})

    kind = dict(rows.dtypes)["vec_id"]
    built = dealt.groupBy("shard").applyInPandas(run, f"shard int, place int, vec_id {kind}, v array<double>, edges array<int>")
    return materialise(built)


def search(graph: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of other ids for every query (vec_id, v)."""
    stored = materialise(queries.withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, -(-stored.count() // query_rows))
    shards = (graph.agg(F.max("shard")).first()[0] or 0) + 1
    asked = stored.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    # every block of queries goes to every shard, and every shard to every block of queries
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(points: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(wanted):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        points = points.sort_values("place")
        (ids, vectors), (query_ids, asked_for) = _nearest(points), _nearest(wanted)
        edges, units = np.stack(points["edges"].to_numpy()).astype(np.int64), unit(vectors)
        own = wanted["_row"].to_numpy()
        return pd.concat(_answers(ids, vectors, units, edges, own, query_ids, asked_for, k, beam), ignore_index=True)

    kind = dict(queries.dtypes)["vec_id"]
    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        run, f"query_row long, query_id {kind}, vec_id {kind}, score double"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _answers(ids, vectors, units, edges, query_rows, query_ids, asked_for, k: int, beam: int) -> Iterator[pd.DataFrame]:
    for at in range(0, len(query_ids), BLOCK):
        own, wanted = zip(query_rows[at : at + BLOCK], query_ids[at : at + BLOCK]), asked_for[at : at + BLOCK]
        found, _ = beam_search(units, edges, entries(len(units)), unit(wanted), beam)
        for (query_row, query), x, rows in zip(own, wanted, found):
            rows = rows[rows >= 0]
            rows = rows[ids[rows] != query]
            near = vectors[rows]
            score = (near @ x) / (np.sqrt((near * near).sum(1)) * np.sqrt((x * x).sum()))
            best = np.lexsort((ids[rows], -score))[:k]
            yield pd.DataFrame({"query_row": query_row, "query_id": query, "vec_id": ids[rows[best]], "score": score[best]})


def neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The ``k`` nearest vectors by cosine of every row for which ``is_query`` (of vec_id) holds."""
    rows = materialise(usable(vectors, vec_id, embedding))
    return search(graphs(rows, shard_rows), rows.where(is_query), k)
