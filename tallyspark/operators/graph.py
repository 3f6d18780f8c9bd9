"""Graph operators on vertices(id, …) and edges(src, dst, attr).

Messages are reduced per task before they are shuffled. Loops store the edges once in buckets of their source,
those of a hub with a large share of them apart, so that a round moves messages and no edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, remove
from .bucketed import Deltas, KeyedRows
from .sizes import skew_join


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def with_defaults(vertices: DataFrame, edges: DataFrame, defaults: dict) -> DataFrame:
    """All vertices, plus the endpoints that have no row, which get the default attributes."""
    extra = (
        endpoints(edges)
        .join(vertices.select("id"), "id", "left_anti")
        .select("id", *[F.lit(v).alias(k) for k, v in defaults.items()])
    )
    return vertices.unionByName(extra)


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the attributes of both ends as ``src_*`` and ``dst_*``."""
    attrs = [c for c in vertices.columns if c != "id"]
    src = vertices.select(F.col("id").alias("src"), *[F.col(c).alias(f"src_{c}") for c in attrs])
    dst = vertices.select(F.col("id").alias("dst"), *[F.col(c).alias(f"dst_{c}") for c in attrs])
    return edges.join(src, "src").join(dst, "dst")


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))


def degrees(edges: DataFrame) -> DataFrame:
    """In-, out- and total degree in one aggregation; isolated vertices are absent."""
    zero, one = F.lit(0), F.lit(1)
    ends = F.array(
        F.struct(F.col("src").alias("id"), zero.alias("i"), one.alias("o")),
        F.struct(F.col("dst").alias("id"), one.alias("i"), zero.alias("o")),
    )
    return (
        edges.select(F.inline(ends))
        .groupBy("id")
        .agg(
            F.sum("i").alias("in_degree"),
            F.sum("o").alias("out_degree"),
            F.count("*").alias("degree"),
        )
    )


def degrees_full(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degrees of every vertex, 0 where there are no edges."""
    return outer_join_vertices(vertices, degrees(edges), {"in_degree": 0, "out_degree": 0, "degree": 0})


def max_degree(edges: DataFrame) -> DataFrame:
    """(kind, id, degree) of the vertex with the largest in-, out- and total degree."""
    kinds = {"in": "in_degree", "out": "out_degree", "total": "degree"}
    best = degrees(edges).agg(
        *[F.max(F.struct(F.col(c).alias("d"), (-F.col("id")).alias("neg"))).alias(k) for k, c in kinds.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(k).alias("kind"), (-F.col(f"{k}.neg")).alias("id"), F.col(f"{k}.d").alias("degree")) for k in kinds]
    )
    return best.select(F.inline(rows))


def subgraph(
    vertices: DataFrame, edges: DataFrame, vertex_filter: Column | None = None, edge_filter: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Vertices that pass, and edges that pass and keep both ends.

    ``edge_filter`` may use src, dst and attr.
    """
    kept = vertices if vertex_filter is None else vertices.where(vertex_filter)
    rest = edges if edge_filter is None else edges.where(edge_filter)
    if vertex_filter is None:
        return kept, rest
    ids = kept.select("id")
    rest = rest.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
    return kept, rest.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*edges.columns)


def join_vertices(vertices: DataFrame, values: DataFrame, column: str, new: str) -> DataFrame:
    """Replace ``column`` by ``new`` where ``values`` has the vertex."""
    joined = vertices.join(values.select("id", new), "id", "left")
    return joined.withColumn(column, F.coalesce(F.col(new), F.col(column))).drop(*({new} - {column}))


def outer_join_vertices(vertices: DataFrame, values: DataFrame, defaults: dict) -> DataFrame:
    """Add the columns of ``values``; vertices without a row get the defaults."""
    joined = vertices.join(values, "id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def aggregate_messages(vertices: DataFrame, edges: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregate over the in-neighbours of each vertex, whose attributes are ``src_*``."""
    attrs = [c for c in vertices.columns if c != "id"]
    src = vertices.select(F.col("id").alias("src"), *[F.col(c).alias(f"src_{c}") for c in attrs])
    return edges.join(src, "src").groupBy(F.col("dst").alias("id")).agg(*aggregates)


def extreme_follower(vertices: DataFrame, edges: DataFrame, oldest: bool) -> DataFrame:
    """The oldest or youngest in-neighbour; the lower id wins among equal ages."""
    age = F.col("src_age") if oldest else -F.col("src_age")
    best = F.max(F.struct(age.alias("a"), (-F.col("src")).alias("neg"), F.col("src_name").alias("name")))
    sign = 1 if oldest else -1
    return aggregate_messages(vertices, edges, best.alias("b")).select(
        "id",
        (-F.col("b.neg")).alias("follower_id"),
        F.col("b.name").alias("follower_name"),
        (F.col("b.a") * sign).alias("follower_age"),
    )


def mean_follower_age(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return aggregate_messages(vertices, edges, F.avg("src_age").alias("mean_age"))


def mean_age_report(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, report): the mean age of its followers for every vertex, also for those without."""
    joined = vertices.join(mean_follower_age(vertices, edges), "id", "left")
    known = F.concat(F.lit("Followers of "), F.col("name"), F.lit(" are "), F.format_number("mean_age", 2), F.lit(" years old on average."))
    return joined.select("id", F.coalesce(known, F.concat(F.col("name"), F.lit(" is followed by nobody."))).alias("report"))


def follower_report(vertices: DataFrame, edges: DataFrame, oldest: bool = True) -> DataFrame:
    """(id, report): a sentence for every vertex, also for those without followers."""
    word = "oldest" if oldest else "youngest"
    joined = vertices.join(extreme_follower(vertices, edges, oldest), "id", "left")
    text = F.when(
        F.col("follower_id").isNull(),
        F.concat(F.lit("Nobody follows "), F.col("name"), F.lit(".")),
    ).otherwise(F.concat(F.lit(f"The {word} who follows "), F.col("name"), F.lit(" is "), F.col("follower_name"), F.lit(".")))
    return joined.select("id", text.alias("report"))


def counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    n_vertices = vertices.agg(F.count("*").alias("n")).select(F.lit("vertices").alias("what"), "n")
    n_edges = edges.agg(F.count("*").alias("n")).select(F.lit("edges").alias("what"), "n")
    return n_vertices.unionByName(n_edges)


def path_offers(edges: KeyedRows, senders: DataFrame) -> DataFrame:
    """(id, dist): the shortest way over one more edge from ``senders`` (id, dist)."""
    return edges.joined(senders, "id").groupBy(F.col("dst").alias("id")).agg(F.min(F.col("dist") + F.col("attr")).alias("dist"))


def shortest_paths(vertices: DataFrame, edges: DataFrame, source: int) -> DataFrame:
    """(id, dist) from ``source`` along weighted edges; unreachable vertices get infinity.

    Only vertices improved in the last round send messages, and a round stores only what it improved. The
    edges lie in buckets of their source and stay there. The loop ends when no distance improves, which it must as
    weights below 0 are refused.
    """
    ids = vertices.select("id")
    inside = edges.select("src", "dst", F.col("attr").cast("double").alias("attr")).join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    stored = KeyedRows(inside, "src")
    if (stored.aggregated(F.min("attr")).first()[0] or 0.0) < 0:
        raise ValueError("weights must not be negative")
    reached = Deltas("id", "dist", F.min)
    news = materialise(ids.where(F.col("id") == source).select("id", F.lit(0.0).alias("dist")))
    while not news.isEmpty():
        reached.add(news)
        known = reached.state().withColumnRenamed("dist", "known")
        offers = path_offers(stored, news).join(known, "id", "left")
        news = materialise(offers.where(F.col("known").isNull() | (F.col("dist") < F.col("known"))).select("id", "dist"))
    stored.release()
    if not reached.parts:
        return ids.select("id", F.lit(float("inf")).alias("dist"))
    found = materialise(ids.join(reached.state(), "id", "left").select("id", F.coalesce("dist", F.lit(float("inf"))).alias("dist")))
    reached.release()
    return found


RESET = 0.15


def _rank_links(edges: DataFrame) -> DataFrame:
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    return skew_join(edges.select("src", "dst"), out, "src", counts=out).select("src", "dst", (F.lit(1.0) / F.col("n")).alias("share"))


def rank_messages(links: KeyedRows, changes: DataFrame) -> DataFrame:
    """(id, rank): what the ``changes`` (id, rank) of the last round change in this one."""
    sent = links.joined(changes, "id").select(F.col("dst").alias("id"), (F.col("rank") * F.col("share")).alias("part"))
    return sent.groupBy("id").agg((F.lit(1.0 - RESET) * F.sum("part")).alias("rank"))


def _ranked(edges: DataFrame, rounds: int | None, tolerance: float | None) -> DataFrame:
    """Ranks start from 1. A round is linear in the ranks, so its change follows from the change before, and a
    vertex whose rank did not change sends nothing. Links lie in buckets of their source and stay there."""
    plain = materialise(_rank_links(edges))
    ids = materialise(endpoints(plain))
    links = KeyedRows(plain, "src")
    remove(plain.sparkSession, plain.stored_at)
    ranks = Deltas("id", "rank", F.sum)
    ranks.add(materialise(ids.select("id", F.lit(1.0).alias("rank"))))
    done = 0
    while rounds is None or done < rounds:
        if done == 0:  # all ranks change from 1 to the reset and what is received
            received = rank_messages(links, ranks.parts[0]).withColumnRenamed("rank", "received")
            change = ids.join(received, "id", "left").select("id", (F.coalesce("received", F.lit(0.0)) + F.lit(RESET - 1.0)).alias("rank"))
        else:
            change = rank_messages(links, change)
        change = materialise(change.where("rank <> 0"))
        done += 1
        most = change.agg(F.max(F.abs("rank"))).first()[0]
        ranks.add(change)
        if most is None or tolerance is not None and most <= tolerance:
            break
    links.release()
    found = materialise(ranks.state())
    ranks.release()
    remove(ids.sparkSession, ids.stored_at)
    return found


def page_rank_fixed(edges: DataFrame, rounds: int) -> DataFrame:
    """Un-normalised ranks after a fixed number of rounds, starting from 1."""
    return _ranked(edges, rounds, None)


def page_rank(edges: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Un-normalised ranks once no rank moves by more than ``tolerance`` in a round.

    A round shrinks the total movement by the factor 0.85, so the loop ends.
    """
    return _ranked(edges, None, tolerance)


def canonical(edges: DataFrame) -> DataFrame:
    """Distinct undirected edges without loops, from the smaller to the larger id."""
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


def wedges(directed: KeyedRows) -> DataFrame:
    """(a, b, c): two edges a -> b and a -> c of ``directed`` (a, b, db), b before c in the order of degrees."""
    other = directed.cold.select("a", F.col("b").alias("c"), F.col("db").alias("dc"))
    return directed.cold.join(other, "a").where(F.struct("db", "b") < F.struct("dc", "c")).select("a", "b", "c")


def out_lists(directed: KeyedRows) -> DataFrame:
    """(a, bs): the ends of the edges of ``directed`` (a, b, db) from a, in the order of degrees."""
    ends = F.sort_array(F.collect_list(F.struct("db", "b")))  # at most sqrt(2 * edges)
    return directed.cold.groupBy("a").agg(F.transform(ends, lambda x: x["b"]).alias("bs"))


def wedge_lists(lists: DataFrame) -> DataFrame:
    """(a, b, cs): the wedges a -> b, a -> c of ``lists`` (a, bs), a row for each edge that is the first of some."""
    first = lists.select("a", "bs", F.posexplode("bs").alias("i", "b")).where(F.col("i") + 1 < F.size("bs"))
    return first.select("a", "b", F.slice("bs", F.col("i") + 2, F.size("bs")).alias("cs"))


def triangles(edges: DataFrame) -> DataFrame:
    """Each triangle once, as (a, b, c).

    Edges point from the end with fewer neighbours to the other, so no vertex has more than sqrt(2 * edges)
    outgoing ones. Two of them are a wedge, and those whose ends are joined by an edge stay. Edges lie in buckets of
    their first end, so wedges are made where they lie; the other ends of an edge's wedges move as one list to the
    edges from its second end, which stay where they are.
    """
    flat = materialise(canonical(edges))  # degrees and both joins read it
    degree = degrees(flat).select("id", "degree")
    of_src = degree.select(F.col("id").alias("src"), F.col("degree").alias("ds"))
    of_dst = degree.select(F.col("id").alias("dst"), F.col("degree").alias("dd"))
    ranked = skew_join(flat, of_src, "src", counts=of_src.withColumnRenamed("ds", "n"))
    ranked = skew_join(ranked, of_dst, "dst", counts=of_dst.withColumnRenamed("dd", "n"))
    forward = F.struct("ds", "src") < F.struct("dd", "dst")
    directed = KeyedRows(
        ranked.select(
            F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("a"),
            F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("b"),
            F.when(forward, F.col("dd")).otherwise(F.col("ds")).alias("db"),
        ),
        "a",
        hot_share=float("inf"),  # no vertex is hot in this direction
    )
    lists = out_lists(directed)
    closed = wedge_lists(lists).join(lists.select(F.col("a").alias("b"), F.col("bs").alias("ends")), "b")
    found = materialise(closed.select("a", "b", F.explode(F.array_intersect("cs", "ends")).alias("c")))
    directed.release()
    remove(flat.sparkSession, flat.stored_at)
    return found


def triangle_count(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, triangles) for every vertex."""
    per_vertex = (
        triangles(edges)
        .select(F.explode(F.array("a", "b", "c")).alias("id"))
        .groupBy("id")
        .agg(F.count("*").alias("triangles"))
    )
    return outer_join_vertices(vertices.select("id"), per_vertex, {"triangles": 0})
