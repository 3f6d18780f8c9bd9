"""Graph operators on the two small graphs and on a brute-force check."""

import itertools
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyspark.operators import graph as G
from tallyspark.operators.bucketed import KeyedRows


@pytest.fixture(scope="module")
def social(spark):
    v = spark.createDataFrame(
        [(1, "Alice", 28), (2, "Bob", 27), (3, "Charlie", 65), (4, "David", 42), (5, "Ed", 55), (6, "Fran", 50)],
        "id long, name string, age int",
    )
    e = spark.createDataFrame(
        [(2, 1, 7), (2, 4, 2), (3, 2, 4), (3, 6, 3), (4, 1, 1), (5, 2, 2), (5, 3, 8), (5, 6, 3)],
        "src long, dst long, attr int",
    )
    return v, e


def test_degrees(social):
    v, e = social
    assert rows(G.in_degrees(e)) == [(1, 2), (2, 2), (3, 1), (4, 1), (6, 2)]
    assert rows(G.out_degrees(e)) == [(2, 2), (3, 2), (4, 1), (5, 3)]
    full = G.degrees_full(v, e)
    assert sorted(r.name for r in full.where("in_degree = out_degree").collect()) == ["Bob", "David"]
    assert rows(G.max_degree(e)) == [("in", 1, 2), ("out", 5, 3), ("total", 2, 4)]


def test_edge_filter_and_triplets(social):
    v, e = social
    assert rows(e.where("attr > 5").select("src", "dst")) == [(2, 1), (5, 3)]
    t = G.triplets(v, e).where("src = 5 AND dst = 3").first()
    assert (t.src_name, t.dst_name, t.attr) == ("Ed", "Charlie", 8)


def test_subgraph(social):
    v, e = social
    kept, inside = G.subgraph(v, e, F.col("age") >= 50)
    assert rows(kept.select("id")) == [(3,), (5,), (6,)]
    assert rows(inside.select("src", "dst")) == [(3, 6), (5, 3), (5, 6)]
    assert G.subgraph(v, e, None, F.col("attr") > 5)[1].count() == 2


def test_followers(social):
    v, e = social
    names = lambda df: {r.id: r.follower_name for r in df.collect()}
    assert names(G.extreme_follower(v, e, True)) == {1: "David", 2: "Charlie", 3: "Ed", 4: "Bob", 6: "Charlie"}
    assert names(G.extreme_follower(v, e, False)) == {1: "Bob", 2: "Ed", 3: "Ed", 4: "Bob", 6: "Ed"}
    assert {r.id: r.mean_age for r in G.mean_follower_age(v, e).collect()} == {1: 34.5, 2: 60.0, 3: 55.0, 4: 27.0, 6: 60.0}
    report = {r.id: r.report for r in G.follower_report(v, e).collect()}
    assert report[5] == "Nobody follows Ed."
    assert report[1] == "The oldest who follows Alice is David."


def test_shortest_paths(social):
    v, e = social
    assert {r.id: r.dist for r in G.shortest_paths(v, e, 5).collect()} == {1: 5, 2: 2, 3: 8, 4: 4, 5: 0, 6: 3}
    far = {r.id: r.dist for r in G.shortest_paths(v, e, 1).collect()}
    assert far[1] == 0 and all(math.isinf(far[i]) for i in (2, 3, 4, 5, 6))


def test_default_vertices(spark):
    v = spark.createDataFrame([(3, "rxin", "student"), (7, "jgonzal", "postdoc")], "id long, name string, role string")
    e = spark.createDataFrame([(3, 7, "collab"), (5, 3, "advisor")], "src long, dst long, attr string")
    full = G.with_defaults(v, e, {"name": "John Doe", "role": "Missing"})
    assert rows(full.where("id = 5")) == [(5, "John Doe", "Missing")]
    assert full.where("role = 'postdoc'").count() == 1 and e.where("src > dst").count() == 1


def test_join_vertices(social):
    v, e = social
    ages = {r.id: r.age for r in G.join_vertices(v, G.in_degrees(e), "age", "in_degree").collect()}
    assert ages == {1: 2, 2: 2, 3: 1, 4: 1, 5: 55, 6: 2}


def _random_graph(spark, n, m, hub):
    rnd = random.Random(5)
    pairs = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)}
    pairs |= {(hub, i) for i in range(0, n, 2)}  # a hub holds a large share of the edges
    pairs = sorted(p for p in pairs if p[0] != p[1])
    e = spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, attr int")
    return pairs, spark.range(n), e


def test_triangles_against_brute_force(spark):
    pairs, v, e = _random_graph(spark, 40, 150, hub=3)
    flat = {frozenset(p) for p in pairs}
    want = dict.fromkeys(range(40), 0)
    for tri in itertools.combinations(range(40), 3):
        if all(frozenset(p) in flat for p in itertools.combinations(tri, 2)):
            for x in tri:
                want[x] += 1
    assert {r.id: r.triangles for r in G.triangle_count(v, e).collect()} == want


def test_ranks(spark):
    pairs, _, e = _random_graph(spark, 30, 90, hub=0)
    ids = {x for p in pairs for x in p}
    out = {i: [b for a, b in pairs if a == i] for i in ids}

    def step(rank):
        new = dict.fromkeys(ids, 0.0)
        for a, targets in out.items():
            for b in targets:
                new[b] += rank[a] / len(targets)
        return {i: 0.15 + 0.85 * s for i, s in new.items()}

    rank = dict.fromkeys(ids, 1.0)
    for _ in range(3):
        rank = step(rank)
    got = {r.id: r["rank"] for r in G.page_rank_fixed(e, 3).collect()}
    assert got == pytest.approx(rank)
    rank, moved = dict.fromkeys(ids, 1.0), 1.0
    while moved > 0.001:
        newer = step(rank)
        moved = max(abs(newer[i] - rank[i]) for i in ids)
        rank = newer
    got = {r.id: r["rank"] for r in G.page_rank(e, 0.001).collect()}
    assert got == pytest.approx(rank)


def _between_scan_and_join(df):
    """Names of the operators between each scan of a bucketed table and the first join above it."""
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.initialPlan()
    found = []

    def walk(node, above):
        name = node.nodeName()
        if name.startswith("Scan") and "Bucketed: true" in node.simpleString(10_000):
            found.append(list(above))
        path = [] if "Join" in name else [*above, name]
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), path)

    walk(plan, [])
    return found


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _hub(spark):
    """A hub that sends half of all edges, and a ring."""
    rows = [(0, i, 1.0) for i in range(1, 200)] + [(i, i % 199 + 1, 2.0) for i in range(1, 200)]
    return spark.createDataFrame(rows, "src long, dst long, attr double")


def test_a_round_moves_no_edges(spark, shuffled_joins):
    stored = KeyedRows(_hub(spark), "src", buckets=3)
    state = spark.range(200).select("id", F.lit(0.0).alias("dist"), F.lit(1.0).alias("rank"))
    for part in (G.path_offers(stored, state.select("id", "dist")), G.rank_messages(_links(spark), state.select("id", "rank"))):
        scans = _between_scan_and_join(part)
        assert len(scans) == 1 and not any("Exchange" in name for name in scans[0])
    assert {r.src for r in stored.hot.select("src").distinct().collect()} == {0}
    assert stored.cold.where("src = 0").count() == 0 and stored.cold.count() + stored.hot.count() == 398
    stored.release()
    assert not spark.catalog.tableExists(stored.name)


def _links(spark):
    return KeyedRows(_hub(spark).select("src", "dst", F.lit(0.5).alias("share")), "src", buckets=3)


def test_wedges_are_made_where_edges_lie(spark, shuffled_joins):
    directed = KeyedRows(spark.createDataFrame([(1, 2, 2), (1, 3, 2), (2, 3, 2)], "a long, b long, db long"), "a", buckets=2, hot_share=float("inf"))
    made = G.wedges(directed)
    scans = _between_scan_and_join(made)
    assert len(scans) == 2 and not any("Exchange" in name for names in scans for name in names)
    assert rows(made) == [(1, 2, 3)] and all(t == "bigint" for _, t in made.dtypes)


def test_loops_at_a_hub(spark):
    edges = _hub(spark)
    vertices = spark.range(201)
    dist = {r.id: r.dist for r in G.shortest_paths(vertices, edges, 0).collect()}
    assert dist == {0: 0.0, 200: math.inf, **{i: 1.0 for i in range(1, 200)}}
    assert {r.id: r.dist for r in G.shortest_paths(vertices, edges, 777).collect()} == {i: math.inf for i in range(201)}
    ranks = {r.id: r.rank for r in G.page_rank_fixed(edges, 12).collect()}  # more rounds than are kept apart
    want = {i: 1.0 for i in range(200)}
    out = {0: 199, **{i: 1 for i in range(1, 200)}}
    pairs = [(r.src, r.dst) for r in edges.collect()]
    for _ in range(12):
        got = dict.fromkeys(want, 0.15)
        for s, d in pairs:
            got[d] += 0.85 * want[s] / out[s]
        want = got
    assert ranks == pytest.approx(want)


def test_triangles_of_a_random_graph(spark):
    rng = random.Random(4)
    pairs = {tuple(rng.sample(range(40), 2)) for _ in range(260)}
    edges = spark.createDataFrame([*pairs, (3, 3)], "src long, dst long")
    flat = {tuple(sorted(p)) for p in pairs}
    want = sorted(t for t in itertools.combinations(range(40), 3) if all(p in flat for p in itertools.combinations(t, 2)))
    assert sorted(tuple(sorted(r)) for r in G.triangles(edges).collect()) == want


def test_wedges_move_as_lists(spark, shuffled_joins):
    """A row per edge is shuffled, and not a row per wedge; the lists that close them stay in their buckets."""
    pairs = [(a, b) for a in range(30) for b in range(a + 1, 30)]
    directed = KeyedRows(spark.createDataFrame([(a, b, b) for a, b in pairs], "a long, b long, db long"), "a", buckets=2, hot_share=float("inf"))
    lists = G.out_lists(directed)
    assert "Exchange" not in lists._jdf.queryExecution().executedPlan().toString()
    made = G.wedge_lists(lists)
    assert made.count() == len(pairs) - 29  # the last edge of each vertex is the first of no wedge
    assert rows(made.select("a", "b", F.explode("cs").alias("c"))) == rows(G.wedges(directed))
    closed = made.join(lists.select(F.col("a").alias("b"), "bs"), "b")
    assert closed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
