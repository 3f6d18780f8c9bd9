"""Graph queries over parts linked by orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from .registry import query

EDGES = """
edges AS (
  SELECT l_partkey AS src, l_orderkey % (SELECT max(p_partkey) + 1 FROM part) AS dst, count(*) AS attr
  FROM lineitem GROUP BY ALL),
vertices AS (SELECT p_partkey AS id, p_name AS name, p_size AS age FROM part)
"""
DEGREES = """
degrees AS (
  SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree, count(*) AS degree
  FROM (SELECT src AS id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY id)
"""
FULL = """
full_degrees AS (
  SELECT id, name, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree,
         coalesce(degree, 0) AS degree
  FROM vertices LEFT JOIN degrees USING (id))
"""


@query(
    "graph_vertices",
    f"""
WITH {EDGES}, part_of AS (SELECT * FROM vertices WHERE id % 10 <> 3)
SELECT * FROM part_of UNION ALL
SELECT id, 'unknown', -1 FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
WHERE id NOT IN (SELECT id FROM part_of)
""",
)
def graph_vertices(t):
    """Endpoints without a vertex row (here those ending in 3) get default attributes."""
    some = t.vertices.where(F.col("id") % 10 != 3)
    return G.with_defaults(some, t.edges, {"name": "unknown", "age": -1})


@query("vertex_filter", f"WITH {EDGES} SELECT id, name, age FROM vertices WHERE age > 30")
def vertex_filter(t):
    return t.vertices.where(F.col("age") > 30)


@query("edges_desc", f"WITH {EDGES} SELECT src, dst, attr FROM edges WHERE src > dst")
def edges_desc(t):
    return t.edges.where(F.col("src") > F.col("dst"))


@query(
    "triplets",
    f"""
WITH {EDGES}
SELECT src, dst, attr, s.name AS src_name, s.age AS src_age, d.name AS dst_name, d.age AS dst_age
FROM edges JOIN vertices s ON s.id = src JOIN vertices d ON d.id = dst
""",
)
def triplets(t):
    return G.triplets(t.vertices, t.edges)


@query("degrees", f"WITH {EDGES}, {DEGREES} SELECT * FROM degrees")
def degrees(t):
    return G.degrees(t.edges)


@query("degrees_full", f"WITH {EDGES}, {DEGREES}, {FULL} SELECT * FROM full_degrees")
def degrees_full(t):
    return G.degrees_full(t.vertices.select("id", "name"), t.edges)


@query(
    "max_degree",
    f"""
WITH {EDGES}, {DEGREES}
(SELECT 'in' AS kind, id, in_degree AS degree FROM degrees ORDER BY in_degree DESC, id LIMIT 1) UNION ALL
(SELECT 'out', id, out_degree FROM degrees ORDER BY out_degree DESC, id LIMIT 1) UNION ALL
(SELECT 'total', id, degree FROM degrees ORDER BY degree DESC, id LIMIT 1)
""",
)
def max_degree(t):
    return G.max_degree(t.edges)


@query("map_vertices", f"WITH {EDGES} SELECT id, name, age + 10 AS age FROM vertices")
def map_vertices(t):
    return t.vertices.withColumn("age", F.col("age") + 10)


@query("map_edges", f"WITH {EDGES} SELECT src, dst, attr * 2 AS attr FROM edges")
def map_edges(t):
    return t.edges.withColumn("attr", F.col("attr") * 2)


@query(
    "subgraph",
    f"""
WITH {EDGES}, kept AS (SELECT id FROM vertices WHERE age >= 30)
SELECT src, dst, attr FROM edges
WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept) AND src < dst
""",
)
def subgraph(t):
    return G.subgraph(t.vertices, t.edges, F.col("age") >= 30, F.col("src") < F.col("dst"))[1]


@query(
    "join_vertices",
    f"""
WITH {EDGES}
SELECT id, name, CAST(coalesce(n, age) AS BIGINT) AS age
FROM vertices LEFT JOIN (SELECT src AS id, count(*) AS n FROM edges GROUP BY src) USING (id)
""",
)
def join_vertices(t):
    return G.join_vertices(t.vertices, G.out_degrees(t.edges), "age", "out_degree")


@query(
    "balanced_vertices",
    f"WITH {EDGES}, {DEGREES}, {FULL} SELECT id, name, degree FROM full_degrees WHERE in_degree = out_degree",
)
def balanced_vertices(t):
    full = G.degrees_full(t.vertices.select("id", "name"), t.edges)
    return full.where(F.col("in_degree") == F.col("out_degree")).select("id", "name", "degree")


def _follower(order: str) -> str:
    return f"""
followers AS (
  SELECT dst AS id, src AS follower_id, name AS follower_name, age AS follower_age,
         row_number() OVER (PARTITION BY dst ORDER BY age {order}, src) AS rn
  FROM edges JOIN vertices ON id = src)
"""


@query(
    "oldest_follower",
    f"WITH {EDGES}, {_follower('DESC')} SELECT id, follower_id, follower_name, follower_age FROM followers WHERE rn = 1",
)
def oldest_follower(t):
    return G.extreme_follower(t.vertices, t.edges, oldest=True)


@query(
    "youngest_follower",
    f"WITH {EDGES}, {_follower('ASC')} SELECT id, follower_id, follower_name, follower_age FROM followers WHERE rn = 1",
)
def youngest_follower(t):
    return G.extreme_follower(t.vertices, t.edges, oldest=False)


@query(
    "avg_follower_age",
    f"WITH {EDGES} SELECT dst AS id, round(avg(age), 6) AS mean_age FROM edges JOIN vertices ON id = src GROUP BY dst",
)
def avg_follower_age(t):
    return G.mean_follower_age(t.vertices, t.edges).withColumn("mean_age", F.round("mean_age", 6))


def _report_sql(word: str, order: str) -> str:
    return f"""
WITH {EDGES}, {_follower(order)}
SELECT v.id, CASE WHEN follower_id IS NULL THEN 'Nobody follows ' || name || '.'
  ELSE 'The {word} who follows ' || name || ' is ' || follower_name || '.' END AS report
FROM vertices v LEFT JOIN (SELECT * FROM followers WHERE rn = 1) f ON v.id = f.id
"""


@query("follower_report", _report_sql("oldest", "DESC"))
def follower_report(t):
    return G.follower_report(t.vertices, t.edges)


@query("follower_report_youngest", _report_sql("youngest", "ASC"))
def follower_report_youngest(t):
    return G.follower_report(t.vertices, t.edges, oldest=False)


@query(
    "follower_report_mean",
    f"""
WITH {EDGES}, means AS (SELECT dst AS id, avg(age) AS mean_age FROM edges JOIN vertices ON id = src GROUP BY dst)
SELECT v.id, CASE WHEN mean_age IS NULL THEN name || ' is followed by nobody.'
  ELSE 'Followers of ' || name || ' are ' || printf('%.2f', mean_age) || ' years old on average.' END AS report
FROM vertices v LEFT JOIN means m ON v.id = m.id
""",
)
def follower_report_mean(t):
    return G.mean_age_report(t.vertices, t.edges)


@query(
    "graph_counts",
    f"""
WITH {EDGES}
SELECT 'vertices' AS what, count(*) AS n FROM vertices UNION ALL SELECT 'edges', count(*) FROM edges
""",
)
def graph_counts(t):
    return G.counts(t.vertices, t.edges)


def _paths_sql(rounds: int) -> str:
    """Distances by repeated relaxation; more rounds than the graph needs change nothing."""
    ctes = ["d0 AS (SELECT id, CASE WHEN id = 0 THEN 0e0 ELSE CAST('inf' AS DOUBLE) END AS dist FROM vertices)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""d{i} AS MATERIALIZED (SELECT id, min(dist) AS dist FROM (
  SELECT id, dist FROM d{i - 1} UNION ALL
  SELECT dst, dist + attr FROM d{i - 1} JOIN edges ON src = id WHERE isfinite(dist)) GROUP BY id)"""
        )
    return f"WITH {EDGES.replace('edges AS (', 'edges AS MATERIALIZED (')}, {', '.join(ctes)} SELECT id, dist FROM d{rounds}"


@query("sssp", _paths_sql(16))
def sssp(t):
    return G.shortest_paths(t.vertices, t.edges, 0)


def _rank_sql(rounds: int) -> str:
    ctes = [
        "links AS MATERIALIZED (SELECT src, dst, 1e0 / count(*) OVER (PARTITION BY src) AS share FROM edges)",
        "r0 AS (SELECT id, 1e0 AS rank FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges))",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""r{i} AS MATERIALIZED (SELECT id, 0.15e0 + 0.85e0 * sum(part) AS rank FROM (
  SELECT dst AS id, rank * share AS part FROM links JOIN r{i - 1} ON id = src
  UNION ALL SELECT id, 0e0 FROM r{i - 1}) GROUP BY id)"""
        )
    return f"WITH {EDGES}, {', '.join(ctes)} SELECT id, round(rank, 6) AS rank FROM r{rounds}"


@query("pagerank_fixed", _rank_sql(5))
def pagerank_fixed(t):
    return G.page_rank_fixed(t.edges, 5).withColumn("rank", F.round("rank", 6))


def _settled_sql(rounds: int, tolerance: float) -> str:
    """Rounds that go on until the ranks have settled; further ones keep them."""
    ctes = [
        "links AS MATERIALIZED (SELECT src, dst, 1e0 / count(*) OVER (PARTITION BY src) AS share FROM edges)",
        "r0 AS MATERIALIZED (SELECT id, 1e0 AS rank FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges))",
        "s0 AS MATERIALIZED (SELECT false AS settled)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""r{i} AS MATERIALIZED (SELECT id, 0.15e0 + 0.85e0 * sum(part) AS rank FROM (
  SELECT dst AS id, rank * share AS part FROM links JOIN r{i - 1} ON id = src UNION ALL SELECT id, 0e0 FROM r{i - 1})
  WHERE NOT (SELECT settled FROM s{i - 1}) GROUP BY id
  UNION ALL SELECT id, rank FROM r{i - 1} WHERE (SELECT settled FROM s{i - 1})),
s{i} AS MATERIALIZED (SELECT max(abs(x.rank - y.rank)) <= {tolerance} AS settled FROM r{i} x JOIN r{i - 1} y USING (id))"""
        )
    return f"WITH {EDGES}, {', '.join(ctes)} SELECT id, round(rank, 6) AS rank FROM r{rounds}"


@query("pagerank_tolerance", _settled_sql(30, 0.01))
def pagerank_tolerance(t):
    return G.page_rank(t.edges, 0.01).withColumn("rank", F.round("rank", 6))


@query(
    "triangle_count",
    f"""
WITH {EDGES}, flat AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
tri AS (
  SELECT x.a AS a, x.b AS b, y.b AS c FROM flat x JOIN flat y ON x.b = y.a JOIN flat z ON z.a = x.a AND z.b = y.b),
hits AS (SELECT a AS id FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri)
SELECT v.id, count(h.id) AS triangles FROM vertices v LEFT JOIN hits h ON h.id = v.id GROUP BY v.id
""",
)
def triangle_count(t):
    return G.triangle_count(t.vertices, t.edges)
