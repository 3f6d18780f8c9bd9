"""Array functions, splits and batch scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import mlprep as M
from .registry import query

CLASSES, SIZE = 10, 64
HASH = "{key} % 2147483647 * 2654435761 % 4294967296 / 4294967296e0"
CELLS = """
cells AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS i FROM embeddings)
"""
WEIGHT = "((c * 7 + i * 3) % 11 - 5) / 10e0"


@query(
    "embedding_topk_dims",
    f"""
WITH {CELLS}, ranked AS (
  SELECT vec_id, CAST(i AS INTEGER) AS pos, round(v, 6) AS value,
         CAST(row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS INTEGER) AS rank FROM cells)
SELECT * FROM ranked WHERE rank <= 5
""",
)
def embedding_topk_dims(t):
    best = t.embeddings.select("vec_id", F.posexplode(A.top_k(F.col("embedding"), 5)).alias("r", "p"))
    return best.select(
        "vec_id", F.col("p.pos").alias("pos"), F.round(F.col("p.value").cast("double"), 6).alias("value"),
        (F.col("r") + 1).alias("rank"),
    )


@query(
    "array_ops",
    f"""
WITH {CELLS}
SELECT vec_id, round(sum(v) FILTER (i < 9), 5) AS head_sum, round(max(v) FILTER (i = 2), 5) AS third,
       round(sum(v * v), 5) AS squared
FROM cells GROUP BY vec_id
""",
)
def array_ops(t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.round(A.total(F.slice(e, 1, 9)), 5).alias("head_sum"),
        F.round(F.element_at(e, 3).cast("double"), 5).alias("third"),
        F.round(A.dot(e, e), 5).alias("squared"),
    )


@query(
    "array_rescale",
    f"""
WITH {CELLS}
SELECT vec_id, round(sum(v / 255 - 0.5e0), 5) AS total, round(max(v / 255 - 0.5e0) FILTER (i = 0), 6) AS first
FROM cells GROUP BY vec_id
""",
)
def array_rescale(t):
    scaled = t.embeddings.select("vec_id", A.rescale(F.col("embedding")).alias("e"))
    return scaled.select(
        "vec_id", F.round(A.total(F.col("e")), 5).alias("total"), F.round(F.col("e")[0], 6).alias("first")
    )


@query(
    "one_hot",
    f"""
SELECT vec_id, string_agg(CASE WHEN c = label THEN '1' ELSE '0' END, ',' ORDER BY c) AS hot
FROM embeddings, range({CLASSES}) AS r(c) GROUP BY vec_id
""",
)
def one_hot(t):
    hot = F.transform(A.one_hot(F.col("label"), CLASSES), lambda x: x.cast("string"))
    return t.embeddings.select("vec_id", F.array_join(hot, ",").alias("hot"))


@query(
    "softmax",
    f"""
WITH {CELLS}, e AS (SELECT vec_id, i, exp(v - max(v) OVER (PARTITION BY vec_id)) AS e FROM cells),
p AS (SELECT vec_id, i, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM e)
SELECT vec_id, round(max(p), 6) AS p_max, round(min(p), 6) AS p_min, round(sum(p), 6) AS p_sum FROM p GROUP BY vec_id
""",
)
def softmax(t):
    p = t.embeddings.select("vec_id", A.softmax(F.col("embedding")).alias("p"))
    return p.select(
        "vec_id", F.round(F.array_max("p"), 6).alias("p_max"), F.round(F.array_min("p"), 6).alias("p_min"),
        F.round(A.total(F.col("p")), 6).alias("p_sum"),
    )


@query("train_val_flag")
def train_val_flag(t):
    return M.random_flag(t.embeddings.select("vec_id", "label"))


@query(
    "train_val_hash",
    f"SELECT vec_id, label, {HASH.format(key='vec_id')} < 0.2e0 AS is_val FROM embeddings",
)
def train_val_hash(t):
    return M.hash_split(t.embeddings.select("vec_id", "label"), "vec_id")


@query(
    "kfold_contiguous",
    """
WITH numbered AS (
  SELECT o_custkey AS user_id, o_orderkey AS rec_id, row_number() OVER (ORDER BY o_orderkey) AS rn,
         count(*) OVER () // 5 AS size FROM orders)
SELECT user_id, rec_id, CAST(least((rn - 1) // size + 1, 5) AS INTEGER) AS fold FROM numbered
""",
)
def kfold_contiguous(t):
    return M.contiguous_folds(t.history.select("user_id", "rec_id"), "rec_id")


@query(
    "holdout_per_user",
    """
WITH numbered AS (
  SELECT o_custkey AS user_id, o_orderkey AS rec_id,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT user_id, rec_id, CASE WHEN rn <= 10 THEN 'ra' WHEN rn <= 20 THEN 'rb' ELSE 'train' END AS part FROM numbered
""",
)
def holdout_per_user(t):
    return M.per_user_holdout(
        t.history, "user_id", ["seq_ts", "rec_id"], "rec_id", {"ra": (1, 10), "rb": (11, 20)}
    ).drop("seq_ts")


SCORES = f"""
scores AS (
  SELECT vec_id, c, sum(v * {WEIGHT}) AS score FROM cells, range({CLASSES}) AS r(c) GROUP BY vec_id, c)
"""


@query(
    "batch_score",
    f"""
WITH {CELLS}, {SCORES}
SELECT vec_id, CAST(c AS INTEGER) AS class, round(score, 4) AS score FROM scores
""",
)
def batch_score(t):
    scored = M.batch_score(t.embeddings.select("vec_id", "embedding"), "embedding", M.linear_model(CLASSES, SIZE))
    cells = scored.select("vec_id", F.posexplode("scores").alias("class", "score"))
    return cells.withColumn("score", F.round("score", 4))


@query(
    "batch_score_topk",
    f"""
WITH {CELLS}, {SCORES}, ranked AS (
  SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, c) AS INTEGER) AS rank, CAST(c AS INTEGER) AS label,
         round(score, 4) AS score FROM scores)
SELECT * FROM ranked WHERE rank <= 5
""",
)
def batch_score_topk(t):
    best = M.batch_score_topk(t.embeddings, "vec_id", "embedding", M.linear_model(CLASSES, SIZE), 5)
    return best.select("vec_id", F.posexplode("top").alias("r", "t")).select(
        "vec_id", (F.col("r") + 1).alias("rank"), F.col("t.label").alias("label"),
        F.round("t.score", 4).alias("score"),
    )


@query("embedding_classifier")
def embedding_classifier(t):
    return M.fit_classifier(t.embeddings, "embedding", "label")
