"""Round trips: a stored table is written in a file format and read back by the reader of that format."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions import sql_functions
from ..operators import mlprep, ratings
from ..session import scratch_path
from ..sources import readers, writers
from .registry import query

RATINGS = """
SELECT l_suppkey AS user_id, l_partkey AS movie_id, CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS INTEGER) AS rating,
       epoch_us(l_shipdate) // 1000000 AS seconds FROM lineitem
"""


def _place(t, name: str) -> str:
    return scratch_path(t.spark, name)


def _ratings(t):
    return t.ratings.select("user_id", "movie_id", "rating", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))


@query("format_delimited", RATINGS)
def format_delimited(t):
    """Records separated by ``::``."""
    path = _place(t, "ratings")
    writers.text_dir(_ratings(t), path, sep="::")
    return readers.delimited(t.spark, path, _ratings(t).schema)


@query(
    "format_text_words",
    r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""",
)
def format_text_words(t):
    """Word counts from text files, written by the table's own partitions."""
    path = _place(t, "texts")
    writers.text_dir(t.read("documents").select("text"), path)
    lines = readers.text_lines(t.spark, path, 8)
    return lines.select(F.explode(F.split("value", " ")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


@query("format_json", "SELECT event_id, user_id, event_type, value FROM events")
def format_json(t):
    """JSON lines whose schema is inferred."""
    path = _place(t, "events")
    writers.json_dir(t.read("events").select("event_id", "user_id", "event_type", "value"), path)
    return readers.json_lines(t.spark, path).select("event_id", "user_id", "event_type", "value")


@query(
    "format_parquet",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
)
def format_parquet(t):
    """Parquet in small row groups, one folder per status."""
    path = _place(t, "orders")
    rows = t.read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    writers.parquet_dir(rows, path, partitions=4, row_group_bytes=1 << 20, partition_by=["o_orderstatus"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "format_season_csv",
    """
SELECT CAST(1995 + s_suppkey % 3 AS INTEGER) AS year, s_name AS name, CAST(s_suppkey % 20 + 20 AS INTEGER) AS age,
       CASE WHEN s_suppkey % 4 = 0 THEN 0e0 ELSE CAST(s_nationkey AS DOUBLE) END AS fg, CAST(s_suppkey AS DOUBLE) AS pts
FROM supplier
""",
)
def format_season_csv(t):
    """Season files by year with repeated headers, blank lines, markers and empty cells."""
    names = [*readers.SEASON_KEYS, *readers.SEASON_METRICS]
    given = {
        "Rk": F.col("s_suppkey"), "Player": F.concat("s_name", F.when(F.col("s_suppkey") % 2 == 0, "*").otherwise("")),
        "Pos": F.lit("C"), "Age": F.col("s_suppkey") % 20 + 20, "Tm": F.lit("T"),
        "FG": F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey")), "PTS": F.col("s_suppkey"),
    }
    line = F.concat_ws(",", *[F.coalesce(given.get(n, F.lit("")).cast("string"), F.lit("")) for n in names])
    noisy = F.concat_ws("\n", line, F.when(F.col("s_suppkey") % 5 == 0, F.lit("\n" + ",".join(names))))
    root = _place(t, "seasons")
    rows = t.read("supplier")
    for i in range(3):
        rows.where(F.col("s_suppkey") % 3 == i).select(noisy).write.text(f"{root}/season_{1995 + i}_csv")
    got = readers.season_csv(t.spark, f"{root}/season_*_csv")
    return got.select("year", "name", "age", F.col("FG").alias("fg"), F.col("PTS").alias("pts"))


@query("format_encoded_text", "SELECT n_nationkey, n_name || '-国家' AS name FROM nation")
def format_encoded_text(t):
    """Lines in a charset other than UTF-8."""
    path = _place(t, "gbk")
    t.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    line = F.concat_ws("|", F.col("n_nationkey").cast("string"), F.concat("n_name", F.lit("-国家")))
    t.read("nation").select(line).write.option("encoding", "GBK").csv(path)
    parts = F.split("value", r"\|")
    return readers.encoded_text(t.spark, path).select(parts[0].cast("int").alias("n_nationkey"), parts[1].alias("name"))


@query(
    "format_edge_list",
    """
SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst, CAST(1 AS INTEGER) AS attr FROM lineitem
""",
)
def format_edge_list(t):
    """Pairs of ids with comment lines, read with every edge from the smaller to the larger id."""
    path = _place(t, "edges")
    pairs = t.read("lineitem").select(F.concat_ws("\t", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("value"))
    pairs.unionByName(t.read("region").select(F.concat(F.lit("# "), F.col("r_name")).alias("value"))).write.text(path)
    return readers.edge_list(t.spark, path, canonical=True).distinct()


@query(
    "format_libsvm",
    "SELECT CAST(label AS BIGINT) AS label, count(*) AS n, round(sum(list_sum(embedding::DOUBLE[])), 3) AS total FROM embeddings GROUP BY 1",
)
def format_libsvm(t):
    """Vectors in LibSVM files, read back as float arrays with an integer label."""
    path = _place(t, "vectors")
    vectors = t.embeddings.select(F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    vectors.write.format("libsvm").save(path)
    rows = mlprep.vector_rows(readers.libsvm(t.spark, path, 64))
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(total), 3).alias("total"))


@query("format_training_export", "SELECT vec_id, label, len(embedding) AS size FROM embeddings")
def format_training_export(t):
    """Training rows in random order over several files."""
    path = _place(t, "training")
    mlprep.export_shuffled(t.embeddings, path, 4)
    return readers.parquet(t.spark, path).select("vec_id", "label", F.size("embedding").cast("long").alias("size"))


@query("format_vector_column", "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS head, round(embedding[64]::DOUBLE, 6) AS tail FROM embeddings")
def format_vector_column(t):
    """Arrays as ML vectors and back."""
    back = t.embeddings.select("vec_id", vector_to_array(array_to_vector("embedding"), "float32").alias("v"))
    return back.select("vec_id", F.round(F.col("v")[0].cast("double"), 6).alias("head"), F.round(F.col("v")[63].cast("double"), 6).alias("tail"))


@query(
    "format_catalog_table",
    """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""",
)
def format_catalog_table(t):
    """A stored catalog table joined to a file table."""
    name = scratch_path(t.spark, "nations").rsplit("/", 1)[1].replace("-", "_")
    writers.managed_table(t.read("nation"), name)
    nations = readers.catalog_table(t.spark, name)
    return t.read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"))


@query(
    "sql_function",
    """
SELECT upper(replace(p_brand, ' ', '')) AS brand, CAST(floor(p_retailprice / 100e0) AS BIGINT) AS band, count(*) AS n FROM part GROUP BY ALL
""",
)
def sql_function(t):
    """Registered functions called from SQL text."""
    sql_functions.register(t.spark)
    text = "SELECT compact_name(p_brand) AS brand, price_band(p_retailprice, 100) AS band, count(*) AS n FROM {part} GROUP BY ALL"
    return t.spark.sql(text, part=t.read("part"))


@query(
    "lookup_default",
    """
SELECT l_suppkey AS user_id, l_partkey AS movie_id, s_nationkey AS occupation_id, count(*) AS n
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON l_suppkey = s_suppkey GROUP BY ALL
""",
)
def lookup_default(t):
    """A left lookup: ratings of users without an entry keep NULL."""
    known = t.users.where("gender = 'M'")
    found = ratings.looked_up(t.ratings, known, "occupation_id")
    return found.groupBy("user_id", "movie_id", "occupation_id").agg(F.count("*").alias("n"))
