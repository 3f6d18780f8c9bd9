"""What holds for every outcome of the random operators: no row is lost or met twice, shares are in bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mlprep, people
from ..session import materialise
from .registry import query


def _kept(df: DataFrame, key: str, chosen) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"), F.countDistinct(key).alias("ids"), F.avg(F.when(chosen, 1.0).otherwise(0.0)).alias("share")
    )


def _within(df: DataFrame, low: float, high: float) -> DataFrame:
    return df.select("n", "ids", F.col("share").between(low, high).alias("in_bounds"))


ALL_PEOPLE = "SELECT count(*) AS n, count(DISTINCT {key}) AS ids, true AS in_bounds FROM {table}"


@query("random_split_whole", ALL_PEOPLE.format(key="l_orderkey * 10 + l_linenumber", table="lineitem"))
def random_split_whole(t):
    lines = t.read("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return _within(_kept(people.random_parts(lines, [10.0, 20.0], 11), "id", F.col("part") == 0), 0.30, 0.37)


@query("sample_half_within", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids, 0 AS strays, 0 AS repeated, true AS in_bounds FROM orders")
def sample_half_within(t):
    """The sample's rows are rows of the table, none more often than there, about half of them."""
    orders = t.read("orders").select("o_orderkey").groupBy("o_orderkey").agg(F.count("*").alias("there"))
    sampled = t.read("orders").select("o_orderkey").sample(False, 0.5, 11).groupBy("o_orderkey").agg(F.count("*").alias("drawn"))
    both = orders.join(sampled, "o_orderkey", "full").select(F.coalesce("there", F.lit(0)).alias("there"), F.coalesce("drawn", F.lit(0)).alias("drawn"))
    return both.agg(
        F.sum("there").alias("n"), F.count_if(F.col("there") > 0).alias("ids"), F.count_if(F.col("there") == 0).cast("int").alias("strays"),
        F.count_if(F.col("drawn") > F.col("there")).cast("int").alias("repeated"),
        (F.sum("drawn") / F.sum("there")).between(0.45, 0.55).alias("in_bounds"),
    )


@query("random_flag_whole", ALL_PEOPLE.format(key="o_orderkey", table="orders"))
def random_flag_whole(t):
    flagged = mlprep.random_flag(t.read("orders").select("o_orderkey"))
    return _within(_kept(flagged, "o_orderkey", F.col("is_val")), 0.17, 0.23)


@query(
    "classifier_quality",
    """
SELECT count(*) AS n, count(DISTINCT vec_id) AS ids,
       count(*) FILTER (vec_id % 2147483647 * 2654435761 % 4294967296 / 4294967296e0 < 0.2) AS held_out, true AS better_than_chance
FROM embeddings
""",
)
def classifier_quality(t):
    """Every row once, the stated validation rows, and more right than the ten classes would give by chance.

    Chance is what as many predictions of each class would get right if they were dealt to the rows blindly, so the
    comparison holds at any number of rows; a fixed share would be met on few rows alone, which the model learns by heart."""
    out = materialise(mlprep.fit_classifier(t.embeddings, "embedding", "label"))
    met = out.groupBy("label", "predicted").agg(F.count("*").cast("double").alias("n"))  # a row per pair of classes
    labels = met.groupBy("label").agg(F.sum("n").alias("of_label"))
    predictions = met.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("of_predicted"))
    by_chance = labels.join(predictions, "label").agg(F.sum(F.col("of_label") * F.col("of_predicted")).alias("by_chance"))
    whole = out.agg(
        F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids"), F.count_if("is_val").alias("held_out"),
        F.count_if(F.col("label") == F.col("predicted")).alias("right"),
    )
    better = F.coalesce(F.col("right") * F.col("n").cast("double") > F.col("by_chance"), F.lit(False))
    return whole.crossJoin(by_chance).select("n", "ids", "held_out", better.alias("better_than_chance"))  # one row each
