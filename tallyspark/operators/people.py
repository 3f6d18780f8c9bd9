"""People, scores and general relational operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def group_stats(df: DataFrame, key: str, age: str, score: str) -> DataFrame:
    """Sum, mean, maximum, minimum, count, distinct count per key, stamped with today's date."""
    return df.groupBy(key).agg(
        F.sum(age).alias("sum_age"),
        F.avg(age).alias("avg_age"),
        F.max(age).alias("max_age"),
        F.min(age).alias("min_age"),
        F.count(age).alias("n_age"),
        F.countDistinct(age).alias("distinct_ages"),
        F.mean(score).alias("mean_score"),
        F.current_date().alias("as_of"),
    )


def key_labels(df: DataFrame, name: str, age: str) -> DataFrame:
    """Groups by (name, age) with a label made of the grouping columns."""
    return df.groupBy(name, age).agg(
        F.concat(F.col(name), F.col(age).cast("string")).alias("label"),
        F.count("*").alias("n"),
    )


def pairs(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Inner join keeping both rows whole, as the structs ``left`` and ``right``.

    Inputs are aliased ``l`` and ``r`` for the condition.
    """
    joined = left.alias("l").join(right.alias("r"), condition)
    return joined.select(
        F.struct(*[F.col(f"l.{c}") for c in left.columns]).alias("left"),
        F.struct(*[F.col(f"r.{c}") for c in right.columns]).alias("right"),
    )


def left_with_default(left: DataFrame, right: DataFrame, on: str, value: str, default) -> DataFrame:
    return left.join(right, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def qualified(people: DataFrame, scores: DataFrame, minimum: float) -> DataFrame:
    """People with at least one score above ``minimum``: how many such scores and the best."""
    high = (
        scores.where(F.col("score") > minimum)
        .groupBy("user_id")
        .agg(F.count("*").alias("n_scores"), F.max("score").alias("best_score"))
    )
    return people.join(high, "user_id")


def members_only(people: DataFrame, scores: DataFrame, minimum: float) -> DataFrame:
    """The same selection as a membership test against the distinct users."""
    high = scores.where(F.col("score") > minimum).select("user_id").distinct()
    return people.join(high, "user_id", "left_semi")


def floored_sum(df: DataFrame, key: str, value: str, floor: float) -> DataFrame:
    return df.groupBy(key).agg(F.sum(F.greatest(F.col(value), F.lit(floor))).alias("total"))


def aged(df: DataFrame, is_special: Column, age: str, special_years: int = 70, years: int = 30) -> DataFrame:
    """Add ``special_years`` to the age where ``is_special`` holds, ``years`` elsewhere."""
    step = F.when(is_special, F.lit(special_years)).otherwise(F.lit(years))
    return df.withColumn(age, F.col(age) + step)


def shifted(df: DataFrame, column: str, amount: int) -> DataFrame:
    """Add ``amount`` to a column."""
    return df.withColumn(column, F.col(column) + amount)


def in_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema=None) -> DataFrame:
    """A caller's own function on the batches of each partition, for what no expression can do."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema or df.schema)


def tree_sum(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """Sum of a range: partial sums per task, then one row per task is combined."""
    return spark.range(start, end, 1, partitions or spark.sparkContext.defaultParallelism).agg(
        F.sum("id").alias("total")
    )


def random_parts(df: DataFrame, weights: list[float], seed: int) -> DataFrame:
    """Rows labelled with the part they fall into in a weighted random split, in one scan.

    One number is drawn per row, so parts neither overlap nor lose rows.
    """
    total, reached, part = sum(weights), 0.0, F.lit(len(weights) - 1)
    bounds = []
    for w in weights[:-1]:
        reached += w / total
        bounds.append(reached)
    for i in reversed(range(len(bounds))):
        part = F.when(F.col("_draw") < bounds[i], F.lit(i)).otherwise(part)
    return df.withColumn("_draw", F.rand(seed)).withColumn("part", part).drop("_draw")
