"""Joins and collections that no hot key can put into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import hash_fraction

ROWS_PER_TASK = 1_000_000
NULL_PARTS = 997


def skew_join(
    facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join in which the rows of a hot key in ``facts`` spread over several tasks.

    Adaptive execution splits a skewed join only between two plain shuffles. Use this where
    ``dim`` comes out of an aggregation or join on the same key. ``counts`` (key, n) gives the
    rows per key if it is known already. Every key above ``rows_per_task`` is spread, however many
    there are: the number of its parts comes by a join, which Spark broadcasts only if its real size
    allows. Rows without a key are spread as well, since they match nothing. Equal rows are dealt
    by their place, so that copies spread too. ``how`` is inner, left, left_semi or left_anti, and the
    result is that of the plain join.
    """
    if counts is None:
        counts = facts.groupBy(key).agg(F.count("*").alias("n"))
    hot = counts.where((F.col("n") > rows_per_task) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_parts")
    )
    placed = facts.withColumn("_place", F.monotonically_increasing_id())
    parts = F.when(F.col(key).isNull(), NULL_PARTS).otherwise(F.coalesce(F.col("_parts"), F.lit(1)))
    spread = (
        placed.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64("_place"), parts).cast("int"))
        .select(*facts.columns, "_salt")
    )
    copied = (
        dim.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return spread.join(copied, [key, "_salt"], how).drop("_salt")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group. Spark cuts every group to ``n`` rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the stated order."""
    return top_per_group(df, keys, order, 1, "_rn").drop("_rn")


def collected_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each key as a sorted set, and all values as sorted (value, n) pairs.

    For values from a limited domain, such as codes. Rows are counted per (key, value) first, so
    what is gathered per key is bounded by that domain, not by the number of rows. Use
    ``chunked_lists`` for values without such a bound.
    """
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(
        F.sort_array(F.collect_set(value)).alias("values"),
        F.sort_array(F.collect_list(F.struct(value, "n"))).alias("value_counts"),
    )


def chunked_lists(df: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """All values of each key, as sorted lists of about ``size`` values: (key, chunk, values).

    A key with many rows spreads over as many chunks as it needs, so no task gathers a whole
    group. Equal values are counted first and their copies dealt apart. ``value`` is an integer
    column; the chunk follows a hash of the value and the copy's number.
    """
    counted = df.groupBy(key, value).agg(F.count("*").alias("_copies"))
    per_key = counted.groupBy(key).agg(
        F.count("*").alias("n"),
        F.ceil(F.sum("_copies") / F.lit(size)).cast("long").alias("_chunks"),
    )
    placed = skew_join(counted, per_key.drop("n"), key, counts=per_key.select(key, "n"))
    copies = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    chunk = F.floor(hash_fraction(F.col(value) + F.col("_copy") * 7919) * F.col("_chunks")).cast("long")
    return copies.groupBy(key, chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(value)).alias("values")
    )
