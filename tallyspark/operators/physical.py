"""Control over how rows are placed and kept: partitions, levels of partial sums, storage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_per_partition(df: DataFrame) -> DataFrame:
    """(partition, rows) of the partitions that have rows."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def placed(df: DataFrame, partitions: int, place: Column) -> DataFrame:
    """``df`` with each row in the partition that ``place`` names, not where a hash would put it."""
    return df.repartitionById(partitions, F.pmod(place.cast("int"), F.lit(partitions)))


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` at a storage level for several uses; what is read from it has to be stored before the end."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist(blocking=True)


def fan_in(partitions: int, depth: int) -> int:
    """Partial sums combined at each level, so that ``depth`` levels bring ``partitions`` of them to one."""
    if depth < 1:
        raise ValueError("a tree has one level at least")
    width = 2
    while width**depth < partitions:
        width += 1
    return width


def tree_levels(partitions: int, depth: int) -> list[int]:
    """Number of tasks at each level after the first, the last of which is 1."""
    width, out = fan_in(partitions, depth), []
    while not out or out[-1] > 1:
        partitions = -(-partitions // width)
        out.append(partitions)
    return out


def tree_sum(df: DataFrame, value: Column, depth: int = 2, partitions: int | None = None) -> DataFrame:
    """(total, n): the sum and the number of values, over levels of partial sums.

    The rows of a partition give one partial sum; each level combines a few of them per task, in as many tasks as
    ``tree_levels`` says, so that no task reads all partial sums unless ``depth`` is 1. Integers and decimals are
    summed exactly, whatever the levels.
    """
    slots = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = (
        df.select(value.alias("value"), F.pmod(F.spark_partition_id(), F.lit(slots)).alias("slot"))
        .groupBy("slot").agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    )
    levels = tree_levels(slots, depth)
    for tasks in levels:
        moved = sums.withColumn("slot", F.pmod("slot", F.lit(tasks)))
        sums = moved.repartitionById(tasks, F.col("slot")).groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return sums.select("total", "n")
