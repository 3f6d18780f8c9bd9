"""Large tables that a loop joins again and again by one key, stored so that they need not move.

The rows lie in buckets of the key, sorted in each, so a join by that key shuffles the other side alone. A
key that holds a large share of the rows would make its bucket large: rows of such keys are stored apart, spread
over all tasks, and as there are few of them by definition, what is joined to them is broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, remove, scratch_path

#: A key is hot if it alone has more than this share of a bucket's even load; so there are fewer hot keys than
#: buckets divided by it.
HOT_SHARE = 0.5


class KeyedRows:
    """``df`` stored by ``key``. ``release`` removes it."""

    def __init__(self, df: DataFrame, key: str, buckets: int | None = None, hot_share: float = HOT_SHARE):
        self.spark, self.key = df.sparkSession, key
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        whole = materialise(df)
        counts = whole.groupBy(key).agg(F.count("*").alias("n"))
        self.rows = whole.count()
        limit = max(1.0, self.rows * hot_share / self.buckets)
        hot = F.broadcast(counts.where(F.col("n") > F.lit(limit)).select(key))  # fewer than buckets / hot_share
        self.hot = materialise(whole.join(hot, key, "left_semi"))
        self.name, self.path = f"keyed_{uuid.uuid4().hex}", scratch_path(self.spark, "buckets")
        (
            whole.join(hot, key, "left_anti")
            .repartition(self.buckets, key)  # one file per bucket
            .write.bucketBy(self.buckets, key).sortBy(key).option("path", self.path).saveAsTable(self.name)
        )
        remove(self.spark, whole.stored_at)
        self.cold = self.spark.table(self.name)

    def joined(self, other: DataFrame, on: str) -> DataFrame:
        """Rows with those of ``other`` whose column ``on``, unique in it, is their key."""
        other = other.withColumnRenamed(on, self.key)
        hot_keys = F.broadcast(self.hot.select(self.key).distinct())
        few = other.join(hot_keys, self.key, "left_semi")
        return self.cold.join(other, self.key).unionByName(self.hot.join(F.broadcast(few), self.key))

    def aggregated(self, *aggregates: Column) -> DataFrame:
        return self.cold.unionByName(self.hot).agg(*aggregates)

    def release(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)
        remove(self.spark, self.hot.stored_at)


class Deltas:
    """A keyed state kept as the changes of each round; they are folded once there are ``fold`` of them."""

    def __init__(self, key: str, value: str, merge, fold: int = 8):
        self.key, self.value, self.merge, self.fold = key, value, merge, fold
        self.parts: list[DataFrame] = []

    def add(self, change: DataFrame) -> None:
        self.parts.append(change)
        if len(self.parts) >= self.fold:
            whole = materialise(self.state())
            self.release(keep=change)
            self.parts = [whole]

    def state(self) -> DataFrame:
        rows = self.parts[0]
        for part in self.parts[1:]:
            rows = rows.unionByName(part)
        return rows.groupBy(self.key).agg(self.merge(self.value).alias(self.value))

    def release(self, keep: DataFrame | None = None) -> None:
        """Removes the stored parts, but for one that is still to be read."""
        for part in self.parts:
            if keep is None or part.stored_at != keep.stored_at:
                remove(part.sparkSession, part.stored_at)
