"""Statistics kept as partial states that merge exactly, however the rows fall into batches.

A state holds sums in decimals, which do not depend on the order of addition, so that the merged state of any
split is the state of the whole, bit for bit. Means, deviations and squared distances are made from it last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.sinks import BatchTable

#: Digits after the point that a value keeps, and those of its square.
DIGITS = 6
STATE = ["n", "missing", "total", "squares", "low", "high"]


def state_schema(keys: str) -> str:
    return f"{keys}, n bigint, missing bigint, total decimal(38,{DIGITS}), squares decimal(38,{2 * DIGITS}), low double, high double"


def _present(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def partial_states(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys…, n, missing, total, squares, low, high); null and NaN are missing."""
    rows = df.select(*keys, _present(value).alias("_v"))
    exact = F.col("_v").cast(f"decimal(18,{DIGITS})")
    return rows.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.count_if(F.col("_v").isNull()).alias("missing"),
        F.coalesce(F.sum(exact), F.lit(0)).cast(f"decimal(38,{DIGITS})").alias("total"),
        F.coalesce(F.sum(exact * exact), F.lit(0)).cast(f"decimal(38,{2 * DIGITS})").alias("squares"),
        F.min("_v").alias("low"),
        F.max("_v").alias("high"),
    )


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key out of several; merging is associative and commutative."""
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.sum("total").cast(f"decimal(38,{DIGITS})").alias("total"),
        F.sum("squares").cast(f"decimal(38,{2 * DIGITS})").alias("squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def finished(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys…, n, missing, mean, m2, stdev, min, max); without a value all but the counts are null."""
    n = F.nullif("n", F.lit(0)).cast("double")
    total, squares = F.col("total").cast("double"), F.col("squares").cast("double")
    m2 = F.greatest(squares - total * total / n, F.lit(0.0))
    return states.select(
        *keys, "n", "missing", (total / n).alias("mean"), F.when(n.isNotNull(), m2).alias("m2"),
        F.when(n.isNotNull(), F.sqrt(m2 / n)).alias("stdev"), F.col("low").alias("min"), F.col("high").alias("max"),
    )


class StoredStates:
    """States per key added batch by batch; a batch that runs again replaces itself."""

    def __init__(self, spark, path: str, keys: str):
        self.names = [k.split()[0] for k in keys.split(",")]
        self.table = BatchTable(spark, path, state_schema(keys), self.names)

    def add(self, df: DataFrame, value: Column, batch_id: int) -> None:
        self.table.write(partial_states(df, self.names, value), batch_id)

    def state(self) -> DataFrame:
        return merged(self.table.rows(), self.names)

    def fold(self, upto: int, at_least: int = 2) -> None:
        self.table.compact(upto, at_least=at_least, state=lambda rows: merged(rows, self.names))

    def statistics(self) -> DataFrame:
        return finished(self.state(), self.names)
