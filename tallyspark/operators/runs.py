"""Groups read as runs of sorted rows, never gathered.

Rows are dealt by ranges of their keys and order and sorted in each partition, so a group is a run that may go on
over Arrow batches and over partitions. A task carries the last row from batch to batch. What it cannot know is the
row before its first one; those few rows, one per partition, are filled in afterwards from the last rows of the
partitions before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..session import materialise


def secondary_sorted(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in total order of (keys, order), group by group; a large group spreads over partitions."""
    columns = [*keys, *order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)


def _shifted(frame: pd.DataFrame, before: pd.DataFrame | None, keys: list[str], values: list[str]) -> tuple[pd.DataFrame, bool]:
    """Values of the row before of the same group; whether the first row's own lie outside the frame."""
    with_last = frame if before is None else pd.concat([before, frame], ignore_index=True)
    moved = with_last[values].astype(object).shift(1)  # as objects, so that whole numbers stay whole beside nulls
    same = pd.Series(True, index=with_last.index)
    for key in keys:
        own, last = with_last[key], with_last[key].shift(1)
        same &= (own == last) | (own.isna() & last.isna())
    same.iloc[0] = False
    moved[~same] = None
    if before is not None:
        moved = moved.iloc[1:].reset_index(drop=True)
    return moved, before is None


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``previous_*``: ``values`` of the row before in the group's order, null for a group's first row.

    (keys, order) has to be unique for a defined result."""
    keys, values = list(keys), list(values)
    names = df.columns
    given = {f.name: f for f in df.schema.fields}
    made = [StructField(f"previous_{v}", given[v].dataType, True) for v in values]
    schema = StructType([*(StructField(f.name, f.dataType, True) for f in df.schema.fields), *made, StructField("part", IntegerType()), StructField("kind", StringType())])
    numbered = secondary_sorted(df, keys, order, partitions).withColumn("part", F.spark_partition_id())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for frame in frames:
            if not len(frame):
                continue
            moved, first = _shifted(frame, last, keys, values)
            out = frame.copy()
            for v in values:
                out[f"previous_{v}"] = moved[v]
            out["kind"] = "row"
            if first:
                out.loc[out.index[0], "kind"] = "head"
            yield out[schema.names]
            last = frame.iloc[[-1]]
        if last is not None:
            out = last.copy()
            for v in values:
                out[f"previous_{v}"] = None
            out["kind"] = "tail"
            yield out[schema.names]

    stored = materialise(numbered.mapInPandas(run, schema))
    ends = stored.where("kind <> 'row'")  # two rows per partition
    by_part = Window.orderBy("part", F.col("kind"))  # a head before its tail
    held = F.struct(*keys, *values)
    joined = ends.withColumn("before", F.lag(held).over(by_part)).where("kind = 'head'")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"before.{key}"))
    same = same & F.col("before").isNotNull()
    heads = joined.select(*names, *[F.when(same, F.col(f"before.{v}")).alias(f"previous_{v}") for v in values])
    return stored.where("kind = 'row'").select(*names, *[f.name for f in made]).unionByName(heads)


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], change: Callable | None = None) -> DataFrame:
    """``df`` with ``change_*``, the difference of ``values`` from the row before in the group."""
    change = change or (lambda now, before: now - before)
    found = with_previous(df, keys, order, values)
    return found.select(*df.columns, *[change(F.col(v), F.col(f"previous_{v}")).alias(f"change_{v}") for v in values])
