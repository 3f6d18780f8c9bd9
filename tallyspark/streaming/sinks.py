"""Keyed tables fed by micro-batches.

A batch is written to its own folder, which a replay of the same batch overwrites, so a batch
counts once however often it runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import folders_below, make_folder, remove, rename

COMPACT_EVERY = 16


class Commits:
    """Markers of the batches that every table of a job holds in full, each written last of all.

    A job that fails between two tables leaves rows of a batch without a marker. Readers pass over them, and the
    batch, when it runs again, writes them anew.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/_commits"
        make_folder(spark, self.path)

    def mark(self, batch_id: int) -> None:
        make_folder(self.spark, f"{self.path}/batch={batch_id}")

    def last(self) -> int:
        """The last batch with a marker, -1 before the first. Batches are marked one after another."""
        return max((int(n.partition("=")[2]) for n in folders_below(self.spark, self.path, "batch=*")), default=-1)

    def forget(self, before: int) -> None:
        """Removes older markers, which the last one stands for."""
        for name in folders_below(self.spark, self.path, "batch=*"):
            if int(name.partition("=")[2]) < before:
                remove(self.spark, f"{self.path}/{name}")


class BatchTable:
    """Rows of (keys…, values…) collected over batches; ``batch`` numbers them.

    With ``day``, a key column of dates, rows lie by day, and a reader that names its days lists and
    reads those alone. ``compact`` folds the batches of a day into one: the merged rows are written
    aside and moved into place in one step, from when on readers pass over the batches they stand for,
    which are then removed. So a day has at most as many folders as batches since it was last folded.

    With ``commits``, readers see the batches up to the last marker; the job that writes a batch names it as ``upto``.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], day: str | None = None, commits: Commits | None = None
    ):
        self.spark, self.path, self.keys, self.day, self.commits = spark, path, list(keys), day, commits
        self.schema = T.StructType.fromDDL(schema)
        self.values = [f.name for f in self.schema if f.name not in self.keys]
        make_folder(spark, path)  # an empty table can be read before the first batch

    def write(self, df: DataFrame, batch_id: int) -> None:
        out = df.select(*self.schema.names).withColumn("merged", F.lit(0)).withColumn("batch", F.lit(batch_id))
        folders = [*([self.day] if self.day else []), "merged", "batch"]
        if self.day:  # a small day is one file, a large one several
            out = out.hint("rebalance", self.day)
        (
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(self.path)
        )

    def _found(self, days: Sequence[date] | None = None) -> dict[str, tuple[int | None, list[int], list[int]]]:
        """For the folder of each day, or the table's own: the last merged batch, all merged ones, and the single ones."""
        known = folders_below(self.spark, self.path, f"{f'{self.day}=*/' if self.day else ''}merged=*/batch=*")
        wanted = None if days is None or not self.day else {f"{self.day}={d.isoformat()}" for d in days}
        found: dict[str, tuple[list[int], list[int]]] = {}
        for name in known:
            *day, merged, batch = name.split("/")
            if wanted is None or day[0] in wanted:
                kinds = found.setdefault("/".join([self.path, *day]), ([], []))
                kinds[merged == "merged=0"].append(int(batch.partition("=")[2]))
        return {folder: (max(merged, default=None), sorted(merged), sorted(single)) for folder, (merged, single) in sorted(found.items())}

    def rows(self, where: Column | None = None, days: Sequence[date] | None = None, upto: int | None = None) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("merged", T.IntegerType()), T.StructField("batch", T.LongType())])
        found = self._found(days)
        folders = list(found)
        reader = self.spark.read.schema(full)
        df = reader.option("basePath", self.path).parquet(*folders) if folders else reader.parquet(self.path).where("false")
        folded: dict[int | None, list[date]] = {}
        for folder in folders:
            folded.setdefault(found[folder][0], []).append(self._date(folder))
        live = F.lit(not folders)
        for last, own in folded.items():
            fresh = F.col("merged") == 0
            if last is not None:
                fresh = (fresh & (F.col("batch") > last)) | ((F.col("merged") == 1) & (F.col("batch") == last))
            live = live | (fresh & F.col(self.day).isin(own) if self.day else fresh)
        df = df.where(live).select(*self.schema.names, "batch")
        if upto is None and self.commits is not None:
            upto = self.commits.last()
        if upto is not None:
            df = df.where(F.col("batch") <= upto)
        return df if where is None else df.where(where)

    def _date(self, folder: str) -> date | None:
        return date.fromisoformat(folder.rpartition("=")[2]) if self.day else None

    def sums(self, where: Column | None = None, days: Sequence[date] | None = None) -> DataFrame:
        """Current rows when batches hold increments; without values, the distinct keys."""
        rows = self.rows(where, days)
        if not self.values:
            return rows.select(*self.keys).distinct()
        return rows.groupBy(*self.keys).agg(*[F.sum(v).alias(v) for v in self.values])

    def latest(self, where: Column | None = None, days: Sequence[date] | None = None) -> DataFrame:
        """Current rows when batches hold new values for the keys they touch."""
        newest = [F.max_by(v, "batch").alias(v) for v in self.values]
        return self.rows(where, days).groupBy(*self.keys).agg(*newest)

    def compact(self, upto: int, days: Sequence[date] | None = None, increments: bool = True, at_least: int = COMPACT_EVERY, state=None) -> None:
        """Folds the batches up to ``upto``, which must be complete, where a day has ``at_least`` of them.

        ``state`` makes the folded rows of the table's rows; by default they are sums or latest values by key."""
        due = {}
        for folder, (_, merged, single) in self._found(days).items():
            old = [b for b in single if b <= upto]
            if len(old) >= at_least:
                due[folder] = (merged, old)
        if not due:
            return
        chosen = [self._date(f) for f in due] if self.day else None
        until = F.col("batch") <= upto
        if state is not None:
            state = state(self.rows(until, chosen))
        else:
            state = self.sums(until, chosen) if increments else self.latest(until, chosen)
        aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
        state = state.hint("rebalance", self.day) if self.day else state
        state.select(*self.schema.names).write.partitionBy(*([self.day] if self.day else [])).parquet(aside)
        for folder, (merged, old) in due.items():
            rename(self.spark, aside + folder.removeprefix(self.path), f"{folder}/merged=1/batch={old[-1]}")
            for b in old:
                remove(self.spark, f"{folder}/merged=0/batch={b}")
            for b in merged:
                remove(self.spark, f"{folder}/merged=1/batch={b}")
        remove(self.spark, aside)

    def compacted(self, path: str, upto: int, increments: bool = True) -> BatchTable:
        """A new table at ``path`` whose batch ``upto`` holds the state up to that batch."""
        until = F.col("batch") <= upto
        state = self.sums(until) if increments else self.latest(until)
        out = BatchTable(self.spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema), self.keys, self.day)
        out.write(state, upto)
        return out


class KeySet:
    """Distinct keys appended by batches, each batch adding those not yet present."""

    def __init__(self, spark: SparkSession, path: str, schema: str, commits: Commits | None = None):
        self.table = BatchTable(spark, path, schema, T.StructType.fromDDL(schema).names, commits=commits)

    def add(self, df: DataFrame, batch_id: int) -> None:
        known = self.table.rows(F.col("batch") < batch_id, upto=batch_id).select(*self.table.keys)
        new = df.select(*self.table.keys).distinct().join(known, self.table.keys, "left_anti")
        self.table.write(new, batch_id)

    def current(self, where: Column | None = None) -> DataFrame:
        return self.table.rows(where).select(*self.table.keys)

    def compact(self, upto: int, at_least: int = COMPACT_EVERY) -> None:
        self.table.compact(upto, at_least=at_least)


class SliceTable:
    """Rows stored by slice; a batch replaces exactly the slices present in its data.

    Each batch is kept until it is folded, so that readers see a slice as of the last complete batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str, slices: Sequence[str], day: str | None = None, commits: Commits | None = None):
        self.slices = list(slices)
        self.table = BatchTable(spark, path, schema, slices, day, commits)

    def replace(self, df: DataFrame, batch_id: int | None = None) -> None:
        if batch_id is None:  # outside a stream: after all that is there
            last = self.table.rows(upto=2**62).agg(F.max("batch")).first()[0]
            batch_id = 0 if last is None else last + 1
        self.table.write(df, batch_id)

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = rows.groupBy(*self.slices).agg(F.max("batch").alias("batch"))
        return rows.join(newest, [*self.slices, "batch"], "left_semi").select(*self.table.schema.names)

    def current(self) -> DataFrame:
        return self._newest(self.table.rows())

    def compact(self, upto: int, days: Sequence[date] | None = None, at_least: int = COMPACT_EVERY) -> None:
        self.table.compact(upto, days, at_least=at_least, state=self._newest)
