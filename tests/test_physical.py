"""Merged states, trees of sums, runs of sorted rows, placement and storage, whole files."""

from __future__ import annotations

import random
import re

import pytest
from conftest import SMALL, rows
from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import moments, physical, runs
from tallyspark.session import scratch_path
from tallyspark.sources import readers


# stored states


def test_any_split_merges_to_the_state_of_the_whole(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    value = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_extendedprice") / 3)
    keys = ["l_returnflag"]
    whole = rows(moments.partial_states(lines, keys, value))
    assert whole == rows(moments.merged(moments.partial_states(lines, keys, value), keys))
    for seed, parts in ((1, 2), (2, 5), (3, 40)):
        split = lines.withColumn("part", F.floor(F.rand(seed) * parts))
        per_part = moments.partial_states(split, ["part", *keys], value)
        assert rows(moments.merged(per_part, keys)) == whole
        halves = moments.merged(per_part.withColumn("half", F.col("part") % 2), ["half", *keys])  # merged twice
        assert rows(moments.merged(halves, keys)) == whole


def test_statistics_of_states(spark):
    nan = float("nan")
    data = [("a", 100.1), ("a", 200.0), ("a", 300.0), ("b", 400.0), ("b", None), ("b", nan), ("b", 500.0), ("c", nan)]
    frame = spark.createDataFrame(data, "k string, v double")
    stored = moments.StoredStates(spark, scratch_path(spark, "m"), "k string")
    stored.add(frame.where("k = 'a'"), F.col("v"), 0)
    stored.add(frame.where("k <> 'a'"), F.col("v"), 1)
    stored.add(frame.where("k <> 'a'"), F.col("v"), 1)  # runs again
    before = rows(stored.statistics())
    stored.fold(1)
    got = {r.k: r for r in stored.statistics().collect()}
    assert rows(stored.statistics()) == before
    assert (got["a"].n, got["a"].missing, got["a"].min, got["a"].max) == (3, 0, 100.1, 300.0)
    assert got["a"].m2 == pytest.approx(sum((x - 600.1 / 3) ** 2 for x in (100.1, 200.0, 300.0)))
    assert (got["b"].n, got["b"].missing, got["b"].mean, got["b"].stdev) == (2, 2, 450.0, 50.0)
    assert (got["c"].n, got["c"].missing, got["c"].mean, got["c"].m2, got["c"].min) == (0, 1, None, None, None)


# trees


def test_tree_levels():
    assert physical.tree_levels(27, 3) == [9, 3, 1] and physical.tree_levels(27, 1) == [1]
    assert physical.tree_levels(1000, 2) == [32, 1] and physical.tree_levels(1, 4) == [1]
    with pytest.raises(ValueError):
        physical.tree_levels(8, 0)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_tree_sum_over_levels(spark, depth):
    frame = spark.range(-1000, 1000, 1, 20).withColumn("x", F.when(F.col("id") % 2 == 0, F.col("id")))
    found = physical.tree_sum(frame, F.col("x"), depth, partitions=27)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == [(-1000, 1000)]
    tasks = [int(n or 1) for n in re.findall(r"Exchange (?:SinglePartition|shufflepartitionidpassthrough\(.*, (\d+)\)), REPARTITION_BY_NUM", plan)]
    assert list(reversed(tasks)) == physical.tree_levels(27, depth)


# runs


def _lagged(frame, keys, order, values):
    w = Window.partitionBy(*keys).orderBy(*order)
    return frame.select("*", *[F.lag(v).over(w).alias(f"previous_{v}") for v in values])


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_runs_over_batches_and_partitions(spark, partitions):
    rng = random.Random(partitions)
    data = [("big", i, 2**60 + i, f"s{i}") for i in range(700)]  # one group over many batches and partitions
    data += [(rng.choice(["a", "b", "c", None]), i, rng.randrange(9), None if i % 5 == 0 else "x") for i in range(150)]
    data += [(f"one{i}", 0, i, "y") for i in range(30)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "k string, at int, n bigint, s string").repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        got = runs.with_previous(frame, ["k"], ["at"], ["n", "s"], partitions)
        assert rows(got) == rows(_lagged(frame, ["k"], ["at"], ["n", "s"]))
        assert got.dtypes == [*frame.dtypes, ("previous_n", "bigint"), ("previous_s", "string")]
        assert runs.with_previous(frame.limit(0), ["k"], ["at"], ["n"]).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_changes_of_the_sorting_sample(spark):
    frame = spark.createDataFrame([(2, 4), (2, 10), (3, 6), (1, 5)], "a int, b int")
    ordered = runs.secondary_sorted(frame.select((-F.col("a")).alias("a"), (-F.col("b")).alias("b")), ["a"], ["b"], 3)
    assert [(-r.a, -r.b) for r in ordered.collect()] == [(3, 6), (2, 10), (2, 4), (1, 5)]
    assert rows(runs.changes(frame, ["a"], ["b"], ["b"])) == rows(spark.createDataFrame([(1, 5, None), (2, 4, None), (2, 10, 6), (3, 6, None)], "a int, b int, c int"))


# placement and storage


def test_rows_go_where_they_are_placed(spark):
    frame = spark.range(100)
    got = physical.rows_per_partition(physical.placed(frame, 6, F.col("id") % 4))
    assert rows(got) == [(i, 25) for i in range(4)]
    assert physical.partition_count(physical.placed(frame, 6, F.col("id"))) == 6
    assert physical.partition_count(frame.repartition(6).coalesce(2)) == 2


def test_nothing_stays_in_storage(spark):
    level = StorageLevel.DISK_ONLY
    with physical.kept(spark.range(50).where("id > 9"), level) as frame:
        assert frame.count() == 40 and frame.storageLevel == level
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 1
    with pytest.raises(ValueError), physical.kept(frame) as again:
        assert again.count() == 40
        raise ValueError
    assert not frame.is_cached and spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_whole_files(spark, tmp_path):
    for label, content in (("cat", b"\x00\x01\xff"), ("dog", b"d"), ("cat", b"ab")):
        folder = tmp_path / label
        folder.mkdir(exist_ok=True)
        (folder / f"{len(content)}.bin").write_bytes(content)
    got = readers.image_files(spark, str(tmp_path), "*.bin")
    assert sorted((r.class_name, r.length, bytes(r.content)) for r in got.collect()) == [("cat", 2, b"ab"), ("cat", 3, b"\x00\x01\xff"), ("dog", 1, b"d")]
    assert all(r.path.endswith(".bin") for r in got.collect())
