"""Operators on the small cases worked out by hand."""

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyspark.functions import arrays, geo, text
from tallyspark.operators import mlprep, people, ratings, seasons, sizes


@pytest.fixture(scope="module")
def persons(spark):
    return spark.createDataFrame(
        [("Michael", 16), ("Andy", 30), ("Justin", 19), ("Justin", 29), ("Michael", 46)], "name string, age long"
    )


def test_group_stats(persons):
    scored = persons.withColumn("score", F.col("age") * 1.0)
    got = {r["name"]: r for r in people.group_stats(scored, "name", "age", "score").collect()}
    assert (got["Michael"].sum_age, got["Michael"].avg_age) == (62, 31.0)
    assert (got["Justin"].sum_age, got["Justin"].mean_score, got["Andy"].n_age) == (48, 24.0, 1)


def test_conditional_ages(persons):
    assert rows(people.aged(persons, F.col("name") == "Andy", "age"))[0] == ("Andy", 100)
    assert ("Michael", 46) in rows(people.aged(persons, F.col("name") == "Andy", "age"))


def test_shift(persons):
    assert rows(people.shifted(persons, "age", 1000))[0] == ("Andy", 1030)
    batches = people.in_batches(persons, lambda b: b.assign(age=b["age"] + 1000))
    assert rows(batches)[0] == ("Andy", 1030)


def test_pairs(spark, persons):
    scores = spark.createDataFrame([("Michael", 88), ("Andy", 100), ("Justin", 89)], "n string, score long")
    both = people.pairs(persons, scores, F.col("l.name") == F.col("r.n"))
    assert both.count() == 5 and both.first()["left"]["name"] == both.first()["right"]["n"]


def test_qualified(spark):
    scores = spark.createDataFrame(
        [("Justin", 99), ("zhangsan", 100), ("zhangsan", 96), ("Andy", 80)], "user_id string, score long"
    )
    ages = spark.createDataFrame([("Michael", 20), ("Andy", 17), ("Justin", 19), ("zhangsan", 25)], "user_id string, age int")
    assert rows(people.qualified(ages, scores, 90)) == [("Justin", 19, 1, 99), ("zhangsan", 25, 2, 100)]
    assert rows(people.members_only(ages, scores, 90)) == [("Justin", 19), ("zhangsan", 25)]


def test_floored_sum(spark):
    df = spark.createDataFrame([("a", 90), ("a", 100), ("a", 90), ("a", 60)], "k string, v int")
    assert people.floored_sum(df, "k", "v", 80).first().total == 360


def test_left_join_default(spark):
    left = spark.createDataFrame([(666,), (888,), (999,)], "id int")
    right = spark.createDataFrame([(666, "x"), (999, "y")], "id int, v string")
    assert rows(people.left_with_default(left, right, "id", "v", "none")) == [(666, "x"), (888, "none"), (999, "y")]


def test_tree_sum(spark):
    assert people.tree_sum(spark, -1000, 1000, 5).first().total == -1000


def test_secondary_sort(spark):
    df = spark.createDataFrame([(2, 4), (2, 10), (3, 6), (1, 5)], "ts int, rating int").withColumns(
        {"user_id": F.lit(1), "movie_id": F.lit(1)}
    )
    got = [(r.ts, r.rating) for r in ratings.latest_ratings(df, 4).collect()]
    assert got == [(3, 6), (2, 10), (2, 4), (1, 5)]


def test_statistics_with_missing(spark):
    df = spark.createDataFrame([(400.0,), (None,), (500.0,)], "v double")
    r = seasons.stats_with_missing(df, None, "v").first()
    assert (r.v_count, r.v_missing, r.v_max) == (2, 1, 500.0)
    none = seasons.stats_with_missing(df.where("v > 1000"), None, "v").first()
    assert (none.v_count, none.v_avg, none.v_max) == (0, None, None)


def test_season_invariants(tables):
    stored = tables.stored_seasons()
    z = seasons.z_values(stored)
    means = z.groupBy("year").agg(F.avg("z_PTS").alias("m"), F.stddev_pop("z_PTS").alias("s")).collect()
    assert all(abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9 for r in means)
    # BLK does not vary before 1997, so it has no z-score and the total is missing
    early = z.where("year <= 1996").select("z_BLK", "z_total").distinct().collect()
    assert [tuple(r) for r in early] == [(None, None)]
    best = seasons.normalised(stored).select(F.max(F.abs("nPTS")).alias("m")).first().m
    assert best == pytest.approx(1.0)


def test_first_season_has_no_delta(spark):
    players = spark.createDataFrame(
        [("a", 2000, 20, 1.0, 2.0), ("a", 2002, 22, 4.0, 2.5), ("b", 2001, 30, 9.0, 9.0)],
        "name string, year int, age int, zTOT double, nTOT double",
    )
    got = rows(seasons.deltas(players).select("name", "exp", "deltaZ", "deltaN"))
    assert got == [("a", 0, None, None), ("a", 2, 3.0, 0.5), ("b", 0, None, None)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2)], "k string, v int")
    assert rows(sizes.first_per_key(df, ["k"], [F.asc("v")])) == [("x", 1), ("y", 2)]


@pytest.fixture(scope="module")
def hot(spark):
    """A table in which one key holds a third of the rows, and one row per key."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100).cast("long").alias("k"),
        F.col("id").alias("v"),
    )
    dim = facts.groupBy("k").agg(F.max("v").alias("m")).where("k != 101")
    return facts, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(hot, how):
    facts, dim = hot
    split = sizes.skew_join(facts, dim, "k", how, rows_per_task=100)
    plain = facts.join(dim, "k", how)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_skew_join_spreads_the_hot_key(spark):
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    dim = facts.groupBy("k").agg(F.count("*").alias("n"))
    as_if_large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {key: spark.conf.get(key) for key in as_if_large}
    for key, value in as_if_large.items():
        spark.conf.set(key, value)
    try:
        joined = sizes.skew_join(facts, dim.drop("n"), "k", counts=dim, rows_per_task=1_000)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert sum(r.n for r in per_task) == 60_000
    assert max(r.n for r in per_task) < 10_000  # the hot key alone has 20 000 rows


def test_group_limit_comes_before_the_shuffle(tables):
    ranked = sizes.top_per_group(tables.device_log, ["user_id"], [F.asc("item"), F.asc("device")], 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_chunks_hold_everything_and_stay_small(hot):
    facts, _ = hot
    chunks = sizes.chunked_lists(facts, "k", "v", 50).collect()
    assert sorted(v for c in chunks for v in c["values"]) == list(range(3000))
    assert max(len(c["values"]) for c in chunks) < 100


def test_chunks_of_equal_values_stay_small(spark):
    facts = spark.range(6000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("v"))
    chunks = sizes.chunked_lists(facts, "k", "v", 50).collect()
    assert sorted(v for c in chunks for v in c["values"]) == sorted([0, 1, 2] * 2000)
    assert max(len(c["values"]) for c in chunks) < 100


def test_many_hot_keys_and_missing_keys_are_spread(spark):
    facts = spark.range(0, 6000, 1, 4).select(F.when(F.col("id") % 2 == 0, F.col("id") % 300).alias("k"), F.lit(0).alias("v"))
    dim = facts.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left", "left_anti"):
        got = sizes.skew_join(facts, dim, "k", how, rows_per_task=2)
        assert rows(got) == rows(facts.join(dim, "k", how))


def test_collected_values(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    got = {r.k: (r["values"], [tuple(x) for x in r.value_counts]) for r in sizes.collected_values(df, "k", "v").collect()}
    assert got == {"a": ([1, 2], [(1, 1), (2, 2)]), "b": ([5], [(5, 1)])}


def test_text_functions(spark):
    df = spark.createDataFrame([("a,,b,,,,c",)], "s string")
    assert df.select(text.fill_empty_fields(F.col("s"))).first()[0] == "a,0,b,0,0,0,c"
    path = spark.createDataFrame([("/data/flowers/roses/1.jpg",), ("/data/other/2.jpg",)], "p string")
    labels = [r[0] for r in path.select(text.label_from_path(F.col("p"), {"sunflowers": 0, "roses": 2})).collect()]
    assert labels == [2, None]


def test_projection(spark):
    df = spark.createDataFrame([(121.5, 31.2)], "lon double, lat double")
    x, y, t = df.select(
        geo.mercator_x(F.col("lon")), geo.mercator_y(F.col("lat")), geo.fixed_text(F.col("lat"))
    ).first()
    assert x == pytest.approx(13525318.1295) and y == pytest.approx(3658750.2797737) and t == "31.2000000"


def test_arrays(spark):
    df = spark.createDataFrame([([0.0, 255.0, 51.0],)], "a array<float>").withColumn("label", F.lit(1))
    r = df.select(
        arrays.rescale(F.col("a")).alias("r"),
        arrays.one_hot(F.col("label"), 3).alias("h"),
        arrays.softmax(F.array(F.lit(1.0), F.lit(2.0))).alias("s"),
        arrays.top_k(F.col("a"), 2).alias("t"),
        arrays.dot(F.col("a"), F.col("a")).alias("d"),
    ).first()
    assert r.r == pytest.approx([-0.5, 0.5, -0.3]) and r.h == [0, 1, 0]
    assert r.s == pytest.approx([0.26894142, 0.73105858])
    assert [(x.value, x.pos) for x in r.t] == [(255.0, 1), (51.0, 2)] and r.d == 255.0**2 + 51.0**2


@pytest.mark.parametrize("n", [3, 23, 1000])
def test_contiguous_folds(spark, n):
    df = spark.range(n).select((F.col("id") * 7 - 50).alias("rec"))
    got = [r.fold for r in mlprep.contiguous_folds(df, "rec").orderBy("rec").collect()]
    size = n // 5
    want = [min(i // size + 1, 5) if size else 5 for i in range(n)]
    assert got == want


def test_numbered_is_a_global_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = [r.rn for r in mlprep.numbered(df, "k").orderBy("k").collect()]
    assert got == list(range(1, 5001))


def test_holdout(spark):
    df = spark.range(60).select((F.col("id") % 2).alias("u"), F.col("id").alias("rec"), (-F.col("id")).alias("t"))
    out = mlprep.per_user_holdout(df, "u", ["t", "rec"], "rec", {"ra": (1, 10), "rb": (11, 20)})
    counts = {(r.u, r.part): r.n for r in out.groupBy("u", "part").agg(F.count("*").alias("n")).collect()}
    assert counts == {(u, p): 10 for u in (0, 1) for p in ("ra", "rb", "train")}
    assert {r.rec for r in out.where("u = 0 AND part = 'ra'").collect()} == set(range(40, 60, 2))


def test_vectors_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1.0, Vectors.dense([1.0, 2.0])), (0.0, Vectors.sparse(2, {1: 3.0}))], ["label", "features"])
    arr = mlprep.vector_rows(df)
    assert rows(arr) == [([0.0, 3.0], 0), ([1.0, 2.0], 1)]
    mlprep.export_shuffled(arr, str(tmp_path / "x"), 2)
    assert rows(spark.read.parquet(str(tmp_path / "x"))) == rows(arr)


def test_scoring_skips_unusable_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0])], "id long, x array<double>")
    weights = np.array([[0.5, 0.0], [2.0, 0.0], [-1.0, 0.0]])
    got = mlprep.batch_score_topk(df, "id", "x", weights, 2).collect()
    assert [(r.id, [(p.label, p.score) for p in r.top]) for r in got] == [(1, [(1, 2.0), (0, 0.5)])]
    scores = mlprep.batch_score(df.where("id = 1"), "x", weights).first().scores
    assert scores == [0.5, 2.0, -1.0]


def test_registered_function(spark):
    spark.udf.register("plus_one", lambda x: x + 1, "long")
    assert spark.sql("SELECT plus_one(41L)").first()[0] == 42


def test_splits(spark):
    df = spark.range(10_000)
    share = mlprep.hash_split(df, "id").where("is_val").count() / 10_000
    assert 0.17 < share < 0.23
    parts = people.random_parts(df, [10.0, 20.0], 3)
    assert parts.count() == 10_000 and parts.select("id").distinct().count() == 10_000
    assert 3000 < parts.where("part = 0").count() < 3700


def test_classifier_learns(tables):
    from tallyspark.plans import QUERIES

    out = QUERIES["embedding_classifier"](tables)
    total, right = out.count(), out.where("label = predicted").count()
    assert total == 500 and right / total > 0.2


def test_partitions_and_cache(spark):
    df = spark.range(100).repartition(6)
    assert df.rdd.getNumPartitions() == 6 and df.coalesce(2).rdd.getNumPartitions() == 2
    kept = df.persist()
    assert kept.count() == 100
    kept.unpersist()
