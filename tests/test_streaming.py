"""Streaming jobs give the batch result however the input falls into batches."""

from __future__ import annotations

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tallyspark.operators import clicks as C
from tallyspark.plans.tables import Tables
from tallyspark.session import make_folder, scratch_path
from tallyspark.sources import readers
from tallyspark.streaming import clicks_stream as S
from tallyspark.streaming.keyed_state import state_rows
from tallyspark.streaming.sinks import BatchTable, Commits, KeySet, SliceTable

TOTALS = "day date, ad_id bigint, province string, city string, n bigint"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in four files, out of time order."""
    path = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(4, F.col("event_id") % 4).write.mode("overwrite").parquet(path)
    return path, events.schema


def stream(spark, parts):
    path, schema = parts
    own = S.stream_session(spark)
    events = readers.file_stream(own, path, schema, "*.parquet", files_per_trigger=1)
    return C.parse(Tables.click_text(events))


def test_running_totals(spark, parts, tables):
    table = BatchTable(spark, scratch_path(spark, "t"), TOTALS, C.TOTAL_KEYS)
    query = S.running_totals_to(table, stream(spark, parts), scratch_path(spark, "c"))
    S.run_to_end(query)
    assert table.rows().select("batch").distinct().count() > 1
    assert rows(table.latest()) == rows(C.running_totals(tables.clicks))


def test_running_totals_with_watermark(spark, tables):
    own = S.stream_session(spark)
    table = BatchTable(spark, scratch_path(spark, "t"), TOTALS, C.TOTAL_KEYS)
    S.run_to_end(S.running_totals_to(table, tables.click_stream(own), scratch_path(spark, "c"), watermark="1 hour"))
    assert rows(table.latest()) == rows(C.running_totals(tables.clicks))


def test_interval_trigger_keeps_running(spark, parts, tables):
    table = BatchTable(spark, scratch_path(spark, "t"), TOTALS, C.TOTAL_KEYS)
    query = S.running_totals_to(table, stream(spark, parts), scratch_path(spark, "c"), every="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert rows(table.latest()) == rows(C.running_totals(tables.clicks))


def test_empty_batch_changes_nothing(spark):
    t = S.new_tables(spark)
    job = S.ClickJob(t)
    job(_clicks(spark, [(1, 7, 1)]), 0)
    job(_clicks(spark, [(1, 7, 1)]).where("false"), 1)
    assert rows(t.top_ads.current().select("ad_id", "n")) == [(1, 1)]


def test_minute_counts_and_trend(spark, parts, tables):
    table = BatchTable(spark, scratch_path(spark, "t"), "ad_id bigint, minute timestamp, n bigint", ["ad_id", "minute"])
    S.run_to_end(S.minute_counts_to(table, stream(spark, parts), scratch_path(spark, "c")))
    batch = C.trend(C.minute_counts(tables.clicks))
    assert rows(C.trend(table.latest())) == rows(batch)
    spark_windows = C.with_time_parts(C.sliding_counts(tables.clicks))
    assert rows(spark_windows) == rows(batch)


def test_sliding_windows_without_watermark(spark, parts, tables):
    table = BatchTable(
        spark, scratch_path(spark, "t"), "ad_id bigint, window_end timestamp, n bigint", ["ad_id", "window_end"]
    )
    S.run_to_end(S.sliding_counts_to(table, stream(spark, parts), scratch_path(spark, "c")))
    assert rows(table.latest()) == rows(C.sliding_counts(tables.clicks))


def test_watermark_emits_closed_windows(spark, tables):
    """With all input in one batch nothing is late; windows past the watermark come out once."""
    own = S.stream_session(spark)
    table = BatchTable(
        spark, scratch_path(spark, "t"), "ad_id bigint, window_end timestamp, n bigint", ["ad_id", "window_end"]
    )
    query = S.sliding_counts_to(
        table, tables.click_stream(own), scratch_path(spark, "c"), watermark="10 minutes"
    )
    S.run_to_end(query)
    last = tables.clicks.agg(F.max("ts")).first()[0]
    closed = C.sliding_counts(tables.clicks).where(
        F.col("window_end") <= F.lit(last) - F.expr("interval 10 minutes")
    )
    assert rows(table.rows().drop("batch")) == rows(closed)


def test_click_job_equals_batch(spark, parts, tables):
    t = S.new_tables(spark)
    S.run_to_end(S.ClickJob(t, threshold=10**9).start(stream(spark, parts), scratch_path(spark, "c")))
    assert rows(t.totals.sums()) == rows(C.running_totals(tables.clicks))
    want = C.province_top(C.running_totals(tables.clicks)).select("ad_id", "n", "rank", "day", "province")
    assert rows(t.top_ads.current()) == rows(want)
    assert rows(t.per_minute.sums().drop("day")) == rows(C.minute_counts(tables.clicks))
    valid = C.valid_clicks(C.batch_counts(tables.clicks)).withColumn("day", F.to_date(F.timestamp_millis("ts_ms")))
    assert rows(t.user_clicks.sums()) == rows(C.daily_user_counts(valid))
    assert t.blacklist.current().count() == 0


def _clicks(spark, entries):
    lines = [(f"{ms}\t1.1.1.1\t{user}\t{ad}\tp\tc",) for ms, user, ad in entries]
    return C.parse(spark.createDataFrame(lines, "value string"))


def test_blacklist_takes_effect_in_the_next_batch(spark):
    t = S.new_tables(spark)
    job = S.ClickJob(t, threshold=2)
    job(_clicks(spark, [(1000 * i, 7, 1) for i in range(3)] + [(500, 8, 1)]), 0)
    assert rows(t.blacklist.current()) == [(7,)]
    job(_clicks(spark, [(90_000, 7, 1), (91_000, 8, 1)]), 1)
    assert rows(t.blacklist.current()) == [(7,)]
    assert rows(t.user_clicks.sums().select("user_id", "n")) == [(7, 3), (8, 2)]


def test_replayed_batch_counts_once(spark):
    t = S.new_tables(spark)
    job = S.ClickJob(t, threshold=2)
    batch = _clicks(spark, [(1000 * i, 7, 1) for i in range(3)])
    job(batch, 0)
    job(batch, 0)
    assert rows(t.totals.sums().select("n")) == [(3,)]
    assert rows(t.blacklist.current()) == [(7,)]
    assert rows(t.top_ads.current().select("ad_id", "n", "rank")) == [(1, 3, 1)]


def test_repeated_click_is_not_valid(spark):
    t = S.new_tables(spark)
    S.ClickJob(t)(_clicks(spark, [(1, 7, 1), (1, 7, 1), (2, 7, 1)]), 0)
    assert rows(t.user_clicks.sums().select("n")) == [(1,)]
    assert rows(t.totals.sums().select("n")) == [(3,)]


def test_compaction_keeps_the_state(spark):
    table = BatchTable(spark, scratch_path(spark, "t"), "k string, n bigint", ["k"])
    for i in range(4):
        table.write(spark.createDataFrame([("a", i), (f"b{i}", 1)], "k string, n bigint"), i)
    small = table.compacted(scratch_path(spark, "t"), 3)
    assert rows(small.sums()) == rows(table.sums())
    latest = table.compacted(scratch_path(spark, "t"), 3, increments=False)
    assert rows(latest.latest()) == rows(table.latest()) and ("a", 3) in rows(latest.latest())
    small.write(spark.createDataFrame([("a", 10)], "k string, n bigint"), 4)
    assert ("a", 16) in rows(small.sums())


def test_key_set_adds_only_new_keys(spark):
    keys = KeySet(spark, scratch_path(spark, "k"), "id bigint")
    keys.add(spark.createDataFrame([(1,), (2,), (2,)], "id bigint"), 0)
    keys.add(spark.createDataFrame([(2,), (3,)], "id bigint"), 1)
    assert rows(keys.current()) == [(1,), (2,), (3,)]


def test_replacing_a_slice_keeps_the_others(spark):
    schema = "v int, day date, p string"
    table = SliceTable(spark, scratch_path(spark, "s"), schema, ["day", "p"])
    make = lambda data: spark.createDataFrame(data, "v int, day string, p string").withColumn("day", F.to_date("day"))
    table.replace(make([(1, "2024-01-01", "x"), (2, "2024-01-01", "y"), (3, "2024-01-02", "x")]))
    table.replace(make([(9, "2024-01-01", "x")]))
    assert sorted(r.v for r in table.current().collect()) == [2, 3, 9]


def test_folders_stay_few_over_many_batches(spark):
    t = S.new_tables(spark)
    job = S.ClickJob(t, threshold=5, compact_every=3)
    folders = []
    for i in range(9):
        job(_clicks(spark, [(1000 * i, 7, 1), (1000 * i + 86_400_000 * (i % 2), 8, 2)]), i)
        folders.append(len(t.totals.rows().inputFiles()))
    assert max(folders) <= 2 * (3 + 1)  # of two days, three batches and a folded one each
    assert rows(t.totals.sums().groupBy("ad_id").agg(F.sum("n"))) == [(1, 6), (2, 9)]
    assert rows(t.blacklist.current()) == [(7,)]


def test_minute_windows_with_watermark(spark, tables):
    own = S.stream_session(spark)
    table = BatchTable(spark, scratch_path(spark, "t"), "ad_id bigint, minute timestamp, n bigint", ["ad_id", "minute"])
    S.run_to_end(S.minute_counts_to(table, tables.click_stream(own), scratch_path(spark, "c"), watermark="1 hour"))
    assert rows(table.latest()) == rows(C.minute_counts(tables.clicks))


def test_stream_session_keeps_the_runtime_settings(spark):
    assert S.stream_session(spark).conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_job_that_fails_between_two_tables_goes_on(spark, parts, tables):
    whole = S.new_tables(spark)
    S.run_to_end(S.ClickJob(whole, threshold=1).start(stream(spark, parts), scratch_path(spark, "c")))

    t = S.new_tables(spark)
    checkpoint, write = scratch_path(spark, "c"), t.totals.write

    def failing(df, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost between two tables")
        write(df, batch_id)

    t.totals.write = failing
    query = S.ClickJob(t, threshold=1).start(stream(spark, parts), checkpoint)
    with pytest.raises(Exception, match="lost between two tables"):
        query.awaitTermination()
    assert t.commits.last() == 0
    # rows of the second batch are there, but no reader sees them
    assert t.user_clicks.rows(upto=1).where("batch = 1").count() > 0 and t.user_clicks.rows().where("batch > 0").count() == 0
    seen = t.totals.sums().agg(F.sum("n")).first()[0]
    assert t.per_minute.sums().agg(F.sum("n")).first()[0] == seen == t.totals.rows().agg(F.sum("n")).first()[0]

    t.totals.write = write
    S.run_to_end(S.ClickJob(t, threshold=1).start(stream(spark, parts), checkpoint))
    assert t.commits.last() == whole.commits.last() > 1
    for name in ("user_clicks", "totals", "per_minute"):
        assert rows(getattr(t, name).sums()) == rows(getattr(whole, name).sums())
    assert rows(t.top_ads.current()) == rows(whole.top_ads.current())
    assert rows(t.blacklist.current()) == rows(whole.blacklist.current())


def test_slices_of_unmarked_batches_are_not_read(spark):
    path = scratch_path(spark, "s")
    commits = Commits(spark, path)
    table = SliceTable(spark, f"{path}/top", "v int, p string", ["p"], commits=commits)
    make = lambda *data: spark.createDataFrame(data, "v int, p string")
    table.replace(make((1, "x"), (2, "y")), 0)
    assert table.current().count() == 0
    commits.mark(0)
    table.replace(make((9, "x")), 1)
    assert sorted(r.v for r in table.current().collect()) == [1, 2]
    commits.mark(1)
    assert sorted(r.v for r in table.current().collect()) == [2, 9]
    table.compact(1, at_least=2)
    assert sorted(r.v for r in table.current().collect()) == [2, 9]
    commits.forget(1)
    assert commits.last() == 1


def _timed(spark, files, one_by_one=True):
    """A stream of click lines from files that come one after another."""
    path = scratch_path(spark, "timed")
    own = S.stream_session(spark)
    make_folder(spark, path)
    lines = readers.file_stream(own, path, "value string", "*.parquet")

    def add(i):
        rows_ = [(f"{ms}\t1.1.1.1\t{user}\t{ad}\tp\tc",) for ms, user, ad in files[i]]
        spark.createDataFrame(rows_, "value string").coalesce(1).write.mode("append").parquet(path)

    return C.parse(lines), add


DAY = 86_400_000


def test_crossings_come_once_and_state_is_dropped(spark):
    files = [
        [(1000, 7, 1), (2000, 7, 1), (3000, 8, 1)],
        [(9000, 7, 1), (5000, 7, 1), (6000, 8, 1)],  # in one batch, out of order
        [(10_000, 7, 1), (11_000, 8, 1), (DAY + 1, 7, 1)],
        [(4 * DAY, 9, 9)],
        [(8 * DAY, 9, 9)],
    ]
    clicks, add = _timed(spark, files)
    table = BatchTable(spark, scratch_path(spark, "t"), "day date, user_id bigint, ad_id bigint, at timestamp, n bigint", ["day", "user_id", "ad_id"])
    checkpoint, held = scratch_path(spark, "c"), []
    for i in range(len(files)):
        add(i)
        S.run_to_end(S.crossings_to(table, clicks, checkpoint, 2, "1 hour"))
        held.append(state_rows(spark, checkpoint).count())
    got = {(r.user_id, r.ms, r.n) for r in table.rows().select("user_id", "n", F.unix_millis("at").alias("ms")).collect()}
    assert got == {(7, 5000, 3), (8, 11_000, 3)}
    assert held[:3] == [2, 2, 3] and held[-1] <= 2  # the first days' keys have left


def test_crossings_equal_a_batch_result(spark, tables):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    path, own = scratch_path(spark, "timed"), S.stream_session(spark)
    make_folder(spark, path)
    stream_ = C.parse(Tables.click_text(readers.file_stream(own, path, events.schema, "*.parquet")))
    table = BatchTable(spark, scratch_path(spark, "t"), "day date, user_id bigint, ad_id bigint, at timestamp, n bigint", ["day", "user_id", "ad_id"])
    middle = events.agg(F.expr("timestampadd(second, timestampdiff(second, min(ts), max(ts)) div 2, min(ts))")).first()[0]
    checkpoint = scratch_path(spark, "c")
    for part in (events.where(F.col("ts") < F.lit(middle)), events.where(F.col("ts") >= F.lit(middle))):
        part.write.mode("append").parquet(path)
        S.run_to_end(S.crossings_to(table, stream_, checkpoint, 0, "1 hour"))
    first = tables.clicks.groupBy("day", "user_id", "ad_id").agg(F.min("ts").alias("at"))
    assert rows(table.rows().select("day", "user_id", "ad_id", "at")) == rows(first)


def test_chained_windows_equal_sliding_ones(spark):
    files = [
        [(60_000 * i, 1, i % 2) for i in range(50)] + [(60_000 * 7 + i, 1, 1) for i in range(5)],
        [(60_000 * i, 1, 0) for i in range(50, 140)],
        [(DAY, 1, 3)],  # closes what is before
    ]
    clicks, add = _timed(spark, files)
    table = BatchTable(spark, scratch_path(spark, "t"), "ad_id bigint, window_end timestamp, n bigint", ["ad_id", "window_end"])
    checkpoint = scratch_path(spark, "c")
    for i in range(len(files)):
        add(i)
        S.run_to_end(S.chained_counts_to(table, clicks, checkpoint, "10 minutes"))
    entries = [(f"{ms}\t1.1.1.1\t{user}\t{ad}\tp\tc",) for part in files[:2] for ms, user, ad in part]
    want = C.sliding_counts(C.parse(spark.createDataFrame(entries, "value string")))
    assert table.rows().groupBy("ad_id", "window_end").count().where("count > 1").count() == 0
    assert rows(table.rows().drop("batch")) == rows(want)
    assert state_operators(spark, checkpoint) == 2  # two stateful steps in one stream


def state_operators(spark, checkpoint):
    return spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().count()


def test_crossings_of_many_keys_take_few_calls(spark):
    """The keys of a day share calls and rows of state, so both stay bounded while the keys grow."""
    files = [[(1000 + i, i % 600, 1) for i in range(600)], [(5000 + i, i % 600, 1) for i in range(0, 600, 2)] + [(7000, 2, 1)]]
    clicks, add = _timed(spark, files)
    table = BatchTable(spark, scratch_path(spark, "t"), "day date, user_id bigint, ad_id bigint, at timestamp, n bigint", ["day", "user_id", "ad_id"])
    checkpoint = scratch_path(spark, "c")
    for i in range(len(files)):
        add(i)
        S.run_to_end(S.crossings_to(table, clicks, checkpoint, 1, "1 hour"))
    got = sorted(tuple(r) for r in table.rows().select("user_id", "n", F.unix_millis("at")).collect())
    assert got == [(i, 2, 5000 + i) for i in range(0, 600, 2)]
    assert state_rows(spark, checkpoint).count() <= 256
