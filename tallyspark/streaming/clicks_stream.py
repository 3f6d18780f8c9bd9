"""The ad-click jobs on unbounded input.

State is keyed by event time, so totals do not depend on how input falls into batches.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clicks as C
from ..session import RUNTIME_CONF, scratch_path
from .keyed_state import threshold_crossings
from .sinks import COMPACT_EVERY, BatchTable, Commits, KeySet, SliceTable


# State on local disk with a change log, so that it may outgrow the executors' memory and a
# batch uploads only what it changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_session(spark: SparkSession) -> SparkSession:
    """A session whose state stores are as many as the cluster has cores.

    The number of state partitions is fixed when a query first starts.
    """
    own = spark.newSession()
    for key, value in {**RUNTIME_CONF, **STATE_STORE}.items():
        own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return own


def start(df: DataFrame, handler, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Run ``handler(batch, batch_id)`` on each micro-batch.

    With ``every`` the query runs on at that interval; without it, it stops once the input
    present at the start has been read.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handler)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Runs independent steps at a time, so that the jobs of small tables share the cluster; fails if one does."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


def running_totals_to(
    table: BatchTable, clicks: DataFrame, checkpoint: str, every: str | None = None, watermark: str | None = None
) -> StreamingQuery:
    """Running totals per (day, ad, province, city), kept in the state store.

    With a watermark the state of a day is dropped once the day is over for that long, and
    clicks that come later are not counted.
    """
    if watermark:
        totals = C.running_totals_by_day(clicks.withWatermark("ts", watermark))
    else:
        totals = C.running_totals(clicks)
    return start(totals, table.write, checkpoint, "update", every)


def minute_counts_to(
    table: BatchTable, clicks: DataFrame, checkpoint: str, every: str | None = None, watermark: str | None = None
) -> StreamingQuery:
    """Counts per (ad, minute), from which ``clicks.trend`` makes the sliding windows.

    The state holds one row per minute instead of one per window a minute belongs to. With a
    watermark, minutes that are over for that long leave it; later clicks are not counted.
    """
    if watermark:
        counts = C.minute_windows(clicks.withWatermark("ts", watermark))
    else:
        counts = C.minute_counts(clicks)
    return start(counts, table.write, checkpoint, "update", every)


def sliding_counts_to(
    table: BatchTable, clicks: DataFrame, checkpoint: str, every: str | None = None, watermark: str | None = None
) -> StreamingQuery:
    """Counts of Spark's own sliding windows.

    With a watermark a window is written once, when closed, and its state is dropped; clicks
    that arrive later than the watermark allows are not counted. Without one every click
    counts and changed windows are written again.
    """
    if watermark:
        return start(
            C.sliding_counts(clicks.withWatermark("ts", watermark)), table.write, checkpoint, "append", every
        )
    return start(C.sliding_counts(clicks), table.write, checkpoint, "update", every)


def chained_counts_to(table: BatchTable, clicks: DataFrame, checkpoint: str, watermark: str, every: str | None = None) -> StreamingQuery:
    """Counts of sliding windows from closed minutes, by two stateful aggregations in one stream.

    A window is written once, when the watermark has passed it, and then leaves the state, as its minutes did before.
    """
    return start(C.sliding_from_minutes(clicks.withWatermark("ts", watermark)), table.write, checkpoint, "append", every)


def crossings_to(table: BatchTable, clicks: DataFrame, checkpoint: str, threshold: int, watermark: str, every: str | None = None) -> StreamingQuery:
    """The click by which a (day, user, ad) first exceeds the threshold, once each."""
    return start(threshold_crossings(clicks, threshold, watermark), table.write, checkpoint, "append", every)


@dataclass
class ClickTables:
    """The tables the click job maintains below one folder."""

    spark: SparkSession
    path: str
    commits: Commits = field(init=False)
    user_clicks: BatchTable = field(init=False)
    blacklist: KeySet = field(init=False)
    totals: BatchTable = field(init=False)
    top_ads: SliceTable = field(init=False)
    per_minute: BatchTable = field(init=False)

    def __post_init__(self):
        s, p = self.spark, self.path
        c = self.commits = Commits(s, p)
        self.user_clicks = BatchTable(
            s, f"{p}/user_clicks", "day date, user_id bigint, ad_id bigint, n bigint", ["day", "user_id", "ad_id"], "day", c
        )
        self.blacklist = KeySet(s, f"{p}/blacklist", "user_id bigint", c)
        self.totals = BatchTable(
            s, f"{p}/totals", "day date, ad_id bigint, province string, city string, n bigint", C.TOTAL_KEYS, "day", c
        )
        self.top_ads = SliceTable(
            s, f"{p}/top_ads", "ad_id bigint, n bigint, rank int, day date, province string", ["day", "province"], "day", c
        )
        self.per_minute = BatchTable(
            s, f"{p}/per_minute", "day date, ad_id bigint, minute timestamp, n bigint", ["day", "ad_id", "minute"], "day", c
        )


@dataclass
class ClickJob:
    """Per batch: drop black-listed users, count, extend the black list, re-rank, count minutes.

    The black list is read again for every batch. Only the days a batch touches are read, and
    folders are folded once a day has ``compact_every`` of them. A click repeated within a batch (same time,
    address, user, ad and place) is not valid and does not count towards the users' totals.

    A batch is marked as complete once all tables hold it. One that failed on the way runs again from the
    checkpoint, over the same clicks, and writes the same folders; nobody has read what it left.
    """

    tables: ClickTables
    threshold: int = 50
    top: int = 5
    compact_every: int = COMPACT_EVERY

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        t = self.tables
        before = F.col("batch") < batch_id
        # first of all: what follows reads the list again whenever it is written to
        t.blacklist.compact(batch_id - 1, self.compact_every)
        kept = C.without_blacklisted(batch, t.blacklist.current(before)).persist()
        try:
            days = [r["day"] for r in kept.select("day").distinct().collect()]  # the few days of a batch
            self.fold(batch_id - 1, days)
            valid = C.valid_clicks(C.batch_counts(kept)).withColumn("day", F.to_date(F.timestamp_millis("ts_ms")))

            def rank() -> None:
                t.totals.write(C.running_totals(kept), batch_id)
                slices = kept.select("day", "province").distinct()
                affected = t.totals.rows(days=days, upto=batch_id).join(slices, ["day", "province"], "left_semi")
                t.top_ads.replace(C.province_top(affected, self.top), batch_id)

            side_by_side(
                t.spark,
                lambda: t.user_clicks.write(C.daily_user_counts(valid), batch_id),
                rank,
                lambda: t.per_minute.write(C.minute_counts(kept).withColumn("day", F.to_date("minute")), batch_id),
            )
            # last, as what reads the list is made again once it is written to
            touched = valid.select("day", "user_id", "ad_id").distinct()
            history = t.user_clicks.rows(days=days, upto=batch_id).join(touched, ["day", "user_id", "ad_id"], "left_semi")
            sums = history.groupBy("day", "user_id", "ad_id").agg(F.sum("n").alias("n"))
            t.blacklist.add(C.blacklisted(sums, self.threshold), batch_id)
            t.commits.mark(batch_id)
            t.commits.forget(batch_id)
        finally:
            kept.unpersist()

    def fold(self, upto: int, days: list) -> None:
        """Folds complete batches of the days in use."""
        t = self.tables
        tables = (t.user_clicks, t.totals, t.per_minute, t.top_ads)
        side_by_side(t.spark, *[partial(table.compact, upto, days, at_least=self.compact_every) for table in tables])

    def start(self, clicks: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return start(clicks, self, checkpoint, "append", every)


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def new_tables(spark: SparkSession) -> ClickTables:
    return ClickTables(spark, scratch_path(spark, "clicks"))
