"""Ad-click queries, in batch and as streaming jobs that run to the end of their input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import clicks as C
from ..session import make_folder, materialise, scratch_path
from ..sources import readers
from ..streaming import clicks_stream as S
from ..streaming.sinks import BatchTable, KeySet, SliceTable
from .registry import query

CLICKS = r"""
clicks AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms, '192.168.112.' || (event_id % 12 + 239) AS ip, user_id,
         CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS ad_id, 'province-' || user_id % 5 AS province,
         'city-' || user_id % 25 AS city, CAST(ts AS DATE) AS day, date_trunc('minute', ts) AS at_minute
  FROM events WHERE event_type IN ('click', 'view'))
"""
# one click on an ad in a day is common in this data, so a second one already counts as abuse
THRESHOLD = 1
BLACKLIST = f"""
blacklist AS (
  SELECT DISTINCT user_id FROM clicks GROUP BY day, user_id, ad_id HAVING count(*) > {THRESHOLD})
"""


@query("ad_parse", f"WITH {CLICKS} SELECT ts_ms, ip, user_id, ad_id, province, city, day FROM clicks")
def ad_parse(t):
    return t.clicks.drop("ts")


@query(
    "ad_filter_blacklist",
    f"""
WITH {CLICKS}, {BLACKLIST}
SELECT ts_ms, user_id, ad_id FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist)
""",
)
def ad_filter_blacklist(t):
    bad = materialise(C.blacklisted(C.daily_user_counts(t.clicks), THRESHOLD))
    return C.without_blacklisted(t.clicks, bad).select("ts_ms", "user_id", "ad_id")


@query(
    "ad_batch_counts",
    f"WITH {CLICKS} SELECT ts_ms, ip, user_id, ad_id, province, city, count(*) AS n FROM clicks GROUP BY ALL",
)
def ad_batch_counts(t):
    return C.batch_counts(t.clicks)


@query(
    "ad_valid_clicks",
    f"""
WITH {CLICKS}
SELECT ts_ms, ip, user_id, ad_id, province, city, count(*) AS n FROM clicks GROUP BY ALL HAVING count(*) <= 1
""",
)
def ad_valid_clicks(t):
    return C.valid_clicks(C.batch_counts(t.clicks))


@query("ad_blacklist", f"WITH {CLICKS}, {BLACKLIST} SELECT user_id FROM blacklist")
def ad_blacklist(t):
    known = KeySet(t.spark, scratch_path(t.spark, "blacklist"), "user_id bigint")
    known.add(C.blacklisted(C.daily_user_counts(t.clicks), THRESHOLD), 0)
    return known.current()


TOTALS = f"WITH {CLICKS} SELECT day, ad_id, province, city, count(*) AS n FROM clicks GROUP BY ALL"


@query("ad_running_totals", TOTALS)
def ad_running_totals(t):
    own = S.stream_session(t.spark)
    table = BatchTable(
        t.spark, scratch_path(t.spark, "totals"),
        "day date, ad_id bigint, province string, city string, n bigint", C.TOTAL_KEYS,
    )
    S.run_to_end(S.running_totals_to(table, t.click_stream(own), scratch_path(t.spark, "checkpoint"), watermark="2 days"))
    return table.latest()


@query("ad_upsert", TOTALS)
def ad_upsert(t):
    """The same totals as increments per batch, added to the stored table."""
    own = S.stream_session(t.spark)
    table = BatchTable(
        t.spark, scratch_path(t.spark, "totals"),
        "day date, ad_id bigint, province string, city string, n bigint", C.TOTAL_KEYS,
    )

    def add(batch, batch_id):
        table.write(C.running_totals(batch), batch_id)

    S.run_to_end(S.start(t.click_stream(own), add, scratch_path(t.spark, "checkpoint")))
    return table.sums()


TOP5 = """
ranked AS (
  SELECT day, province, ad_id, count(*) AS n,
         CAST(row_number() OVER (PARTITION BY day, province ORDER BY count(*) DESC, ad_id) AS INTEGER) AS rank
  FROM clicks GROUP BY day, province, ad_id)
"""


@query("ad_province_top5", f"WITH {CLICKS}, {TOP5} SELECT * FROM ranked WHERE rank <= 5")
def ad_province_top5(t):
    return C.province_top(C.running_totals(t.clicks))


@query(
    "ad_replace_slice",
    f"""
WITH {CLICKS}, {TOP5}
SELECT * FROM ranked
WHERE rank <= CASE WHEN day = DATE '2024-01-02' AND province = 'province-1' THEN 3 ELSE 5 END
""",
)
def ad_replace_slice(t):
    """Stores the top 5, then replaces one slice by its top 3; the others stay."""
    table = SliceTable(
        t.spark, scratch_path(t.spark, "top-ads"),
        "ad_id bigint, n bigint, rank int, day date, province string", ["day", "province"],
    )
    totals = C.running_totals(t.clicks)
    table.replace(C.province_top(totals))
    one = (F.col("day") == F.lit("2024-01-02").cast("date")) & (F.col("province") == "province-1")
    table.replace(C.province_top(totals.where(one), 3))
    return table.current()


TREND = f"""
WITH {CLICKS}, windows AS (
  SELECT ad_id, unnest(generate_series(at_minute + INTERVAL 1 MINUTE, at_minute + INTERVAL 30 MINUTE, INTERVAL 1 MINUTE)) AS window_end
  FROM clicks)
SELECT ad_id, window_end, CAST(window_end AS DATE) AS day, CAST(hour(window_end) AS INTEGER) AS hour,
       CAST(minute(window_end) AS INTEGER) AS minute, count(*) AS n
FROM windows GROUP BY ad_id, window_end
"""


@query("ad_trend_batch", TREND)
def ad_trend_batch(t):
    return C.trend(C.minute_counts(t.clicks))


@query("ad_trend_stream", TREND)
def ad_trend_stream(t):
    own = S.stream_session(t.spark)
    table = BatchTable(
        t.spark, scratch_path(t.spark, "trend"), "ad_id bigint, minute timestamp, n bigint", ["ad_id", "minute"]
    )
    S.run_to_end(S.minute_counts_to(table, t.click_stream(own), scratch_path(t.spark, "checkpoint"), watermark="2 days"))
    return C.trend(table.latest())


PARTS = 3


def _timed_feed(t, own, name: str, closing: bool = False):
    """A stream over files that hold the events in the order of time, and a function that adds the next file.

    With ``closing``, a last file has one click a month later, which closes all windows before it."""
    path = scratch_path(t.spark, name)
    make_folder(t.spark, path)
    events = t.read("events")
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    step = (ends["high"] - ends["low"]) / PARTS
    borders = [ends["low"] + step * i for i in range(1, PARTS)]
    part = sum((F.col("ts") >= F.lit(b)).cast("int") for b in borders)
    files = [events.where(part == i) for i in range(PARTS)]
    if closing:
        last = events.orderBy(F.desc("event_id")).limit(1)
        files.append(last.withColumn("ts", F.lit(ends["high"] + timedelta(days=31))).withColumn("event_type", F.lit("click")))

    def add(i: int) -> None:
        files[i].write.mode("append").parquet(path)

    stream = C.parse(t.click_text(readers.file_stream(own, path, events.schema, "*.parquet")))
    return stream, add, len(files)


def _run_through(feed, start) -> None:
    """Goes on from the checkpoint each time a file has come."""
    stream, add, n = feed
    for i in range(n):
        add(i)
        S.run_to_end(start(stream))


@query("ad_trend_chained", TREND)
def ad_trend_chained(t):
    own = S.stream_session(t.spark)
    table = BatchTable(
        t.spark, scratch_path(t.spark, "trend"), "ad_id bigint, window_end timestamp, n bigint", ["ad_id", "window_end"]
    )
    checkpoint = scratch_path(t.spark, "checkpoint")
    _run_through(_timed_feed(t, own, "timed", closing=True), lambda clicks: S.chained_counts_to(table, clicks, checkpoint, "1 hour"))
    return C.with_time_parts(table.rows())


@query(
    "ad_threshold_crossings",
    f"""
WITH {CLICKS}
SELECT day, user_id, ad_id, make_timestamp(ts_ms * 1000) AS at, CAST(k AS BIGINT) AS n
FROM (SELECT *, row_number() OVER (PARTITION BY day, user_id, ad_id ORDER BY ts_ms) AS k FROM clicks) WHERE k = {THRESHOLD + 1}
""",
)
def ad_threshold_crossings(t):
    """State of one's own, over three files in the order of time."""
    own = S.stream_session(t.spark)
    table = BatchTable(
        t.spark, scratch_path(t.spark, "crossings"), "day date, user_id bigint, ad_id bigint, at timestamp, n bigint",
        ["day", "user_id", "ad_id"],
    )
    checkpoint = scratch_path(t.spark, "checkpoint")
    _run_through(_timed_feed(t, own, "timed"), lambda clicks: S.crossings_to(table, clicks, checkpoint, THRESHOLD, "1 hour"))
    return table.rows().select("day", "user_id", "ad_id", F.col("at").cast("timestamp_ntz").alias("at"), "n")


BATCHES = 3


def _replayed_sql() -> str:
    """The job's batches in turn: each drops the users listed before it and may list more."""
    ctes = ["listed0 AS (SELECT user_id FROM clicks WHERE false)", "counted0 AS (SELECT day, user_id, ad_id, 0 AS n FROM clicks WHERE false)"]
    for i in range(1, BATCHES + 1):
        ctes.append(
            f"""kept{i} AS MATERIALIZED (
  SELECT c.* FROM clicks c JOIN (SELECT event_id, event_id % {BATCHES} AS b FROM events) e USING (event_id)
  WHERE b = {i - 1} AND c.user_id NOT IN (SELECT user_id FROM listed{i - 1})),
counted{i} AS MATERIALIZED (
  SELECT * FROM counted{i - 1} UNION ALL
  SELECT day, user_id, ad_id, count(*) FROM (
    SELECT day, ts_ms, ip, user_id, ad_id, province, city FROM kept{i} GROUP BY ALL HAVING count(*) <= 1) GROUP BY day, user_id, ad_id),
listed{i} AS MATERIALIZED (
  SELECT user_id FROM listed{i - 1} UNION
  SELECT user_id FROM counted{i} GROUP BY day, user_id, ad_id HAVING sum(n) > {THRESHOLD})"""
        )
    kept = " UNION ALL ".join(f"SELECT day, province, ad_id FROM kept{i}" for i in range(1, BATCHES + 1))
    clicks = CLICKS.replace("user_id,\n", "user_id, event_id,\n", 1)
    return f"""WITH {clicks}, {", ".join(ctes)}, ranked AS (
  SELECT day, province, ad_id, count(*) AS n,
         CAST(row_number() OVER (PARTITION BY day, province ORDER BY count(*) DESC, ad_id) AS INTEGER) AS rank
  FROM ({kept}) GROUP BY day, province, ad_id)
SELECT * FROM ranked WHERE rank <= 5"""


@query("ad_click_job", _replayed_sql())
def ad_click_job(t):
    """The whole per-batch job over a stream of several files; returns the stored province ranking.

    Users listed in one batch are dropped from the next, and folders are folded on the way.
    """
    own = S.stream_session(t.spark)
    tables = S.new_tables(t.spark)
    path = scratch_path(t.spark, "files")
    make_folder(t.spark, path)
    events = t.read("events")
    job = S.ClickJob(tables, threshold=THRESHOLD, compact_every=2)
    stream = C.parse(t.click_text(readers.file_stream(own, path, events.schema, "*.parquet")))
    checkpoint = scratch_path(t.spark, "checkpoint")
    for i in range(BATCHES):  # the job goes on from its checkpoint each time a file has come
        events.where(F.col("event_id") % BATCHES == i).write.mode("append").parquet(path)
        S.run_to_end(job.start(stream, checkpoint))
    return tables.top_ads.current()
