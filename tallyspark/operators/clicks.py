"""Ad clicks: parsing, black list, valid clicks, running totals, rankings and trend.

Every function works on a batch DataFrame; those without a window function also work on a
stream. Clicks have ts_ms, ip, user_id, ad_id, province, city, ts and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sizes import top_per_group

CLICK_KEYS = ["ts_ms", "ip", "user_id", "ad_id", "province", "city"]
TOTAL_KEYS = ["day", "ad_id", "province", "city"]


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """Clicks from tab-separated ``epoch_ms, ip, user, ad, province, city`` text."""
    f = F.split(column, "\t")
    ts = F.timestamp_millis(f[0].try_cast("long"))
    return lines.select(
        f[0].try_cast("long").alias("ts_ms"),
        f[1].alias("ip"),
        f[2].try_cast("long").alias("user_id"),
        f[3].try_cast("long").alias("ad_id"),
        f[4].alias("province"),
        f[5].alias("city"),
        ts.alias("ts"),
        F.to_date(ts).alias("day"),
    )


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the stored black list, which is read again on every use."""
    return clicks.join(blacklist, "user_id", "left_anti")


def batch_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*CLICK_KEYS).agg(F.count("*").alias("n"))


def valid_clicks(counts: DataFrame, at_most: int = 1) -> DataFrame:
    return counts.where(F.col("n") <= at_most)


def daily_user_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("day", "user_id", "ad_id").agg(F.count("*").alias("n"))


def blacklisted(user_counts: DataFrame, threshold: int = 50) -> DataFrame:
    """Users with more than ``threshold`` clicks on one ad in one day."""
    return user_counts.where(F.col("n") > threshold).select("user_id").distinct()


def running_totals(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*TOTAL_KEYS).agg(F.count("*").alias("n"))


def running_totals_by_day(clicks: DataFrame) -> DataFrame:
    """The same totals over one-day windows, whose state a watermark on ``ts`` can drop."""
    return (
        clicks.groupBy(F.window("ts", "1 day").alias("w"), "ad_id", "province", "city")
        .agg(F.count("*").alias("n"))
        .select(F.to_date("w.start").alias("day"), "ad_id", "province", "city", "n")
    )


def province_top(totals: DataFrame, n: int = 5) -> DataFrame:
    """Most clicked ads of each (day, province)."""
    by_province = totals.groupBy("day", "province", "ad_id").agg(F.sum("n").alias("n"))
    return top_per_group(by_province, ["day", "province"], [F.desc("n"), F.asc("ad_id")], n)


def minute_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("ad_id", F.date_trunc("minute", "ts").alias("minute")).agg(
        F.count("*").alias("n")
    )


def minute_windows(clicks: DataFrame) -> DataFrame:
    """The same counts over one-minute windows, whose state a watermark on ``ts`` can drop."""
    counted = clicks.groupBy(F.window("ts", "1 minute").alias("w"), "ad_id").agg(F.count("*").alias("n"))
    return counted.select("ad_id", F.col("w.start").alias("minute"), "n")


def trend(per_minute: DataFrame, length: int = 30) -> DataFrame:
    """Clicks per ad in every non-empty window of ``length`` minutes that slides by one minute.

    A minute's count enters the running total at the first window that covers it and leaves
    after the last, so two changes per (ad, minute) are moved instead of a copy per window. An
    ad has at most one row per minute here, however many clicks it gets.
    """
    minute = F.expr("interval 1 minute")
    past = F.make_dt_interval(mins=F.lit(length + 1))
    enter = F.struct((F.col("minute") + minute).alias("at"), F.col("n").alias("change"))
    leave = F.struct((F.col("minute") + past).alias("at"), (-F.col("n")).alias("change"))
    changes = (
        per_minute.repartition("ad_id")  # serves the grouping and the window below
        .select("ad_id", F.inline(F.array(enter, leave)))
        .groupBy("ad_id", "at")
        .agg(F.sum("change").alias("change"))
    )
    by_ad = Window.partitionBy("ad_id").orderBy("at")
    levels = changes.select(
        "ad_id",
        "at",
        F.sum("change").over(by_ad.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
        F.lead("at").over(by_ad).alias("until"),
    ).where(F.col("n") > 0)
    ends = F.sequence(F.col("at"), F.col("until") - minute, minute)
    return with_time_parts(levels.select("ad_id", F.explode(ends).alias("window_end"), "n"))


def with_time_parts(windows: DataFrame) -> DataFrame:
    return windows.select(
        "ad_id",
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        F.to_date("window_end").alias("day"),
        F.hour("window_end").alias("hour"),
        F.minute("window_end").alias("minute"),
        "n",
    )


def sliding_counts(clicks: DataFrame, length: str = "30 minutes", slide: str = "1 minute") -> DataFrame:
    """The same trend with Spark's sliding window, usable on a stream."""
    return (
        clicks.groupBy(F.window("ts", length, slide).alias("w"), "ad_id")
        .agg(F.count("*").alias("n"))
        .select("ad_id", F.col("w.end").alias("window_end"), "n")
    )


def sliding_from_minutes(clicks: DataFrame, length: str = "30 minutes", slide: str = "1 minute") -> DataFrame:
    """The same trend by two aggregations in a row: minutes first, then sliding windows over the minutes.

    On a stream with a watermark both are stateful. A click changes one row of the first state, and only a
    closed minute's count goes on, to as many windows as it lies in; so the second state gets a row per (ad, minute)
    and window, however many clicks there are.
    """
    minutes = clicks.groupBy(F.window("ts", "1 minute").alias("m"), "ad_id").agg(F.count("*").alias("n"))
    timed = minutes.select("ad_id", F.window_time("m").alias("at"), "n")
    return (
        timed.groupBy(F.window("at", length, slide).alias("w"), "ad_id")
        .agg(F.sum("n").alias("n"))
        .select("ad_id", F.col("w.end").alias("window_end"), "n")
    )
