"""Queries over how rows are merged, ordered, placed and kept: stored states, trees, runs, partitions, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import moments, physical, runs
from ..operators import seasons as S
from ..session import materialise, scratch_path
from ..sources import readers
from .registry import query
from .season_queries import UP_TO_CHANGES, _rounded, _rounded_sql

STATE_BATCHES = 3


@query(
    "stats_merged",
    """
WITH v AS (SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS v FROM lineitem)
SELECT l_returnflag, l_linestatus, count(v) AS n, count(*) - count(v) AS missing, round(avg(v), 4) AS mean,
       round(stddev_pop(v), 4) AS stdev, min(v) AS min, max(v) AS max
FROM v GROUP BY ALL
""",
)
def stats_merged(t):
    """States of three batches, two of them folded, merged into the statistics of the whole."""
    stored = moments.StoredStates(t.spark, scratch_path(t.spark, "states"), "l_returnflag string, l_linestatus string")
    lines = t.read("lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_extendedprice")
    value = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    for i in range(STATE_BATCHES):
        stored.add(lines.where(F.pmod("l_orderkey", F.lit(STATE_BATCHES)) == i), value, i)
        stored.fold(i - 1)
    found = stored.statistics()
    return found.select("l_returnflag", "l_linestatus", "n", "missing", F.round("mean", 4).alias("mean"), F.round("stdev", 4).alias("stdev"), "min", "max")


@query("tree_total", "SELECT CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM lineitem")
def tree_total(t):
    """Cents of all lines over three levels of partial sums."""
    return physical.tree_sum(t.read("lineitem"), F.round(F.col("l_extendedprice") * 100).cast("long"), depth=3)


@query(
    "line_gaps",
    """
SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate,
       date_diff('day', lag(l_shipdate) OVER w, l_shipdate) AS days, l_quantity - lag(l_quantity) OVER w AS change
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)
""",
)
def line_gaps(t):
    """Each line against the one before of its supplier, read in runs: a supplier has many lines."""
    lines = t.read("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    found = runs.with_previous(lines, ["l_suppkey"], order, ["l_shipdate", "l_quantity"])
    return found.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate",
        F.date_diff("l_shipdate", "previous_l_shipdate").cast("long").alias("days"),
        (F.col("l_quantity") - F.col("previous_l_quantity")).alias("change"),
    )


@query(
    "season_deltas_runs",
    f"{UP_TO_CHANGES} SELECT name, year, exp, {_rounded_sql(['valueZ', 'valueN', 'deltaZ', 'deltaN'])} FROM changes",
)
def season_deltas_runs(t):
    """The seasons of each player iterated in order, without gathering a player."""
    rated = S.experience(S.normalised(t.stored_seasons())).select(
        "name", "year", "exp", F.col("zTOT").alias("valueZ"), F.col("nTOT").alias("valueN")
    )
    found = runs.changes(rated, ["name"], ["exp", "year"], ["valueZ", "valueN"])
    named = found.withColumnsRenamed({"change_valueZ": "deltaZ", "change_valueN": "deltaN"})
    return _rounded(named, ["valueZ", "valueN", "deltaZ", "deltaN"])


@query("partition_rows", "SELECT CAST(l_suppkey % 8 AS INTEGER) AS partition, count(*) AS rows FROM lineitem GROUP BY ALL")
def partition_rows(t):
    """Rows per partition once every row is where it was asked to be."""
    return physical.rows_per_partition(physical.placed(t.read("lineitem").select("l_suppkey"), 8, F.col("l_suppkey") % 8))


@query(
    "reused_totals",
    """
SELECT 'type' AS by, event_type AS key, count(*) AS n FROM events WHERE value > 0 GROUP BY ALL UNION ALL
SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*) FROM events WHERE value > 0 GROUP BY ALL
""",
)
def reused_totals(t):
    """Two results of rows that are kept in memory and on disk for the while and released."""
    with physical.kept(t.read("events").where(F.col("value") > 0).select("event_type", "ts")) as events:
        by_type = events.groupBy(F.lit("type").alias("by"), F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
        by_day = events.groupBy(F.lit("day").alias("by"), F.date_format("ts", "yyyy-MM-dd").alias("key")).agg(F.count("*").alias("n"))
        return materialise(by_type.unionByName(by_day))


PAGES_PER_FILE = 500


@query(
    "format_binary_files",
    """
SELECT 'site-' || page_id % 7 AS label, count(*) AS pages, CAST(sum(octet_length(encode(translate(html, chr(10) || chr(13), '  '))) + 1) AS BIGINT) AS bytes
FROM pages GROUP BY ALL
""",
)
def format_binary_files(t):
    """Pages in a folder per label, read back as whole files: path, length and content; the label is the folder's."""
    path = scratch_path(t.spark, "binary")
    lines = t.read("pages").select(
        F.concat(F.lit("site-"), (F.col("page_id") % 7).cast("string")).alias("label"),
        F.translate(F.coalesce("html", F.lit("")), "\n\r", "  ").alias("value"),
    )
    lines.write.partitionBy("label").option("maxRecordsPerFile", PAGES_PER_FILE).text(path)  # no file holds too much for a row
    files = readers.image_files(t.spark, path, "*.txt")
    text = F.decode("content", "UTF-8")
    pages = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))
    return (
        files.where(F.octet_length("content") == F.col("length"))
        .groupBy(F.regexp_replace("class_name", "^label=", "").alias("label"))
        .agg(F.sum(pages).alias("pages"), F.sum("length").alias("bytes"))
    )
