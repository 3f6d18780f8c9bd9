"""Removal of boilerplate lines by the number of distinct sites they appear on.

A line is compared by a 128-bit hash of its trimmed text. One sketch (HyperLogLog) of sites per line
hash, merged by aggregation, estimates the spread of every line that occurs often enough to reach the
threshold. Lines whose estimate is within the sketch's error of the threshold are counted exactly.
A line on at least ``min_sites`` sites is boilerplate: the row with the smallest doc_id keeps its first
occurrence, so that a text is not lost with its copies; all others go.

Defined results: a null text stays null and an empty one empty; blank lines are never removed; a null
site is no site; among repeated rows of the smallest doc_id, each keeps the line; an empty table gives
no rows; rows without a doc_id come last, and a line that only they have stays in each; further columns
are kept, and the working columns have names of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

MIN_SITES = 8
LOG_K = 10
ERRORS = 4  # standard errors of the sketch on either side of the threshold


def line_key(line: Column) -> Column:
    """A 128-bit hash of the trimmed line; null for a blank one."""
    trimmed = F.btrim(line, F.lit(" \t\r\x0b\f"))
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(trimmed, F.lit(1)).alias("b")))


def occurrences(docs: DataFrame, text: str, doc_id: str, site: str) -> DataFrame:
    """(key, id, site, place): every line that is not blank, once per row of ``docs``. ``place`` is a hash of
    the row's id and text; rows that share it are alike and lose the same lines."""
    keys = F.array_distinct(F.filter(F.transform(F.split(F.col(text), "\n"), line_key), lambda k: k.isNotNull()))
    return docs.select(_place(text, doc_id).alias("place"), F.col(doc_id).alias("id"), F.col(site).alias("site"), F.explode(keys).alias("key"))


def _place(text: str, doc_id: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """(key, first_id, sites) of the lines on at least ``min_sites`` distinct sites.

    ``sites`` is the estimate, or the exact number near the threshold. Lines seen fewer than
    ``min_sites`` times cannot qualify and get no sketch.
    """
    often = (
        lines.groupBy("key").agg(F.count("site").alias("n"), F.min("id").alias("first_id"))
        .where(F.col("n") >= min_sites).select("key", "first_id")
    )
    often = materialise(often)
    sited = lines.where(F.col("site").isNotNull())
    # a hot line leaves each task as one sketch
    estimate = materialise(
        sited.join(often.select("key"), "key", "left_semi")
        .groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"))
    )
    margin = max(1.0, ERRORS * 1.04 / math.sqrt(1 << log_k) * min_sites)
    near = F.abs(F.col("sites") - min_sites) <= margin
    # sites themselves are gathered for the lines near the threshold alone
    exact = (
        sited.join(estimate.where(near).select("key"), "key", "left_semi")
        .groupBy("key", "site").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("sites"))
    )
    spread = estimate.where(~near).unionByName(exact).where(F.col("sites") >= min_sites)
    return spread.join(often, "key").select("key", "first_id", "sites")


def remove_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, text: str = "text", doc_id: str = "doc_id", site: str = "source",
    removed: str = "removed_lines",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and their number in ``removed``."""
    lines = materialise(occurrences(docs, text, doc_id, site))  # read three times
    spread = materialise(line_spread(lines, min_sites))
    names = [c for c in docs.columns if c != removed]
    # the distinct keys of one row are at most its lines
    found = (
        lines.join(spread, "key").select("place", "key", F.col("first_id").eqNullSafe(F.col("id")).alias("keeps"))
        .distinct().groupBy("place")
        .agg(F.collect_list(F.when(~F.col("keeps"), F.col("key"))).alias("_gone"), F.collect_list(F.when(F.col("keeps"), F.col("key"))).alias("_once"))
        .withColumnRenamed("place", "_place").withColumn("_touched", F.lit(True))
    )
    joined = docs.select(*names).join(found, _place(text, doc_id) == F.col("_place"), "left")
    split = joined.withColumn("_lines", F.when(F.col("_touched"), F.split(F.col(text), "\n")))
    split = split.withColumn("_keys", F.transform("_lines", line_key))
    gone, once = F.coalesce("_gone", F.array().cast("array<struct<a:bigint,b:bigint>>")), F.coalesce("_once", F.array().cast("array<struct<a:bigint,b:bigint>>"))

    def stays(line: Column, i: Column) -> Column:
        key = F.get("_keys", i)
        repeated = F.array_contains(once, key) & (F.array_position("_keys", key) != i + 1)
        return key.isNull() | ~(F.array_contains(gone, key) | repeated)

    untouched = F.col("_touched").isNull()
    kept = split.withColumn("_kept", F.when(~untouched, F.filter("_lines", stays)))
    return kept.select(
        *[F.when(untouched, F.col(text)).otherwise(F.array_join("_kept", "\n")).alias(text) if c == text else F.col(c) for c in names],
        F.when(untouched | F.col(text).isNull(), 0).otherwise(F.size("_lines") - F.size("_kept")).cast("int").alias(removed),
    )
