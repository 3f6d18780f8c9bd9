"""IP lookup, port traffic with locations, log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, net, text



RANGE_LEVELS = range(0, 33, 4)  # bits of a bucket's width


def _bucket(number, level):
    """Key of the bucket of width 2**level that holds ``number``."""
    return F.shiftright(number, level) + F.lit(level * 2**40)


def ip_locations(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """Location of each distinct address: (ip_num, n, location, isp), unmatched ones left out.

    ``ips`` has ``ip_num``; ``ranges`` has lo, hi (inclusive, 32 bits), location, isp. Where ranges
    overlap, the narrowest wins, then the lowest start.

    The join is an equi-join on buckets. A range is listed under the buckets of the smallest
    width that is not below its own, which are at most two; an address is looked up once per
    width in use, of which there are at most nine. Equal addresses are counted before that, so
    a frequent address is one row.
    """
    # addresses have 32 bits, so what a range covers beyond them places it nowhere
    first, last = F.greatest(F.col("lo"), F.lit(0)), F.least(F.col("hi"), F.lit(2**32 - 1))
    sized = ranges.withColumn("width", F.col("hi") - F.col("lo") + 1).withColumn("first", first).withColumn("last", last)
    level = F
    for bits in RANGE_LEVELS:
        level = level.when(F.col("last") - F.col("first") < 1 << bits, F.lit(bits))
    sized = sized.withColumn("level", level)
    used = sorted(r["level"] for r in sized.select("level").distinct().collect() if r["level"] is not None)
    if not used:
        used = [RANGE_LEVELS[0]]
    counted = ips.where(F.col("ip_num").isNotNull()).groupBy("ip_num").agg(F.count("*").alias("n"))
    left = counted.withColumn("bucket", F.explode(F.array(*[_bucket("ip_num", b) for b in used])))
    touched = F
    for bits in used:
        ends = F.array(_bucket("first", bits), _bucket("last", bits))
        touched = touched.when(F.col("level") == bits, F.array_distinct(ends))
    right = sized.withColumn("bucket", F.explode(touched))
    inside = F.col("ip_num").between(F.col("lo"), F.col("hi"))
    best = F.min(F.struct("width", "lo", "location", "isp"))
    return (
        left.join(right, "bucket")
        .where(inside)
        .groupBy("ip_num", "n")
        .agg(best.alias("best"))
        .select("ip_num", "n", "best.location", "best.isp")
    )


def ip_location_counts(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    return (
        ip_locations(ips, ranges)
        .groupBy("location", "isp")
        .agg(F.sum("n").alias("n"))
    )


def parse_ranges(lines: DataFrame) -> DataFrame:
    """Ranges from tab-separated ``start, end, location, isp`` lines in column ``value``."""
    parts = F.split("value", "\t")
    return lines.where(F.trim("value") != "").select(
        net.ip_to_long(parts[0]).alias("lo"),
        net.ip_to_long(parts[1]).alias("hi"),
        F.trim(parts[2]).alias("location"),
        F.trim(parts[3]).alias("isp"),
    )


def parse_traffic(lines: DataFrame) -> DataFrame:
    """Port traffic from comma-separated lines in column ``value``.

    The port key is built from the site and the slot numbers of ``EPON 0/b/c`` without blanks.
    """
    f = F.split("value", ",")
    slots = F.split(f[3], "/")
    times = F.split(f[4], "-")
    return lines.select(
        text.remove_blanks(F.concat(f[2], F.lit("|0"), slots[1], F.lit("|0"), slots[2])).alias("port_key"),
        text.remove_blanks(times[0]).alias("first_time"),
        times[1].alias("last_time"),
        *[f[5 + i].try_cast("double").alias(c) for i, c in enumerate(["in_mbps", "in_avg", "out_mbps", "out_avg"])],
    )


def geo_enrich(traffic: DataFrame, locations: DataFrame) -> DataFrame:
    """Traffic joined to its port's location ``lon:lat`` with projected coordinates."""
    joined = traffic.join(locations, traffic["port_key"] == locations["olt_port"]).drop("port_key")
    lon_lat = F.split("ad_location", ":")
    lon, lat = lon_lat[0].try_cast("double"), lon_lat[1].try_cast("double")
    return joined.select(
        "*",
        F.split("olt_port", r"\|")[0].alias("site"),
        lon.alias("lon"),
        lat.alias("lat"),
        geo.mercator_x(lon).alias("x"),
        geo.mercator_y(lat).alias("y"),
    )


def classify_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines matching one of the known patterns, with the pattern's name and its measures.

    Exploding the present kinds keeps the matching lines and tries the patterns once per line;
    a filter on ``kind`` would make Spark try them again.
    """
    line = F.col(column)
    return (
        lines.withColumn("kind", F.explode(F.array_compact(F.array(text.log_kind(line)))))
        .withColumn("elapsed_ms", text.log_elapsed_ms(line))
        .withColumn("error_code", text.log_error_code(line))
    )


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Words by falling frequency. Counts are merged per task before the shuffle."""
    return (
        lines.select(F.explode(text.words(F.col(column))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("word"))
    )
