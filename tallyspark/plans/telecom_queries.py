"""Address, location, log and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, net, text
from ..operators import telecom
from ..sources import readers, writers
from .registry import query

IPS = """
ips AS (
  SELECT event_id, num, (num >> 24) || '.' || ((num >> 16) & 255) || '.' || ((num >> 8) & 255) || '.' || (num & 255) AS ip
  FROM (SELECT event_id, 167772160 + event_id * 7919 % 1048576 AS num FROM events)),
ranges AS (
  SELECT 167772160 + s_suppkey * 4096 AS lo, 167772160 + s_suppkey * 4096 + 4095 - s_suppkey % 3 * 1000 AS hi,
         'place-' || s_nationkey AS location, 'isp-' || s_suppkey % 3 AS isp FROM supplier
  UNION ALL
  SELECT 167772160 + r_regionkey * 131072, 167772160 + r_regionkey * 131072 + 131071, r_name, 'isp-wide' FROM region)
"""


@query("ip_to_long", f"WITH {IPS} SELECT event_id, ip, num AS ip_num FROM ips")
def ip_to_long(t):
    return t.ips.withColumn("ip_num", net.ip_to_long(F.col("ip")))


@query(
    "ip_location_counts",
    f"""
WITH {IPS}, matched AS (
  SELECT event_id, location, isp,
         row_number() OVER (PARTITION BY event_id ORDER BY hi - lo, lo, location, isp) AS rn
  FROM ips JOIN ranges ON num BETWEEN lo AND hi)
SELECT location, isp, count(*) AS n FROM matched WHERE rn = 1 GROUP BY location, isp
""",
)
def ip_location_counts(t):
    ips = t.ips.select(net.ip_to_long(F.col("ip")).alias("ip_num"))
    return telecom.ip_location_counts(ips, t.ip_ranges)


@query(
    "geo_enrich",
    """
WITH places AS (
  SELECT c_custkey, 'OLT' || c_custkey || '|0' || c_custkey % 4 || '|0' || c_custkey % 8 AS olt_port,
         c_custkey * 37 % 360 - 180 AS lon, c_custkey * 53 % 160 - 80 AS lat FROM customer)
SELECT olt_port, 'OLT' || c_custkey AS site, strftime(ts, '%H:%M') AS first_time,
       CAST(event_id % 100 AS DOUBLE) AS in_mbps, CAST(event_id % 7 AS DOUBLE) AS in_avg,
       CAST(user_id % 10 AS DOUBLE) AS out_mbps, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat,
       round(lon * 20037508.34 / 180, 3) AS x,
       round(ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180, 3) AS y
FROM events JOIN places ON user_id = c_custkey
""",
)
def geo_enrich(t):
    writers.views({"tally_port_location": t.locations})
    located = telecom.geo_enrich(
        telecom.parse_traffic(t.traffic_lines), readers.catalog_table(t.spark, "tally_port_location")
    )
    return located.select(
        "olt_port", "site", "first_time", "in_mbps", "in_avg", "out_mbps", "lon", "lat",
        F.round("x", 3).alias("x"), F.round("y", 3).alias("y"),
    )


@query(
    "mercator",
    """
WITH places AS (
  SELECT c_custkey, c_custkey * 37 % 3600 / 10e0 - 180 AS lon, c_custkey * 53 % 1600 / 10e0 - 80 AS lat FROM customer)
SELECT c_custkey, round(lon * 20037508.34 / 180, 3) AS x,
       round(ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180, 3) AS y,
       printf('%.4f', lon * 20037508.34 / 180) AS x_text
FROM places
""",
)
def mercator(t):
    key = F.col("c_custkey")
    lon, lat = key * 37 % 3600 / F.lit(10.0) - 180, key * 53 % 1600 / F.lit(10.0) - 80
    return t.read("customer").select(
        "c_custkey",
        F.round(geo.mercator_x(lon), 3).alias("x"),
        F.round(geo.mercator_y(lat), 3).alias("y"),
        geo.fixed_text(geo.mercator_x(lon), 4).alias("x_text"),
    )


@query(
    "log_classify",
    """
SELECT event_id,
       CASE event_type WHEN 'signup' THEN 'auth_time' WHEN 'purchase' THEN 'invoice_error'
            WHEN 'view' THEN 'order_time' ELSE 'account_error' END AS kind,
       CASE WHEN event_type IN ('signup', 'view') THEN event_id END AS elapsed_ms,
       CASE WHEN event_type IN ('click', 'purchase') THEN lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') END AS error_code
FROM events WHERE event_type <> 'error'
""",
)
def log_classify(t):
    return telecom.classify_log(t.log_lines).drop("value")


@query(
    "word_count",
    """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""",
)
def word_count(t):
    return telecom.word_count(t.read("documents"), "text")


@query(
    "label_from_path",
    r"""
SELECT page_id, regexp_extract(url, '([^/]+)/[^/]*$', 1) AS folder,
       CASE regexp_extract(url, '([^/]+)/[^/]*$', 1)
            WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 END AS label
FROM pages
""",
)
def label_from_path(t):
    classes = {"en": 0, "fr": 1, "de": 2, "es": 3}
    return t.read("pages").select(
        "page_id",
        text.parent_folder(F.col("url")).alias("folder"),
        text.label_from_path(F.col("url"), classes).alias("label"),
    )
