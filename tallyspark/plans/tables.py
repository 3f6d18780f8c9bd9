"""Logical tables derived from the stored ones, lazily and in proportion to them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import net
from ..operators import clicks as C
from ..session import configure, materialise
from ..sources import readers

# The age codes of the rating data.
AGE_CODES = [1, 18, 25, 35, 45, 50, 56]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ratings: one line is one rating by a supplier's account of a part

    @cached_property
    def ratings(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
            F.col("l_shipdate").alias("ts"),
        )

    @cached_property
    def users(self) -> DataFrame:
        ages = F.array(*[F.lit(a) for a in AGE_CODES])
        return self.read("supplier").select(
            F.col("s_suppkey").alias("user_id"),
            F.when(F.col("s_suppkey") % 2 == 0, "M").otherwise("F").alias("gender"),
            F.get(ages, (F.col("s_suppkey") % 7).cast("int")).alias("age"),
            F.col("s_nationkey").alias("occupation_id"),
        )

    @cached_property
    def movies(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genres"),
        )

    @cached_property
    def occupations(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("occupation")
        )

    # behaviour: events are the access log, customers the accounts

    @cached_property
    def access_log(self) -> DataFrame:
        return (
            self.read("events")
            .where(F.col("event_type").isin("view", "click", "purchase"))
            .select(
                F.col("event_id").alias("log_id"),
                "user_id",
                F.col("ts").alias("time"),
                F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("typed"),
                F.col("value").alias("consumed"),
            )
        )

    @cached_property
    def people(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        """People with the time of their first sign-up."""
        first = (
            self.read("events")
            .where(F.col("event_type") == "signup")
            .groupBy("user_id")
            .agg(F.min("ts").alias("registered"))
        )
        return first.join(self.people.select("user_id", "name"), "user_id")

    @cached_property
    def scores(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("score_id"),
            F.col("o_custkey").alias("user_id"),
            F.floor(F.col("o_totalprice") / 5000).alias("score"),
        )

    @cached_property
    def device_log(self) -> DataFrame:
        return self.read("events").select(
            "user_id",
            F.regexp_extract("props", r"(\d+)", 1).cast("long").alias("item"),
            F.concat(F.lit("device-"), F.col("event_type")).alias("device"),
        )

    # clicks, as the tab-separated text a producer would send

    @staticmethod
    def click_text(events: DataFrame) -> DataFrame:
        user, event = F.col("user_id"), F.col("event_id")
        return events.where(F.col("event_type").isin("click", "view")).select(
            F.concat_ws(
                "\t",
                F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
                F.concat(F.lit("192.168.112."), (event % 12 + 239).cast("string")),
                user.cast("string"),
                F.regexp_extract("props", r"(\d+)", 1),
                F.concat(F.lit("province-"), (user % 5).cast("string")),
                F.concat(F.lit("city-"), (user % 25).cast("string")),
            ).alias("value")
        )

    @cached_property
    def click_lines(self) -> DataFrame:
        return self.click_text(self.read("events"))

    @cached_property
    def clicks(self) -> DataFrame:
        return C.parse(self.click_lines)

    def click_stream(self, spark: SparkSession, files_per_trigger: int | None = None) -> DataFrame:
        """The clicks as a stream over the files of the events table."""
        events = readers.file_stream(
            spark, self.dir, self.read("events").schema, glob="events.parquet",
            files_per_trigger=files_per_trigger,
        )
        return C.parse(self.click_text(events))

    # addresses: a block of 4096 for each supplier, and wide blocks for the regions

    @cached_property
    def ips(self) -> DataFrame:
        num = F.lit(167772160) + (F.col("event_id") * 7919) % 1048576
        return self.read("events").select("event_id", net.long_to_ip(num.cast("long")).alias("ip"))

    @cached_property
    def ip_ranges(self) -> DataFrame:
        base = F.col("s_suppkey") * 4096 + 167772160
        narrow = self.read("supplier").select(
            base.alias("lo"),
            (base + 4095 - F.col("s_suppkey") % 3 * 1000).alias("hi"),
            F.concat(F.lit("place-"), F.col("s_nationkey").cast("string")).alias("location"),
            F.concat(F.lit("isp-"), (F.col("s_suppkey") % 3).cast("string")).alias("isp"),
        )
        wide_base = F.col("r_regionkey").cast("long") * 131072 + 167772160
        wide = self.read("region").select(
            wide_base.alias("lo"),
            (wide_base + 131071).alias("hi"),
            F.col("r_name").alias("location"),
            F.lit("isp-wide").alias("isp"),
        )
        return narrow.unionByName(wide)

    # port traffic and port locations

    @cached_property
    def traffic_lines(self) -> DataFrame:
        user = F.col("user_id")
        s = lambda c: c.cast("string")
        hour = F.date_format("ts", "HH:mm")
        return self.read("events").select(
            F.concat(
                F.lit("PonPort,area,OLT "), s(user),
                F.lit(",EPON 0/"), s(user % 4), F.lit("/"), s(user % 8),
                F.lit(","), hour, F.lit(" -"), hour,
                F.lit(","), s(F.col("event_id") % 100), F.lit(","), s(F.col("event_id") % 7),
                F.lit(","), s(user % 10), F.lit(","), s(user % 3),
            ).alias("value")
        )

    @cached_property
    def locations(self) -> DataFrame:
        key = F.col("c_custkey")
        s = lambda c: c.cast("string")
        return self.read("customer").select(
            F.concat(F.lit("OLT"), s(key), F.lit("|0"), s(key % 4), F.lit("|0"), s(key % 8)).alias("olt_port"),
            F.concat(s(key * 37 % 360 - 180), F.lit(":"), s(key * 53 % 160 - 80)).alias("ad_location"),
        )

    @cached_property
    def log_lines(self) -> DataFrame:
        """A log line per event, made of the event's own values; each kind of line has its type of event."""
        text = lambda c: c.cast("string")
        user, event = text(F.col("user_id")), text(F.col("event_id"))
        four = F.concat_ws(" ", F.date_format("ts", "yyyy/MM/dd HH:mm"), F.concat(F.lit("u"), user), F.col("event_type"))
        spent = F.concat(F.lit(" >>>> shelf"), text(F.col("user_id") % 9), F.lit(" >>>> ["), event, F.lit("]t"))
        code = F.lpad(text(F.col("user_id") % 100000), 5, "0")
        refused = F.concat(F.lit(" <response><head><errCode>"), code, F.lit("</errCode><errDesc>row: r"), event)
        kinds = {
            "view": F.concat(four, F.lit(" : v -- item:"), event, F.lit(" looked"), spent),
            "signup": F.concat(four, F.lit(" : s -- door"), spent),
            "click": F.concat(four, F.lit(" again : c -- ad:"), event, F.lit(",banner not shown"), refused),
            "purchase": F.concat(four, F.lit(" : p -- basket:"), event, F.lit(",card not taken"), refused),
        }
        line = F
        for kind, value in kinds.items():
            line = line.when(F.col("event_type") == kind, value)
        return self.read("events").select("event_id", line.otherwise(F.concat(four, F.lit(" beat "), event)).alias("value"))

    # seasons: a supplier's lines of one year; lines before its debut count in the debut year

    @cached_property
    def seasons(self) -> DataFrame:
        line = self.read("lineitem").select(
            "l_suppkey", F.greatest(F.year("l_shipdate"), F.col("l_suppkey") % 4 + 1995).cast("int").alias("year"), "l_quantity", "l_returnflag", "l_discount",
            "l_tax", "l_linestatus", "l_linenumber",
        )
        big = F.col("l_quantity") > 25
        three, free = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"

        def n(condition):
            return F.count(F.when(condition, 1)).cast("double")

        counted = (
            line.groupBy("l_suppkey", "year")
            .agg(
                F.count("*").cast("double").alias("FGA"),
                n(big).alias("FG"),
                n(three).alias("3PA"),
                n(three & big).alias("3P"),
                n(free).alias("FTA"),
                n(free & big).alias("FT"),
                n(F.col("l_discount") >= 0.08).alias("ORB"),
                n(F.col("l_discount") <= 0.02).alias("DRB"),
                n(F.col("l_tax") <= 0.03).alias("AST"),
                n(F.col("l_tax") == 0).alias("STL"),
                n((F.col("l_linestatus") == "O") & (F.col("l_quantity") <= 5) & (F.col("year") > 1996)).alias("BLK"),
                n(F.col("l_quantity") < 10).alias("TOV"),
                n(F.col("l_linenumber") > 5).alias("PF"),
            )
        )

        def share(a, b):
            return F.coalesce(F.try_divide(a, b), F.lit(0.0))

        c = F.col
        full = counted.select(
            "year",
            F.concat(F.lit("player-"), c("l_suppkey").cast("string")).alias("name"),
            F.lit("C").alias("position"),
            (c("l_suppkey") % 7 + 20 + c("year") - 1995).cast("int").alias("age"),
            F.lit("team").alias("team"),
            c("FGA").cast("int").alias("gp"),
            F.lit(0).alias("gs"),
            c("FG").alias("mp"),
            "FG", "FGA", share(c("FG"), c("FGA")).alias("FG%"),
            "3P", "3PA", share(c("3P"), c("3PA")).alias("3P%"),
            (c("FG") - c("3P")).alias("2P"), (c("FGA") - c("3PA")).alias("2PA"),
            share(c("FG") - c("3P"), c("FGA") - c("3PA")).alias("2P%"),
            share(c("FG") + c("3P") * 0.5, c("FGA")).alias("eFG%"),
            "FT", "FTA", share(c("FT"), c("FTA")).alias("FT%"),
            "ORB", "DRB", (c("ORB") + c("DRB")).alias("TRB"),
            "AST", "STL", "BLK", "TOV", "PF",
            ((c("FG") - c("3P")) * 2 + c("3P") * 3 + c("FT")).alias("PTS"),
        )
        return full

    def stored_seasons(self) -> DataFrame:
        """The seasons written once; the rating passes over them read the stored rows."""
        return materialise(self.seasons)

    # graph: each line links its part to the part its order stands for

    @cached_property
    def vertices(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("age")
        )

    @cached_property
    def edges(self) -> DataFrame:
        """Distinct (src, dst) with the number of lines as ``attr``.

        An order stands for the part numbered by its key modulo the number of parts, so the
        edges follow from one pass over the lines, one per line before they are counted.
        """
        parts = self.read("part").agg(F.max("p_partkey") + 1).scalar()
        return (
            self.read("lineitem")
            .select(F.col("l_partkey").alias("src"), (F.col("l_orderkey") % parts).alias("dst"))
            .groupBy("src", "dst")
            .agg(F.count("*").alias("attr"))
        )

    # records with a unique id in user order

    @cached_property
    def history(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("seq_ts"),
            F.col("o_orderkey").alias("rec_id"),
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.read("embeddings")
