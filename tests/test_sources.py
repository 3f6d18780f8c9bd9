"""Readers and writers on the small documented layouts."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators import commerce, telecom
from tallyspark.sources import readers, writers


def test_multi_character_separator(spark, tmp_path):
    (tmp_path / "users.dat").write_text("1::F::1::10:: 48067\n2 ::M::56::16::70072\n")
    schema = "user_id long, gender string, age int, occupation int, zip string"
    df = readers.delimited(spark, str(tmp_path), T.StructType.fromDDL(schema))
    assert rows(df) == [(1, "F", 1, 10, "48067"), (2, "M", 56, 16, "70072")]


def test_dynamic_schema():
    schema = readers.double_schema("port, in, out", ["in", "out"])
    assert [f.dataType.simpleString() for f in schema] == ["string", "double", "double"]


def test_text_lines_partitions(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    df = readers.text_lines(spark, str(tmp_path), 3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 2


def test_json_with_leading_zeros_and_bad_dates(spark, tmp_path):
    (tmp_path / "log.json").write_text(
        '{"logID": 00,"userID": 4, "time": "2016-10-04 15:42:45", "typed": 0, "consumed": 0.0}\n'
        '{"logID": 01,"userID": 5, "time": "2016-10-00 15:42:45", "typed": 1, "consumed": 3.5}\n'
    )
    schema = T.StructType.fromDDL("logID long, userID long, time string, typed long, consumed double")
    df = readers.json_lines(spark, str(tmp_path), schema)
    when = df.select("logID", F.try_to_timestamp("time").alias("t")).where(F.col("t").isNotNull())
    assert df.count() == 2 and [r.logID for r in when.collect()] == [0]
    inferred = readers.json_lines(spark, str(tmp_path))
    assert dict(inferred.dtypes)["consumed"] == "double"


def test_json_strings(spark):
    df = spark.createDataFrame([('{"name":"Michael","age":20}',), ('{"name":"Andy","age":17}',)], "value string")
    assert rows(readers.json_strings(df, "value", "name string, age int")) == [("Andy", 17), ("Michael", 20)]


HEADER = "Rk,Player,Pos,Age,Tm,G,GS,MP,FG,FGA,FG%,3P,3PA,3P%,2P,2PA,2P%,eFG%,FT,FTA,FT%,ORB,DRB,TRB,AST,STL,BLK,TOV,PF,PTS"


def test_season_files(spark, tmp_path):
    (tmp_path / "leagues_1970_per_game.csv").write_text(
        f"\n{HEADER}\n1,First Player*,C,24,SEA,61,,20.9,4.3,9.8,.441,,,,4.3,9.8,.441,.441,2.3,3.1,.739,,,7.7,0.7,,,,1.9,10.9\n{HEADER}\n"
    )
    (tmp_path / "leagues_1971_per_game.csv").write_text(
        f"{HEADER}\n7,Second Player,F,30,NYK,50,2,30,5,10,.5,,,,5,10,.5,.5,1,2,.5,,,8,3,,,,2,11\n"
    )
    df = readers.season_csv(spark, str(tmp_path / "leagues_*.csv"))
    got = {r["name"]: r for r in df.collect()}
    assert set(got) == {"First Player", "Second Player"}
    first = got["First Player"]
    assert (first.year, first.age, first.gs, first["3P"], first.TRB, first.PTS) == (1970, 24, 0, 0.0, 7.7, 10.9)
    assert got["Second Player"].year == 1971


def test_gbk_text(spark, tmp_path):
    lines = ["2017-01-15 17:47:56,242 流水号:1 账户不存在", 'plain "quoted" text, with commas']
    (tmp_path / "log").write_bytes("\n".join(lines).encode("gbk"))
    assert rows(readers.encoded_text(spark, str(tmp_path / "log"))) == sorted((x,) for x in lines)


def test_edge_list(spark, tmp_path):
    (tmp_path / "g.txt").write_text("# comment\n0\t11342\n5 3\n\n")
    assert rows(readers.edge_list(spark, str(tmp_path))) == [(0, 11342, 1), (5, 3, 1)]
    assert rows(readers.edge_list(spark, str(tmp_path), canonical=True, partitions=2)) == [(0, 11342, 1), (3, 5, 1)]


def test_managed_table(spark):
    writers.managed_table(spark.range(3), "tally_numbers")
    assert readers.catalog_table(spark, "tally_numbers").count() == 3
    spark.sql("DROP TABLE tally_numbers")


def test_libsvm(spark, tmp_path):
    (tmp_path / "d.txt").write_text("1 1:0.5 3:1.5\n0 2:2.0\n")
    df = readers.libsvm(spark, str(tmp_path / "d.txt"), 4)
    assert df.count() == 2 and df.first().features.size == 4


def test_image_folder(spark, tmp_path):
    for name in ("roses", "tulips"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.jpg").write_bytes(b"\xff\xd8")
        (tmp_path / name / "notes.txt").write_text("x")
    df = readers.image_files(spark, str(tmp_path))
    assert sorted(r.class_name for r in df.collect()) == ["roses", "tulips"]


def test_jdbc_options():
    read = readers.jdbc_options("jdbc:x", "t", "id", (0, 100), 8)
    assert read["numPartitions"] == "8" and read["upperBound"] == "100" and read["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")
    assert writers.jdbc_options("jdbc:x", "t", 500, 4)["batchsize"] == "500"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    writers.text_dir(df, str(tmp_path / "t"), files=1)
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("a\t1",), ("b\t2",)]
    writers.parquet_dir(df, str(tmp_path / "p"), partitions=2, row_group_bytes=1 << 16)
    assert rows(readers.parquet(spark, str(tmp_path / "p"))) == [("a", 1), ("b", 2)]
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 2
    writers.json_dir(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_views(spark):
    writers.views({"v_local": spark.range(2)}, {"v_shared": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM v_local").first()[0] == 2
    assert spark.newSession().sql("SELECT count(*) FROM global_temp.v_shared").first()[0] == 3


def test_ip_lookup(spark):
    lib = [
        "010.001.000.000\t010.001.003.255\tnorth\tnet-a",
        "010.002.000.000\t010.002.000.255\teast\tnet-a",
        "010.002.004.000\t010.002.007.255\tsouth\tnet-b",
        "172.016.000.000\t172.031.255.255\tsouth\tnet-b",
    ]
    ranges = telecom.parse_ranges(spark.createDataFrame([(x,) for x in lib], "value string"))
    from tallyspark.functions import net

    ips = spark.createDataFrame([("010.002.004.005",), ("10.2.3.254",), ("172.020.015.105",)], "ip string")
    nums = ips.select(net.ip_to_long(F.col("ip")).alias("ip_num"))
    assert 10 * 2**24 + 2 * 2**16 + 4 * 2**8 + 5 in [r[0] for r in nums.collect()]
    assert rows(telecom.ip_location_counts(nums, ranges)) == [("south", "net-b", 2)]


def test_range_beyond_the_address_space(spark):
    ranges = spark.createDataFrame([(-5, 2**33, "all", "x"), (7, 9, "few", "x")], "lo long, hi long, location string, isp string")
    ips = spark.createDataFrame([(0,), (8,), (2**32 - 1,)], "ip_num long")
    assert {r.ip_num: r.location for r in telecom.ip_locations(ips, ranges).collect()} == {0: "all", 8: "few", 2**32 - 1: "all"}


def test_overlapping_ranges_narrowest_wins(spark):
    ranges = spark.createDataFrame(
        [(0, 1000, "wide", "x"), (10, 20, "narrow", "x"), (15, 25, "narrow2", "x")],
        "lo long, hi long, location string, isp string",
    )
    ips = spark.createDataFrame([(5,), (12,), (17,), (24,), (5000,)], "ip_num long")
    got = {r.ip_num: r.location for r in telecom.ip_locations(ips, ranges).collect()}
    assert got == {5: "wide", 12: "narrow", 17: "narrow", 24: "narrow2"}


def test_ranges_of_all_widths_against_brute_force(spark):
    rnd = random.Random(3)
    ranges = [(0, 2**32 - 1), (0, 0), (2**32 - 1, 2**32 - 1), (15, 16), (2**20 - 1, 2**20)]
    for bits in range(33):
        lo = rnd.randrange(2**32)
        ranges.append((lo, min(lo + 2**bits - 1, 2**32 - 1)))
        ranges.append((lo, min(lo + 2**bits, 2**32 - 1)))
    table = [(lo, hi, f"r{i}", "x") for i, (lo, hi) in enumerate(ranges)]
    ips = [x for lo, hi in ranges for x in (lo, hi, max(lo - 1, 0), min(hi + 1, 2**32 - 1))]
    want = {}
    for ip in ips:
        inside = [(hi - lo, lo, name) for lo, hi, name, _ in table if lo <= ip <= hi]
        want[ip] = min(inside)[2]
    got = telecom.ip_locations(
        spark.createDataFrame([(x,) for x in ips], "ip_num long"),
        spark.createDataFrame(table, "lo long, hi long, location string, isp string"),
    )
    assert {r.ip_num: r.location for r in got.collect()} == want


def test_log_lines(spark):
    """Lines put together from the fields that each kind has, in every order and with fields missing."""
    head, spent = ["a", "b", "c", "d"], [">>>>", "e", ">>>>", "[8]f"]
    refused = ["g", "h", "i<response><head><errCode>42</errCode><errDesc>j:", "k"]
    made = {
        "order_time": [*head, ":", "l", "--", "m:n", "o", *spent],
        "account_error": [*head, "p", ":", "l", "--", "m:n,q", *refused],
        "auth_time": [*head, ":", "l", "--", "m", *spent],
        "invoice_error": [*head, ":", "l", "--", "m:n,q", *refused],
    }
    lines = {kind: " ".join(fields) for kind, fields in made.items()}
    others = [" ".join(f for f in made[k] if f != gone) for k, gone in (("order_time", "--"), ("auth_time", ">>>>"), ("invoice_error", "k"), ("account_error", ":"))]
    df = telecom.classify_log(spark.createDataFrame([(x,) for x in [*others, *lines.values(), ""]], "value string"))
    got = {r.kind: (r.value, r.elapsed_ms, r.error_code) for r in df.collect()}
    assert df.count() == 4 and {k: v[0] for k, v in got.items()} == lines
    assert {k: v[1:] for k, v in got.items()} == {
        "order_time": (8, None), "auth_time": (8, None), "account_error": (None, "42"), "invoice_error": (None, "42"),
    }


def test_port_traffic(spark):
    line = "PonPort, area, site A/device, EPON 0/1/0, 08:00 - 09:00, 1, 2, 3.5, 4"
    traffic = telecom.parse_traffic(spark.createDataFrame([(line,)], "value string"))
    r = traffic.first()
    assert (r.port_key, r.first_time, r.in_mbps, r.out_avg) == ("siteA/device|01|00", "08:00", 1.0, 4.0)
    places = spark.createDataFrame([("siteA/device|01|00", "121.5:31.2")], "olt_port string, ad_location string")
    g = telecom.geo_enrich(traffic, places).first()
    assert g.x == pytest.approx(13525318.1295) and g.y == pytest.approx(3658750.2797737)
    assert "port_key" not in g.asDict()


def test_first_days_window_is_inclusive(spark):
    from datetime import datetime as dt

    log = spark.createDataFrame(
        [
            (1, 7, dt(2016, 10, 3, 12), 0, 0.0),
            (2, 7, dt(2016, 10, 3, 8), 0, 0.0),
            (3, 7, dt(2016, 10, 17, 23), 0, 0.0),
            (4, 7, dt(2016, 10, 18, 0), 0, 0.0),
            (5, 8, dt(2016, 10, 4), 0, 0.0),
        ],
        "log_id long, user_id long, time timestamp_ntz, typed int, consumed double",
    )
    accounts = spark.createDataFrame(
        [(7, "g", dt(2016, 10, 3, 9)), (8, "h", dt(2016, 11, 1))], "user_id long, name string, registered timestamp_ntz"
    )
    got = commerce.first_days(log, accounts, ("2016-10-01", "2016-10-15"), F.count("log_id"))
    assert rows(got) == [(7, "g", 2)]
