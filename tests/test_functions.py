import random

import pytest
from pyspark.sql import functions as F

from hitledger.functions import domains, net, times, urls
from hitledger.functions.sql_names import register_sql_functions
from hitledger.sources.dimensions import as_suffix_lists
from hitledger.sources.demo import FOREIGN, SUFFIXES

TOP = {
    "baidu.com": "baidu.com", "www.baidu.com": "baidu.com", "abc.cn": "abc.cn", "abc.js.cn": "abc.js.cn",
    "x.abc.js.cn": "abc.js.cn", "sina.com.cn": "sina.com.cn", "a.com.": "a.com", "com.cn": "-1.com.cn",
    "a.com:80": "", "1.2.3.4": "", "localhost": "", "com": "", "bad host!": "-1", "x.ru": "",
    ".com": ".com", "...": "", "": "-1", " a.com": " a.com", "a.com ": "", "a.com\t": "", "a..cn": ".cn",
    "a.com\n": "", "x y.com": "-1", "café.com": "-1",
}
IP = {
    "1.2.3.4": 16909060, "300.0.0.1": 5033164801, None: 0, "": 0, "1.2.3": 0, "1.2.3.4.5": 0, "a.b.c.d": 0,
    " 1.2.3.4": 0, "1.2.3.": 0, "-1.2.3.4": -16645372, "99999999999999999999.1.1.1": 0, "010.0.0.1": 167772161,
}


def _top_brute(domain):
    trimmed = domain.strip("".join(map(chr, range(33))))
    if not trimmed or any(not (c.isascii() and (c.isalnum() or c in "_-:.")) for c in trimmed):
        return "-1"
    labels = domain.split(".")
    while labels and labels[-1] == "":
        labels.pop()
    if len(labels) < 2:
        return ""
    third = labels[-3] if len(labels) > 2 else "-1"
    second, first = labels[-2:]
    if first in SUFFIXES.generic:
        return f"{second}.{first}"
    if first in SUFFIXES.country:
        deep = second in SUFFIXES.generic or f"{second}.{first}" in SUFFIXES.area
        return f"{third}.{second}.{first}" if deep else f"{second}.{first}"
    return ""


def _random_domains(n=600):
    rng = random.Random(7)
    parts = ["a", "www", "com", "net", "cn", "js", "ru", "b-c", "x_y", "9", "", "com:80", "é", " "]
    return [".".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(n)]


def test_top_domain(spark):
    cases = {**TOP, **{d: _top_brute(d) for d in _random_domains()}}
    df = spark.createDataFrame(list(cases.items()), "domain string, want string")
    table = spark.createDataFrame(
        [("in", v) for v in SUFFIXES.generic] + [("area", "js.cn"), ("country", "cn"), ("country", "cn")],
        "kind string, value string",
    )
    got = df.withColumn("literal", domains.top_domain("domain", SUFFIXES))
    got = domains.add_top_domain(got, table, out="joined")
    assert got.count() == df.count()
    assert got.where("literal <> want or joined <> want").collect() == []
    assert all(_top_brute(d) == want for d, want in TOP.items())


def test_foreign(spark):
    cases = {"a.ru": 1, "a.ru:8080": 1, "ru": 0, "a.com": 0, "1.2.3.4": 0, "a.ru:": 0, "a.ru.": 0, ".ru": 1}
    df = spark.createDataFrame(list(cases.items()), "domain string, want int")
    assert df.where(domains.is_foreign("domain", FOREIGN) != F.col("want")).collect() == []
    assert df.where(domains.is_foreign("domain", []) != 0).collect() == []
    table = spark.createDataFrame([("ru",), ("ru",), ("",)], "suffix string")
    joined = domains.add_foreign(df, table)
    assert joined.count() == df.count() and joined.where("isforeign <> want").collect() == []


def test_ip_to_long(spark):
    df = spark.createDataFrame(list(IP.items()), "ip string, want bigint")
    assert df.where(net.ip_to_long("ip") != F.col("want")).collect() == []
    assert all(net.ip_value(ip) == want for ip, want in IP.items())


def test_sql_names(spark):
    register_sql_functions(spark, SUFFIXES, FOREIGN)
    row = spark.sql("select ip2long('1.2.3.4'), topDomain('x.abc.js.cn'), foreignDomain('a.ru:1')").first()
    assert tuple(row) == (16909060, "abc.js.cn", 1)


def test_sql_names_with_long_lists(spark):
    kinds = [("in", f"s{i}") for i in range(2500)] + [("country", "cn"), ("area", "js.cn"), ("in", "com")]
    suffixes = as_suffix_lists(spark.createDataFrame(kinds, "kind string, value string"))
    foreign = spark.createDataFrame([(f"f{i}",) for i in range(2500)] + [("ru",)], "suffix string")
    register_sql_functions(spark, suffixes, foreign)
    row = spark.sql("select topDomain('a.b.s77'), topDomain('x.abc.js.cn'), foreignDomain('a.f9'), foreignDomain('a.com')").first()
    assert tuple(row) == ("b.s77", "abc.js.cn", 1, 0)


def test_epoch_text(spark):
    cases = {"1705312922": "2024-01-15 10:02:02", "abc": None, " 12": None, "": None, "-5": "1969-12-31 23:59:55",
             "00000000000001705312922": "2024-01-15 10:02:02",
             "1704067200000": "55969-09-28 00:00:00", "99999999999999999999": None}
    df = spark.createDataFrame(list(cases.items()), "s string, want string")
    got = df.select("want", times.epoch_text(F.col("s"), "UTC").alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)
    row = df.where("s = '1705312922'").select(
        times.epoch_text(F.col("s")).alias("session"), times.epoch_text(F.col("s"), "Asia/Shanghai").alias("named"),
        times.day_of(F.col("want")), times.hour_of(F.col("want")), times.five_minutes_of(F.col("want")),
    ).first()
    assert tuple(row) == ("2024-01-15 18:02:02", "2024-01-15 18:02:02", "240115", "10", "00")


def test_far_times_have_parts(spark):
    """Parts are cut out of the text by place; a text without a digit at the minute's place is unreadable."""
    far = spark.createDataFrame([("1704067200000",), ("5000000000000",), ("9223372036854775807",), ("253402300800",)], "s string")
    text = times.epoch_text(F.col("s"), "UTC").alias("t")
    got = far.select("s", text).select("s", "t", times.day_of(F.col("t")), times.hour_of(F.col("t")), times.five_minutes_of(F.col("t"))).collect()
    rows = {r.s: tuple(r)[1:] for r in got}
    assert rows["1704067200000"] == ("55969-09-28 00:00:00", "969092", " 0", ":0")
    assert rows["253402300800"][0] == "10000-01-01 00:00:00"
    assert rows["5000000000000"][0] is None
    assert rows["9223372036854775807"][0] is None


def test_bucket_of_parameter():
    assert times.bucket_of(times.parse_param("202302281934")) == {"d": "230228", "h": "19", "m5": "30"}
    assert times.parse_param("2023-02-28 19:34:09") == times.parse_param("20230228193409")


def test_base64_url(spark):
    url = "http://pages.example.org:8081/list?from=20&to=40"
    encoded = "aHR0cDovL3BhZ2VzLmV4YW1wbGUub3JnOjgwODEvbGlzdD9mcm9tPTIwJnRvPTQw"
    assert urls.encode_literal(url) == encoded
    df = spark.createDataFrame([(url,), (url * 5,), ("é",)], "url string").withColumn("b", urls.encode(F.col("url")))
    assert df.where(urls.decode(F.col("b")) != F.col("url")).count() == 0
    assert df.where(F.col("b").contains("\n")).count() == 0
    assert spark.range(1).select(urls.decode(F.lit("%%%"))).first()[0] is None


@pytest.mark.parametrize("hours, want", [(None, "2024-01-01 00:00:00"), (2, "2024-01-01 08:00:00"), (99, "2024-01-01 00:00:00")])
def test_lookback(hours, want):
    begin, end = times.parse_param("20240101"), times.parse_param("2024010110")
    assert times.text_of(times.clip_lookback(begin, end, hours)) == want
