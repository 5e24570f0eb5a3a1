from collections import Counter

import pytest
from conftest import SF
from helpers import bag, explained
from pyspark.sql import functions as F

from hitledger.functions.net import ip_value
from hitledger.functions.times import parse_param
from hitledger.operators import search
from hitledger.plans.search import run_line_search, run_search
from hitledger.schema import RAW_FIELDS
from hitledger.sinks.log_table import publish
from hitledger.sources import demo, tables
from hitledger.workspace import stage_dir

BEGIN, END = "2024-01-10 04:00:00", "2024-01-10 16:00:00"


@pytest.fixture(scope="module")
def root(spark, log):
    """Half a day of the log in the full 5-minute layout."""
    path = stage_dir(spark, "log")
    publish(log.where(F.col("acctime").between(BEGIN, END)).withColumn("batch", F.lit("b1")), path)
    return path


def test_buckets_are_pruned(spark, root):
    found = tables.read_access_log(spark, root, "2024-01-10 06:02:00", "2024-01-10 09:58:00")
    hits = search.search(found, "2024-01-10 06:02:00", "2024-01-10 09:58:00", srcport="1031", url="http://x")
    scan = explained(hits)
    partition_filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "concat(d" in partition_filters
    pushed = scan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "EqualTo(srcport,1031)" in pushed and "acctime" in pushed and "EqualTo(url" in pushed
    rows = [r.asDict() for r in found.collect()]
    assert rows and all("06:00:00" <= r["acctime"][11:] < "10:00:00" for r in rows)
    assert {r["m5"] for r in rows} <= {f"{m:02d}" for m in range(0, 60, 5)}


def test_search_equals_brute_force(spark, log, root):
    filters = dict(srcip_begin="10.0.0.3", destip_end="203.0.113.20", destport="443")
    got = search.search(tables.read_access_log(spark, root, BEGIN, END), BEGIN, END, **filters)
    want = Counter()
    for r in log.collect():
        if (BEGIN <= r.acctime <= END and ip_value(r.srcip) >= ip_value("10.0.0.3")
                and ip_value(r.destip) <= ip_value("203.0.113.20") and r.destport == "443"):
            want[tuple(r[c] for c in RAW_FIELDS)] += 1
    assert bag(got, *RAW_FIELDS) == want and want


def test_missing_buckets_are_empty(spark, root):
    assert tables.read_access_log(spark, root, "20300101", "20300102").count() == 0
    assert tables.read_access_log(spark, root, BEGIN, END, hids=[99]).count() == 0
    one = tables.read_access_log(spark, root, BEGIN, END, hids=[1001, 99])
    assert {r.hid for r in one.select("hid").distinct().collect()} == {1001}


def test_no_filter_marks(log):
    everything = search.predicates(url="NI", domain="#", srcport="", destip_begin="NI")
    assert log.where(everything).count() == log.count()


def test_unreadable_address_passes_an_upper_bound(spark):
    df = spark.createDataFrame([("junk",), ("10.0.0.1",), ("10.0.0.9",)], "srcip string")
    assert df.where(search.predicates(srcip_end="10.0.0.5")).count() == 2
    assert df.where(search.predicates(srcip_begin="10.0.0.0", srcip_end="10.0.0.5")).count() == 1


def test_url_modes(spark):
    url = "http://a.com/xy"
    df = spark.createDataFrame([(search.encode_literal(url),), ("not base64!",)], "url string")
    hit = lambda u, mode: df.where(search.predicates(url=u, url_mode=mode)).count()
    assert hit(url, "exact") == 1 and hit("http://a.com/x", "exact") == 0
    assert hit("http://a.com/x", "prefix") == 1
    assert hit("http://a.com", "encoded_prefix") == 1  # 12 characters
    assert hit("http://a.com/", "encoded_prefix") == 0  # 13: padding gets in the way
    with pytest.raises(ValueError):
        search.predicates(url=url, url_mode="other")


def test_search_jobs(spark, root, tmp_path):
    made = run_search(spark, root, f"{tmp_path}/orc", BEGIN, END, files=2, domain="site.cn")
    count = made.first()["row_count"]
    assert count == spark.read.csv(f"{tmp_path}/orc").count() > 0
    none = run_search(spark, root, f"{tmp_path}/none", "20300101", "20300102")
    assert none.first()["row_count"] == 0
    demo.raw_lines(spark, SF).select("value").coalesce(1).write.text(f"{tmp_path}/raw")
    text = run_line_search(spark, f"{tmp_path}/raw", f"{tmp_path}/text", BEGIN, END, zone="UTC", domain="site.cn")
    assert text.first()["row_count"] == count


def test_lookback(spark, root):
    log = tables.read_access_log(spark, root)
    got = search.search(log, BEGIN, END, max_lookback_hours=3)
    assert got.count() == search.search(log, "2024-01-10 13:00:00", END).count() > 0
    assert search.in_buckets(parse_param(BEGIN), parse_param(END)) is not None
