"""Whole jobs, through files."""

from datetime import datetime

import pytest
from helpers import bag, explained
from pyspark.sql import functions as F

from hitledger.operators import legality, rollup
from hitledger.plans.day import LEGAL_MERGES, run_day_stats
from hitledger.plans.hour import run_hour_stats, run_legal_hour_stats
from hitledger.plans.lookup import fresh_globs, run_domain_count
from hitledger.schema import DAY_COLUMNS
from hitledger.operators.search import search
from hitledger.sinks.delimited import append_answers, read_answers, write_delimited, write_houses
from hitledger.sinks.log_table import publish
from hitledger.sources import demo, dimensions
from hitledger.sources.tables import partition_globs, read_access_log, read_day_domains, read_hour_stats
from hitledger.workspace import stage_dir

BEGIN, END = "2024-01-10 00:00:00", "2024-01-10 23:59:59"


@pytest.fixture(scope="module")
def hours(spark, log):
    """A day of the log and its hour statistics."""
    root = stage_dir(spark, "jobs")
    rows = log.where(F.col("acctime").between(BEGIN, END)).withColumn("batch", F.lit("b1"))
    publish(rows, f"{root}/log", by=["hid", "d", "h"])
    run_hour_stats(spark, f"{root}/log", f"{root}/hour", "2024011000", "2024011023", demo.SUFFIXES, demo.FOREIGN)
    return root, rows


def test_hour_job(spark, hours):
    root, rows = hours
    want = {
        "ipportdomain": rollup.hour_ipportdomain(rollup.hits(rows)),
        "ipport": rollup.hour_ipport(rollup.hits(rows)),
        "domainip": rollup.hour_domainip(rollup.hits(rows), demo.SUFFIXES),
    }
    domains = rollup.hour_domain(rollup.hits(rows), demo.SUFFIXES, demo.FOREIGN)
    want["domain"], abroad = rollup.split_foreign(domains)
    for table, stats in want.items():
        assert bag(read_hour_stats(spark, f"{root}/hour", table)) == bag(stats), table
    tsv = spark.read.option("sep", "\t").csv(f"{root}/hour/foreigndomain")
    assert tsv.count() == abroad.count() > 0


def test_rerun_of_one_hour_replaces_it(spark, hours):
    root, _ = hours
    before = bag(read_hour_stats(spark, f"{root}/hour", "ipport"))
    run_hour_stats(spark, f"{root}/log", f"{root}/hour", "2024011011", "2024011011", demo.SUFFIXES, demo.FOREIGN)
    assert bag(read_hour_stats(spark, f"{root}/hour", "ipport")) == before


def test_rerun_without_rows_leaves_none(spark, hours, log):
    """Hours and days that come out empty are emptied; others are left alone."""
    root = stage_dir(spark, "rerun")
    rows = log.where(F.col("acctime").between(BEGIN, END)).withColumn("batch", F.lit("b1"))
    publish(rows, f"{root}/log", by=["hid", "d", "h"])
    job = lambda first, last, foreign: run_hour_stats(
        spark, f"{root}/log", f"{root}/hour", first, last, demo.SUFFIXES, foreign)
    job("2024011000", "2024011023", ())
    before = read_hour_stats(spark, f"{root}/hour", "domain").where("h <> '11'")
    before = bag(before)
    foreign = ["ru", "com", "org", "net", "cn"]
    job("2024011011", "2024011011", foreign)
    after = read_hour_stats(spark, f"{root}/hour", "domain")
    assert after.where("h = '11' and isforeign = 0 and domain like '%.%'").count() == 0
    assert bag(after.where("h <> '11'")) == before
    run_day_stats(spark, f"{root}/hour", f"{root}/day", "20240110")
    assert read_day_domains(spark, f"{root}/day").count() > 0
    job("2024011000", "2024011023", foreign)
    run_day_stats(spark, f"{root}/hour", f"{root}/day", "20240110")
    assert read_day_domains(spark, f"{root}/day").where("domain like '%.%'").count() == 0


def test_globs_name_what_is_touched():
    t = datetime
    assert partition_globs(t(2024, 1, 1, 10, 57), t(2024, 1, 1, 12, 4), [7, 8]) == [
        "hid={7,8}/d=240101/h=10/m5={55}", "hid={7,8}/d=240101/h=12/m5={00}", "hid={7,8}/d=240101/h={11}"]
    assert partition_globs(t(2023, 12, 31, 23, 0), t(2024, 1, 2, 23, 59), None) == ["hid=*/d=231231/h={23}", "hid=*/d={240101,240102}"]
    assert partition_globs(t(2024, 1, 1, 5), t(2024, 1, 1, 5, 59), None, ["hid", "d", "h"]) == ["hid=*/d=240101/h={05}"]
    assert len(partition_globs(t(2020, 1, 1), t(2024, 1, 1, 23, 59), None)[0].split(",")) == 1462
    assert partition_globs(t(2024, 1, 1, 5), t(2024, 1, 1, 6), None, ["d"]) == ["d={240101}"]
    assert partition_globs(t(2024, 1, 2), t(2024, 1, 1), None) == []


def test_stored_search_prunes_and_pushes(spark, hours):
    root, rows = hours
    begin, end = datetime(2024, 1, 10, 3), datetime(2024, 1, 10, 5, 30)
    log = read_access_log(spark, f"{root}/log", begin, end, [1001], ["hid", "d", "h"])
    text = explained(search(log, begin, end, destport="443", url="http://m.example.org/a", url_mode="prefix"))
    assert "EqualTo(destport,443)" in text and "StringStartsWith(url,aHR0cDovL20uZXhhbXBsZS5vcmcv" in text
    assert "PartitionFilters: [isnotnull(d" in text
    assert {(r.hid, r.h) for r in log.select("hid", "h").distinct().collect()} <= {(1001, h) for h in ("03", "04", "05")}


def test_result_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" a", "x y ", "")], "a string, b string, c string")
    write_delimited(df, f"{tmp_path}/csv")
    assert [r.value for r in spark.read.text(f"{tmp_path}/csv").collect()] == [" a,x y ,"]


def test_day_job(spark, hours):
    root, rows = hours
    written = run_day_stats(spark, f"{root}/hour", f"{root}/day", "20240110")
    assert set(written) == {"ipportdomain", "ipport", "domainip", "domain", "topdomain"}
    stats = rollup.day_domain(read_hour_stats(spark, f"{root}/hour", "domain"))
    assert written["domain"].first()["row_count"] == stats.count()
    lines = spark.read.text(f"{root}/day/domain").select("value")
    want = stats.select(F.concat_ws("\t", *DAY_COLUMNS["domain"]).alias("value"))
    assert bag(lines) == bag(want)
    back = read_day_domains(spark, f"{root}/day", "20240110")
    assert bag(back) == bag(stats.select("domain", "times", "topdomain"))
    assert run_day_stats(spark, f"{root}/hour", f"{root}/none", "20300101")["ipport"].first()["row_count"] == 0


def test_legal_jobs(spark, hours):
    root, rows = hours
    ips = demo.house_ips(spark)
    run_legal_hour_stats(spark, f"{root}/log", f"{root}/legal", "2024011000", "2024011023", demo.SUFFIXES, ips)
    assert bag(read_hour_stats(spark, f"{root}/legal", "illegLog")) == bag(legality.hour_illegal(rows, ips))
    want = legality.legal_hour_domainip(rollup.hits(rows), ips, demo.SUFFIXES)
    assert bag(read_hour_stats(spark, f"{root}/legal", "domainip")) == bag(want)
    day = run_day_stats(spark, f"{root}/legal", f"{root}/legalday", "20240110", merges=LEGAL_MERGES)
    assert day["illegLog"].first()["row_count"] == rollup.day_illegal(
        read_hour_stats(spark, f"{root}/legal", "illegLog")).count()
    # Lines of domains without a registrable part have six fields and are not read back.
    assert read_day_domains(spark, f"{root}/legalday").where("topdomain = ''").count() == 0


def test_domain_count_job(spark, hours, tmp_path):
    root, rows = hours
    minute = tmp_path / "raw" / "202401101259_done" / "1001"
    minute.mkdir(parents=True)
    line = "1|a|b|1|1|80|{d}|u|1|1704888000"
    (minute / "f.txt").write_text("\n".join([line.format(d="site.cn"), line.format(d="x.site.cn"), "short|site.cn"]))
    now = datetime(2024, 1, 10, 13, 5)
    n = rows.where("domain = 'site.cn'").count()
    ask = lambda **o: {r.source: r.times for r in run_domain_count(
        spark, o.pop("stats", f"{root}/hour"), f"{tmp_path}/raw", f"{tmp_path}/answers", o.pop("domain", "site.cn"),
        now=now, **o).collect()}
    assert ask() == {"stats": n, "lines": 1}
    assert ask(suffixes=demo.SUFFIXES) == {"stats": n, "lines": 2}
    assert ask(count_fresh=False) == {"stats": n}
    assert ask(query_day="20240109") == {"stats": None}
    assert ask(domain="nowhere.com", n_fields=9) == {"stats": None, "lines": 0}
    run_day_stats(spark, f"{root}/hour", f"{root}/day2", "20240110")
    assert ask(granularity="day", stats=f"{root}/day2") == {"stats": n, "lines": 1}
    log = read_answers(spark, f"{tmp_path}/answers")
    assert log.count() == 10
    assert log.where(F.col("value") == f"2024-01-10 13:05:00\tsite.cn\t2024-01-10 13:05:00\t{n}").count() == 4


def test_fresh_lines_across_midnight():
    assert fresh_globs("/r", datetime(2024, 1, 1, 0, 30)) == ["/r/2023123123*done", "/r/2024010100*done"]


def test_dimensions(spark, tmp_path):
    (tmp_path / "suffix").write_text("in\tcom\tx\nin\tnet\tx\narea\tjs.cn\tx\ncountry\tcn\tx\nin\tbad\ncountry\tuk\tx\ty\n")
    suffixes = dimensions.read_suffixes(spark, f"{tmp_path}/suffix")
    lists = dimensions.as_suffix_lists(suffixes)
    assert (lists.generic, lists.area, lists.country) == (("com", "net"), ("js.cn",), ("cn",))
    assert dimensions.as_suffix_lists(suffixes, limit=3) is suffixes
    (tmp_path / "foreign").write_text("ru-Russia-x\nde-Germany-x\nbad-line\n")
    assert dimensions.read_foreign_suffixes(spark, f"{tmp_path}/foreign") == ["de", "ru"]
    assert dimensions.read_foreign_suffixes(spark, None) == []
    assert dimensions.read_foreign_suffixes(spark, f"{tmp_path}/foreign", limit=1).count() == 2
    (tmp_path / "ips").write_text("1.2.3.4\n1.2.3.5\n")
    assert dimensions.read_house_ips(spark, f"{tmp_path}/ips").count() == 2
    houses = spark.createDataFrame([("1001", "east"), ("1002", "west")], "houseid string, housename string")
    write_houses(houses, f"{tmp_path}/houses")
    assert bag(dimensions.read_houses(spark, f"{tmp_path}/houses")) == bag(houses)
    (tmp_path / "j.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert dimensions.read_json(spark, f"{tmp_path}/j.json", "a int").count() == 2


def test_answers_append(spark, tmp_path):
    answer = spark.createDataFrame([("b", "d", "t", None)], "batchID string, domain string, curSec string, times bigint")
    for _ in range(2):
        append_answers(answer, f"{tmp_path}/log")
    assert [r.value for r in read_answers(spark, f"{tmp_path}/log").collect()] == ["b\td\tt\tnull"] * 2
    for _ in range(2):  # a question asked again replaces its lines
        append_answers(answer, f"{tmp_path}/log", "a/b c:*")
    append_answers(answer, f"{tmp_path}/log", "other")
    assert read_answers(spark, f"{tmp_path}/log").count() == 4
    assert read_answers(spark, f"{tmp_path}/none").count() == 0


def test_stage_dir_needs_a_shared_folder(spark):
    a, b = stage_dir(spark, "x"), stage_dir(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))
