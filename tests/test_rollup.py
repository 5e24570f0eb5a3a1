from helpers import bag, plan_of
from pyspark.sql import functions as F

from hitledger.operators import legality, rollup
from hitledger.sources import demo


def test_tree_levels_agree(log):
    base = rollup.hour_ipportdomain(rollup.hits(log))
    staged = rollup.stored(base)
    assert bag(rollup.hour_ipport(staged)) == bag(rollup.hour_ipport(rollup.hits(log)))
    per_ip = rollup.hour_domainip(staged, demo.SUFFIXES)
    assert bag(per_ip) == bag(rollup.hour_domainip(rollup.hits(log), demo.SUFFIXES))
    from_tree = rollup.hour_domain(rollup.stored(per_ip), demo.SUFFIXES, demo.FOREIGN)
    assert bag(from_tree) == bag(rollup.hour_domain(rollup.hits(log), demo.SUFFIXES, demo.FOREIGN))
    assert base.agg(F.sum("times")).first()[0] == log.count()


def test_day_is_the_whole_day(log):
    day = rollup.day_ipportdomain(rollup.hour_ipportdomain(rollup.hits(log)))
    keys = ["hid", "d", "destip", "destport", "domain", "proctype"]
    direct = log.groupBy(*keys).agg(
        F.min("acctime").alias("firsttime"), F.max("acctime").alias("activetime"), F.count("*").alias("times")
    ).withColumn("hid", F.col("hid").cast("string")).withColumnRenamed("d", "day")
    assert bag(day) == bag(direct)


def test_legal_and_illegal_make_all(spark, log):
    ips = demo.house_ips(spark).union(demo.house_ips(spark))  # repeated addresses change nothing
    flagged = legality.flag_legal(log, ips)
    assert flagged.count() == log.count()
    legal = legality.legal_only(log, ips).count()
    assert legal == flagged.where("iflegal = 1").count()
    assert legal + legality.illegal_only(log, ips).count() == log.count()


def test_legal_statistics_do_not_depend_on_the_join(spark, log):
    ips = demo.house_ips(spark)
    small = bag(legality.legal_hour_domainip(rollup.hits(log), ips, demo.SUFFIXES))
    broadcast = legality.legal_hour_ipport(rollup.hits(log), ips)
    assert plan_of(broadcast).index("Aggregate") < plan_of(broadcast).index("LeftSemi")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bag(legality.legal_hour_domainip(rollup.hits(log), ips, demo.SUFFIXES)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_aggregation_hashes(log):
    plan = rollup.hour_ipportdomain(rollup.hits(log))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_unreadable_times_keep_their_mark(spark):
    rows = spark.createDataFrame(
        [(1, "0", "0", "a", "80", "x.com", "1", "0"), (-1, "-1", "-1", "a", "80", "x.com", "1", "-1")],
        "hid int, d string, h string, destip string, destport string, domain string, proctype string, acctime string",
    )
    got = {r.hid: (r.firsttime, r.activetime) for r in rollup.hour_ipportdomain(rollup.hits(rows)).collect()}
    assert got == {"1": ("0", "0"), "-1": ("-1", "-1")}


def test_registrable_only_is_optional(spark):
    hour = spark.createDataFrame(
        [("1", "240101", "00", "1.2.3.4", 0, "2024-01-01 00:00:01", "2024-01-01 00:00:02", 2, "", "9.9.9.9"),
         ("1", "240101", "01", "a.com", 0, "2024-01-01 01:00:01", "2024-01-01 01:00:02", 3, "a.com", "9.9.9.8"),
         ("1", "240101", "02", "a.com", 0, "2024-01-01 02:00:01", "2024-01-01 02:00:02", 4, "a.com", "9.9.9.9")],
        "hid string, d string, h string, domain string, isforeign int, firsttime string, activetime string,"
        " times bigint, topdomain string, destip string",
    )
    assert [tuple(r) for r in rollup.day_domain(hour).collect()] == [
        ("1", "240101", "a.com", "2024-01-01 01:00:01", "2024-01-01 02:00:02", 7, "9.9.9.9", "a.com")
    ]
    assert rollup.day_domain(hour, drop_no_topdomain=False).count() == 2
    assert rollup.day_topdomain(hour).count() == 2
    assert rollup.day_topdomain(hour, drop_no_topdomain=False).count() == 3
