"""The stored log: sized writes, catalog, statistics and Bloom filters, files taken twice."""

from datetime import datetime

import pytest
from conftest import SF
from helpers import bag, explained
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists, add_foreign, add_top_domain
from hitledger.functions.sql_names import register_sql_functions
from hitledger.operators import compaction
from hitledger.operators.ingest import sized
from hitledger.operators.search import search
from hitledger.plans.compact import merge_files
from hitledger.plans.ingest import run_append, run_ingest
from hitledger.schema import QUERY_COLUMNS
from hitledger.sinks.log_table import (
    add_partitions, create_log_table, expire, known_partitions, publish, register_batch, stored_partitions, sync_partitions,
)
from hitledger.sources import demo
from hitledger.sources.tables import list_files, list_input, log_levels, read_access_log, read_log_table
from hitledger.streaming import intake
from hitledger.streaming.ledger import read_ledger
from hitledger.workspace import Files, stage_dir

BEGIN, END = "2024-01-05 10:17:00", "2024-01-22 21:40:30"


def _log(spark, n_batches=1, by=("d",)):
    root = stage_dir(spark, "stored")
    rows = demo.access_log(spark, SF)
    for b in range(n_batches):
        own = rows.where(F.pmod(F.xxhash64("srcip", "acctime"), F.lit(n_batches)) == b)
        publish(own.withColumn("batch", F.lit(f"b{b}")), root, list(by))
    return root


# ---- catalog


@pytest.mark.parametrize("by", [["d"], ["hid", "d"], ["hid", "d", "h"]])
def test_catalog_follows_publish_merge_and_retention(spark, by):
    table = f"catalog_{len(by)}"
    rows = demo.access_log(spark, SF).where("d between '240105' and '240107'")
    root = stage_dir(spark, "stored")
    create_log_table(spark, table, root, by)
    seen = lambda: bag(read_log_table(spark, table, root), "hid", *QUERY_COLUMNS)
    assert not seen()
    for b in range(3):
        own = rows.where(F.pmod(F.xxhash64("srcip", "acctime"), F.lit(3)) == b)
        publish(own.withColumn("batch", F.lit(f"b{b}")), root, by)
        register_batch(spark, table, root, f"b{b}")
    want = bag(rows, "hid", *QUERY_COLUMNS)
    assert seen() == want and known_partitions(spark, table) == stored_partitions(spark, root)
    merge_files(spark, root, "m", compaction.plan_bin_packing, by=by, table=table)
    assert seen() == want and known_partitions(spark, table) == stored_partitions(spark, root)
    assert expire(spark, root, "240106", table) > 0
    assert known_partitions(spark, table) == stored_partitions(spark, root)
    assert seen() == bag(rows.where("d >= '240106'"), "hid", *QUERY_COLUMNS)
    spark.sql(f"drop table {table}")


def test_catalog_readers_see_every_row_once_during_a_merge(spark, monkeypatch):
    root, table = _log(spark, 3), "catalog_merge"
    create_log_table(spark, table, root, ["d"])
    assert sync_partitions(spark, table, root) == (len(stored_partitions(spark, root)), 0)
    seen = lambda: bag(read_log_table(spark, table, root), "hid", *QUERY_COLUMNS)
    want, real = seen(), Files.remove

    def stopped(self, path):
        raise OSError("lost")

    monkeypatch.setattr(Files, "remove", stopped)
    with pytest.raises(OSError):
        merge_files(spark, root, "m", compaction.plan_bin_packing, by=["d"], table=table)
    assert seen() == want
    monkeypatch.setattr(Files, "remove", real)
    merge_files(spark, root, "m", compaction.plan_bin_packing, by=["d"], table=table)
    assert seen() == want and known_partitions(spark, table) == stored_partitions(spark, root)
    add_partitions(spark, table, ["d=991231/batch=none"])
    Files(spark, root).remove(f"{root}/d=991231")  # made by the statement
    assert sync_partitions(spark, table, root) == (0, 1)
    spark.sql(f"drop table {table}")


def test_catalog_prunes(spark):
    root, table = _log(spark), "catalog_prune"
    create_log_table(spark, table, root, ["d"])
    register_batch(spark, table, root, "b0")
    found = search(read_log_table(spark, table, root, "20240110", "20240110235959"), "20240110", "20240110235959", destport="443")
    text = explained(found)
    assert "PartitionFilters: [" in text and "240110" in text and "EqualTo(destport,443)" in text
    assert found.count() == demo.access_log(spark, SF).where("d = '240110' and destport = '443'").count()
    spark.sql(f"drop table {table}")


def test_many_partitions_in_one_statement(spark, monkeypatch):
    root, table = _log(spark, 1, ("hid", "d")), "catalog_many"
    create_log_table(spark, table, root, ["hid", "d"])
    calls, real = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (calls.append(text), real(text, *a, **k))[1])
    register_batch(spark, table, root, "b0")
    assert sum("alter table" in c for c in calls) == 1 and len(known_partitions(spark, table)) > 50
    monkeypatch.undo()
    spark.sql(f"drop table {table}")


# ---- ranges and lookups


def test_ranges_push_down_and_skip_stripes(spark):
    root = _log(spark)
    log = read_access_log(spark, root)
    found = search(log, BEGIN, END, srcip_begin="10.0.0.9", srcip_end="10.0.0.12")
    text = explained(found)
    assert "GreaterThanOrEqual(srcnum,167772169)" in text and "LessThanOrEqual(srcnum,167772172)" in text
    want = search(demo.access_log(spark, SF), BEGIN, END, srcip_begin="10.0.0.9", srcip_end="10.0.0.12")
    assert bag(found) == bag(want)
    for bounds in ({"srcip_end": "10.0.0.40"}, {"destip_begin": "203.0.113.5"}, {"destip_begin": "junk", "destip_end": "203.0.113.3"}):
        assert bag(search(log, BEGIN, END, **bounds)) == bag(search(demo.access_log(spark, SF), BEGIN, END, **bounds))


def _rows_read(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    stack, read = [plan], 0
    while stack:
        node = stack.pop()
        if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
            stack.append(node.executedPlan())
            continue
        if "FileSourceScan" in node.getClass().getSimpleName():
            read += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return read


def test_a_value_that_is_not_there_reads_no_stripe(spark):
    """Within a file's least and greatest domain, so only the Bloom filter can tell."""
    log = read_access_log(spark, _log(spark))
    low, high = log.agg(F.min("domain"), F.max("domain")).first()
    assert low < "site.cm" < high
    assert _rows_read(log.where("domain = 'site.cm'")) == 0 < _rows_read(log.where("domain = 'site.cn'"))
    assert _rows_read(log.where("url = 'aHR0cDovL25vbmU='")) == 0


def test_merged_files_keep_numbers_and_filters(spark):
    root = _log(spark, 3)
    merge_files(spark, root, "m", compaction.plan_rewrite, by=["d"])
    log = read_access_log(spark, root)
    assert log.where("srcnum is null or destnum is null").count() == 0
    assert _rows_read(log.where("domain = 'site.cm'")) == 0


# ---- sized ingest


def _lines(spark, n, hid, hour):
    second = 1704067200 + hour * 3600
    return [(f"{hid}|10.0.0.1|203.0.113.9|1|{i}|80|a.com|aHR0cA==|3|{second + i % 300}",) for i in range(n)]


def test_files_follow_the_counts(spark, tmp_path):
    for hid, n in ((1001, 3000), (1002, 500)):
        rows = _lines(spark, n, hid, 5) + _lines(spark, n // 2, hid, 4)
        spark.createDataFrame(rows, "value string").coalesce(2).write.text(f"{tmp_path}/in/{hid}")
    size = {r.hid: r.size for r in list_input(spark, f"{tmp_path}/in").groupBy("hid").agg(F.sum("file_size").alias("size")).collect()}
    assert set(size) == {"1001", "1002"}
    mb = size["1001"] / 4 / compaction.MB
    root = stage_dir(spark, "sized")
    run_ingest(spark, f"{tmp_path}/in", root, "b", "202401010559", zone="UTC", task_mb=mb)
    assert read_access_log(spark, root).count() == 5250
    files = {(r.hid, r.h): r["count"] for r in list_files(spark, root).where("m5 = '00'").groupBy("hid", "h").count().collect()}
    # 4 tasks and half as many for the hour before; the small house has one each.
    assert files == {("1001", "05"): 4, ("1001", "04"): 2, ("1002", "05"): 1, ("1002", "04"): 1}
    counts = read_access_log(spark, root).where("hid = 1001 and h = '05'").groupBy(F.input_file_name()).count().collect()
    assert {r["count"] for r in counts} == {750}  # a hot house is dealt evenly


def test_a_task_writes_one_directory(spark, tmp_path):
    """Six days of one house: its four tasks for earlier hours do not write a file of each day."""
    rows = [line for day in range(6) for line in _lines(spark, 400, 1001, 30 + 24 * day)]
    spark.createDataFrame(rows, "value string").coalesce(2).write.text(f"{tmp_path}/in/1001")
    spark.createDataFrame(_lines(spark, 30, 7, 30), "value string").coalesce(1).write.text(f"{tmp_path}/in/other")
    size = list_input(spark, f"{tmp_path}/in").where("hid = '1001'").agg(F.sum("file_size")).scalar()
    root = stage_dir(spark, "days")
    run_ingest(spark, f"{tmp_path}/in", root, "b", "202401010100", zone="UTC", by=["hid", "d"], task_mb=size / 8 / compaction.MB)
    assert read_access_log(spark, root).count() == 2430
    files = list_files(spark, root).where("hid = '1001'").groupBy("d").count().collect()
    assert len(files) == 6 and {r["count"] for r in files} == {1}


def test_unknown_houses_are_written_too(spark):
    rows = demo.access_log(spark, SF).withColumn("batch", F.lit("b"))
    tasks = spark.createDataFrame([("1001", 3, 1)], "hid string, current_hour int, previous_hour int")
    dealt = sized(rows, tasks, "202401010500")
    assert bag(dealt) == bag(rows) and dealt.rdd.getNumPartitions() == 8
    assert bag(sized(rows, tasks, "202401010500", most=0)) == bag(sized(rows, tasks.limit(0), "202401010500")) == bag(rows)


def test_append_by_other_levels(spark, tmp_path):
    spark.createDataFrame(_lines(spark, 10, 1001, 5), "value string").write.text(f"{tmp_path}/in")
    root = stage_dir(spark, "t")
    run_append(spark, f"{tmp_path}/in", root, "b1", "UTC", by=["hid", "d"])
    assert log_levels(spark, root) == ["hid", "d"] and read_access_log(spark, root).count() == 10
    with pytest.raises(ValueError, match="partitioned by"):
        run_append(spark, f"{tmp_path}/in", root, "b2", "UTC")


# ---- files taken by a stream and by a job


def test_files_a_job_has_read_are_skipped(spark, tmp_path):
    def drop(minute, name, *ports):
        folder = tmp_path / "in" / f"{minute} x%20y"  # an odd name
        folder.mkdir(parents=True, exist_ok=True)
        second = int(datetime.fromisoformat("2024-01-01T12:00:00+00:00").timestamp())
        (folder / name).write_text("".join(f"1001|10.0.0.1|203.0.113.9|1|{p}|80|a.com|aHR0cA==|3|{second}\n" for p in ports))

    def stream():
        intake.start_intake(spark, f"{tmp_path}/in/*", f"{tmp_path}/log", f"{tmp_path}/cp", zone="UTC", by=["d"]).awaitTermination()
        return sorted(r.srcport for r in read_access_log(spark, f"{tmp_path}/log").collect())

    drop("202401011200", "a", 1, 2)
    drop("202401011205", "x", 8)
    assert stream() == ["1", "2", "8"]
    drop("202401011200", "b", 3)  # the stream has not come to it
    run_ingest(spark, f"{tmp_path}/in/202401011200 x%20y", f"{tmp_path}/log", "202401011200", "202401011200", "UTC", by=["d"])
    drop("202401011200", "c", 4)  # late
    drop("202401011205", "y", 9)
    assert stream() == ["1", "2", "3", "4", "8", "9"]
    noted = {(r.state, r.file_path.rsplit("/", 1)[1]) for r in read_ledger(spark, f"{tmp_path}/log").collect()}
    assert noted == {("reprocessed", "a"), ("reprocessed", "b"), ("skipped", "b"), ("reopened", "c")}
    create_log_table(spark, "reprocessed", f"{tmp_path}/log", ["d"])
    sync_partitions(spark, "reprocessed", f"{tmp_path}/log")
    run_ingest(spark, f"{tmp_path}/in/202401011200 x%20y", f"{tmp_path}/log", "202401011200", "202401011200", "UTC", by=["d"], table="reprocessed")
    assert stream() == ["1", "2", "3", "4", "8", "9"]
    assert known_partitions(spark, "reprocessed") == stored_partitions(spark, f"{tmp_path}/log")
    spark.sql("drop table reprocessed")


# ---- long lists


def test_one_join_gives_what_literals_give(spark):
    lists = SuffixLists(("com", "net", "org"), ("js.cn",), ("cn", "uk"))
    rows = [("in", v) for v in lists.generic] + [("area", "js.cn")] + [("country", v) for v in lists.country] + [("in", "com"), ("other", "cn")]
    table = spark.createDataFrame(rows, "kind string, value string")
    names = ["a.com", "x.a.com", "a.js.cn", "x.a.js.cn", "js.cn", "com.cn", "a.com.cn", "cn", "a.b.uk", "bad host!", "", "a.com.", "a.com:80", None, "a.b.c", "..", "a..cn"]
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names * 2)], "domain string, i int")
    assert bag(add_top_domain(frame, table)) == bag(add_top_domain(frame, lists))
    foreign = spark.createDataFrame([("ru",), ("uk",), ("",)], "suffix string")
    assert bag(add_foreign(frame, foreign)) == bag(add_foreign(frame, ["ru", "uk"]))


def test_sql_functions_refuse_what_they_cannot_hold(spark):
    foreign = spark.range(30).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("suffix"))
    with pytest.raises(ValueError, match="add_foreign"):
        register_sql_functions(spark, None, foreign, limit=20)
