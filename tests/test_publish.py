import pytest
from conftest import SF
from helpers import bag
from pyspark.sql import functions as F

from hitledger.operators import compaction, layout
from hitledger.operators.ingest import ingest_rows
from hitledger.plans import compact
from hitledger.plans.ingest import run_append, run_ingest
from hitledger.schema import ADDRESS_NUMBERS, QUERY_COLUMNS
from hitledger.sinks.log_table import create_log_table, publish, register_batch, register_partition, register_partitions
from hitledger.sources import demo
from hitledger.sources.tables import list_files, read_access_log
from hitledger.workspace import Files, stage_dir

LINE = "100{h}|10.0.0.1|203.0.113.9|1|{port}|80|a.com|aHR0cA==|3|{second}"
T0 = 1704067200  # 2024-01-01 00:00:00


def _lines(spark, n, houses=2, step=60):
    return spark.createDataFrame(
        [(LINE.format(h=i % houses, port=i, second=T0 + i * step),) for i in range(n)], "value string"
    )


def test_publish_twice_is_once(spark):
    root = stage_dir(spark, "t")
    one = ingest_rows(_lines(spark, 20), "202401010100", "b1", "UTC")
    two = ingest_rows(_lines(spark, 30), "202401010100", "b2", "UTC")
    for rows in (one, two, one):
        publish(rows, root)
    assert read_access_log(spark, root).groupBy("batch").count().orderBy("batch").collect() == [("b1", 20), ("b2", 30)]
    shrunk = one.where("m5 = '00' or m5 = '05'")
    publish(shrunk.where("srcport != '0'"), root)  # replaces two buckets, leaves the others
    assert read_access_log(spark, root).where("batch = 'b1'").count() == 19
    stored = read_access_log(spark, root).where("batch = 'b2'")
    assert bag(stored.drop("batch", *ADDRESS_NUMBERS)) == bag(two.drop("batch"))


def test_ingest_jobs(spark, tmp_path):
    _lines(spark, 200).write.text(f"{tmp_path}/in")
    (tmp_path / "in" / "bad.txt").write_text("junk\n")
    root = stage_dir(spark, "t")
    run_ingest(spark, f"{tmp_path}/in", root, "b1", "202401010430", zone="UTC")
    log = read_access_log(spark, root)
    assert log.agg(F.min("acctime")).first()[0] == "2024-01-01 02:31:00" and log.count() == 49
    run_ingest(spark, f"{tmp_path}/in", root, "b1", "202401010430", zone="UTC", balance=False)
    assert read_access_log(spark, root).count() == 49
    everything = stage_dir(spark, "t")
    run_append(spark, f"{tmp_path}/in", everything, "b1", zone="UTC")
    assert read_access_log(spark, everything).count() == 201


def test_layout_report(spark):
    rows = ingest_rows(_lines(spark, 20), "202401010100", "b1", "UTC")
    houses = spark.createDataFrame([("1000", "x"), ("1001", "y"), ("1002", "z")], "houseid string, housename string")
    expected = layout.expected_for_day(houses, "20240101")
    assert expected.count() == 3 * layout.BUCKETS_PER_DAY
    missing = layout.missing_partitions(expected, layout.present_partitions(rows))
    assert missing.count() == 3 * 288 - 8
    assert layout.partition_paths(expected).where("path = '/hid=1002/d=240101/h=08/m5=20'").count() == 1


def test_catalog_partitions(spark):
    root = stage_dir(spark, "t")
    create_log_table(spark, "access_log_t", root)
    publish(ingest_rows(_lines(spark, 10), "202401010100", "b1", "UTC"), root)
    register_partitions(spark, "access_log_t")
    register_partition(spark, "access_log_t", hid=1000, d="240101", h="00", m5="00", batch="b1")
    assert spark.table("access_log_t").where("m5 = '05'").count() == 5
    assert spark.table("access_log_t").count() == 10
    publish(ingest_rows(_lines(spark, 10), "202401010100", "b2", "UTC"), root)
    register_batch(spark, "access_log_t", root, "b2")
    assert spark.table("access_log_t").where("batch = 'b2'").count() == 10
    spark.sql("drop table access_log_t")


# ---- merging files ---------------------------------------------------------


def test_packing_sample():
    files = [(60, "a"), (55, "b"), (44, "c"), (31, "d"), (31, "e"), (9, "f")]
    bins = {frozenset(b) for b in compaction.pack(files, 100)}
    assert bins == {frozenset(b) for b in (["a", "e"], ["b", "d", "f"], ["c"])} or bins == _pack_brute(files, 100)
    assert sum(map(len, bins)) == 6


def _pack_brute(files, limit):
    """Scan all bins, fullest first, for every file."""
    bins = []
    for size, name in sorted(files, reverse=True):
        bins.sort(key=lambda b: (b[0], b[1]), reverse=True)
        for b in bins:
            if b[0] + size < limit:
                b[0], b[1] = b[0] + size, name
                b[2].append(name)
                break
        else:
            bins.append([size, name, [name]])
    return {frozenset(b[2]) for b in bins}


def test_packing_equals_brute_force():
    import random

    for seed in range(40):
        rng = random.Random(seed)
        files = [(rng.randint(1, 80), f"f{i}") for i in range(rng.randint(0, 120))]
        assert {frozenset(b) for b in compaction.pack(files, 120)} == _pack_brute(files, 120)


def _listing(spark, sizes_mb, hid="1001"):
    rows = [(hid, "240101", "00", "00", f"f{i:03d}", int(mb * compaction.MB)) for i, mb in enumerate(sizes_mb)]
    return spark.createDataFrame(rows, "hid string, d string, h string, m5 string, file_path string, file_size bigint")


def test_bin_packing_plan(spark):
    both = _listing(spark, [70, 60, 40, 30, 79, 80, 200, 5]).union(_listing(spark, [70, 60, 30, 5], "1002"))
    plan = compaction.plan_bin_packing(both, house_merged_mb={"1002": 80})
    bins = {(r.hid, r.target): r for r in plan.groupBy("hid", "target").agg(
        F.sum("file_size").alias("size"), F.count("*").alias("n")).collect()}
    assert all(b.n > 1 and b.size < (80 if h == "1002" else 120) * compaction.MB for (h, _), b in bins.items())
    assert plan.where("file_size >= 80 * 1048576").count() == 0
    assert {t for _, t in bins} <= {f"f{i:03d}" for i in range(8)}
    usual = compaction.plan_bin_packing(_listing(spark, [70, 45], "1002"))
    assert [r.target for r in usual.collect()] == ["f000", "f000"]


def test_size_classes(spark):
    sizes = [43, 50, 64, 60, 55, 42, 30, 26, 41, 25, 3, 1, 65, 900]
    got = {r.size_class: (r.files, r.outputs) for r in compaction.class_outputs(_listing(spark, sizes)).collect()}
    assert got == {"le64": (5, 3), "le42": (4, 2), "le25": (3, 1)}
    assert compaction.plan_size_classes(_listing(spark, [43, 30, 65])).count() == 0
    assert compaction.plan_size_classes(_listing(spark, [30, 31, 32])).first()["outputs"] == 1


def test_output_counts(spark):
    listing = _listing(spark, [120, 81])
    assert compaction.total_outputs(listing, 100).first()["outputs"] == 3
    row = compaction.ingest_parallelism(listing, 150).first()
    assert (row.current_hour, row.previous_hour) == (2, 1)
    assert compaction.plan_small_files(_listing(spark, [10, 60])).count() == 0


def _published(spark, batches=4):
    root = stage_dir(spark, "merge")
    for b in range(batches):
        publish(ingest_rows(_lines(spark, 40 + b, step=15), "202401010100", f"b{b}", "UTC"), root)
    return root


PLANS = {
    "pack": compaction.plan_bin_packing, "classes": compaction.plan_size_classes,
    "small": compaction.plan_small_files, "rewrite": compaction.plan_rewrite,
}


@pytest.mark.parametrize("kind", PLANS)
def test_merge_keeps_rows(spark, kind):
    root = _published(spark)
    before, n_before = bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS), list_files(spark, root).count()
    merged = compact.merge_files(spark, root, f"m-{kind}", PLANS[kind])
    assert bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS) == before
    n_after = list_files(spark, root).count()
    assert merged == n_before == 21 and n_after == 6
    assert not Files(spark, root).exists(f"{root}/_merge/m-{kind}")
    if kind != "rewrite":
        assert compact.merge_files(spark, root, "again", PLANS[kind]) == 0


def test_merge_of_some_partitions_into_several_files(spark):
    root = _published(spark)
    before = bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS)
    tiny = lambda files: compaction.plan_rewrite(files, output_mb=0.001)
    compact.merge_files(spark, root, "m", tiny, only=F.col("hid") == 1001)
    assert bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS) == before
    files = list_files(spark, root)
    assert files.where("hid = '1000' and batch like 'm%'").count() == 0
    outputs = files.where("hid = '1001'").groupBy("m5").count().collect()
    assert all(r["count"] > 1 for r in outputs)


@pytest.mark.parametrize("step", ["make_marker", "move", "remove"])
@pytest.mark.parametrize("fail_at", [0, 5])
def test_interrupted_merge_shows_every_row_once_and_resumes(spark, monkeypatch, step, fail_at):
    root = _published(spark)
    seen = lambda: bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS)
    before, calls, real = seen(), [], getattr(Files, step)

    def failing(self, *paths):
        calls.append(paths)
        if len(calls) > fail_at:
            raise OSError("lost connection")
        real(self, *paths)

    monkeypatch.setattr(Files, step, failing)
    if fail_at == 0 or step == "remove":
        with pytest.raises(OSError):
            compact.merge_files(spark, root, "m", compaction.plan_bin_packing)
        assert seen() == before
    monkeypatch.setattr(Files, step, real)
    compact.merge_files(spark, root, "m", compaction.plan_bin_packing)
    assert seen() == before
    assert list_files(spark, root).count() == 6


def test_merged_batch_is_not_published_again(spark, tmp_path):
    root = _published(spark)
    (tmp_path / "in").mkdir()
    compact.merge_files(spark, root, "m", compaction.plan_bin_packing)
    with pytest.raises(ValueError, match="merged"):
        run_ingest(spark, f"{tmp_path}/in", root, "b1", "202401010100")


def test_merge_lists_only_what_it_is_for(spark):
    root = _published(spark)
    before = bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS)
    compact.merge_files(spark, root, "m", compaction.plan_rewrite, within=["hid=1001"])
    assert bag(read_access_log(spark, root), "hid", *QUERY_COLUMNS) == before
    assert list_files(spark, root, within=["hid=1000"]).where("batch like 'm-%'").count() == 0
    assert list_files(spark, root, within=["hid=1001"]).where("batch not like 'm-%'").count() == 0


def test_merge_reads_only_planned_sizes(spark):
    root = _published(spark, 1)
    plan = compaction.plan_rewrite(list_files(spark, root))
    scan = compact.planned_rows(spark, root, plan, 5000, F.col("hid") == 1001)
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "file_size" in text.split("DataFilters: [")[1].split("Format")[0]


def test_listing_does_not_read_contents(spark):
    root = _published(spark, 1)
    plan = list_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert demo.access_log(spark, SF).count() == 1000
