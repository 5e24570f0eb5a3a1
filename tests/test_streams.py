import os
import shutil
from datetime import datetime

import pytest
from conftest import SF
from helpers import bag
from pyspark.sql import functions as F

from hitledger.operators import rollup
from hitledger.operators.cells import to_cells
from hitledger.operators.ingest import ingest_rows
from hitledger.schema import ADDRESS_NUMBERS
from hitledger.sinks.cells import cell_writer, compact_cells, put_cells, read_cells
from hitledger.sources import demo, lines
from hitledger.sources.tables import read_access_log, read_hour_stats
from hitledger.streaming import hourly, intake
from hitledger.workbook import MONTH
from hitledger.workspace import Files

LINE = "1001|10.0.0.1|203.0.113.9|1|{port}|80|a.com|aHR0cA==|3|{second}"
SECOND = int(datetime.fromisoformat("2024-01-01T12:00:00+00:00").timestamp())


def _drop_in(folder, minute, name, *ages):
    target = folder / minute / "1001"
    target.mkdir(parents=True, exist_ok=True)
    text = "".join(LINE.format(port=i, second=SECOND - age) + "\n" for i, age in enumerate(ages))
    (target / name).write_text(text + "broken line\n")


@pytest.fixture
def inbox(tmp_path):
    return tmp_path / "in"


def _run(spark, tmp_path, **options):
    query = intake.start_intake(
        spark, f"{tmp_path}/in/*/*", f"{tmp_path}/log", f"{tmp_path}/checkpoint", zone="UTC", by=["d"], **options
    )
    query.awaitTermination()
    return read_access_log(spark, f"{tmp_path}/log")


def test_every_file_once_and_late_rows_dropped(spark, tmp_path, inbox):
    _drop_in(inbox, "202401011200", "a.txt", 0, 60, 7199, 7200, 7201, -3600)
    log = _run(spark, tmp_path)
    assert sorted(int(r.srcport) for r in log.collect()) == [0, 1, 2, 5]  # 7200 s old is late, the future is not
    assert _run(spark, tmp_path).count() == 4  # nothing new
    _drop_in(inbox, "202401011200", "late.txt", 10)  # minute already taken
    _drop_in(inbox, "202401011400", "b.txt", 0, 1)  # 7200 and 7201 s before its own load time
    log = _run(spark, tmp_path)
    assert log.count() == 5
    assert log.select("batch").distinct().count() == 2


def test_retried_batch_replaces_itself(spark, tmp_path, inbox):
    _drop_in(inbox, "202401011200", "a.txt", 0, 60)
    _run(spark, tmp_path)
    shutil.rmtree(tmp_path / "checkpoint" / "commits")  # as if the job died before committing
    assert _run(spark, tmp_path).count() == 2


def test_old_files_count_too(spark, tmp_path, inbox):
    for number, name in enumerate(("a.txt", "b.txt", "c.txt")):
        _drop_in(inbox, "202401011200", name, number)
    os.utime(inbox / "202401011200" / "1001" / "b.txt", (1_000_000_000, 1_000_000_000))
    assert _run(spark, tmp_path).count() == 3


def test_file_time_is_in_the_zone_of_the_lines(spark, tmp_path, inbox):
    """The session's zone is another one."""
    folder = inbox / "other" / "1001"
    folder.mkdir(parents=True)
    (folder / "f.txt").write_text("".join(LINE.format(port=i, second=SECOND - age) + "\n" for i, age in enumerate((0, 7199, 7300))))
    os.utime(folder / "f.txt", (SECOND, SECOND))
    assert sorted(int(r.srcport) for r in _run(spark, tmp_path).collect()) == [0, 1]


def test_load_time_falls_back_to_the_file(spark):
    df = spark.createDataFrame(
        [("file:/in/202401011205_x/1001/f.txt",), ("file:/in/other/f.txt",)], "file_path string"
    ).withColumn("modified", F.lit("2024-02-03 04:05:06").cast("timestamp"))
    got = [str(r[0]) for r in df.select(intake.load_time_of()).collect()]
    assert got == ["2024-01-01 12:05:00", "2024-02-03 04:05:06"]


def test_hourly_partials_equal_batch(spark, tmp_path):
    source = demo.raw_lines(spark, SF).select("value").repartition(6)
    source.write.text(f"{tmp_path}/in/x/y")
    stream = lines.parse_tolerant(intake.line_stream(spark, f"{tmp_path}/in/*/*", max_files=2), zone="UTC")
    hourly.start_hour_partials(stream, f"{tmp_path}/partials", f"{tmp_path}/checkpoint", ["d"]).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/partials").select("epoch").distinct().count() == 3
    batch = rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF)))
    assert bag(hourly.read_hour_partials(spark, f"{tmp_path}/partials")) == bag(batch)


@pytest.fixture
def late_partials(spark, tmp_path):
    """Writes the partials of one of three parts of the log under a number of its own."""
    rows = demo.access_log(spark, SF)

    def write(part):
        own = rows.where(F.pmod(F.xxhash64("srcip", "acctime"), F.lit(3)) == part)
        partials = rollup.merge(rollup.hits(own), hourly.KEYS).withColumn("epoch", F.lit(part))
        partials.write.mode("append").partitionBy("d", "epoch").parquet(f"{tmp_path}/partials")

    return write


def _fold(spark, tmp_path):
    hourly.fold_hours(spark, f"{tmp_path}/partials", f"{tmp_path}/hours", *MONTH, by=["hid", "d"])
    return _rows(read_hour_stats(spark, f"{tmp_path}/hours", "ipportdomain", *MONTH))


def _rows(stats):
    return bag(stats.where("d between '240101' and '240130'").select(sorted(stats.columns)))


def test_folds_again_and_after_late_rows(spark, tmp_path, late_partials):
    late_partials(0)
    first = _fold(spark, tmp_path)
    assert first and _fold(spark, tmp_path) == first
    late_partials(1)
    late_partials(2)
    assert _fold(spark, tmp_path) == _rows(rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF))))
    assert hourly.read_hour_partials(spark, f"{tmp_path}/partials", *MONTH).isEmpty()


def test_fold_that_stops_is_resumed(spark, tmp_path, late_partials, monkeypatch):
    for part in range(3):
        late_partials(part)
    remove, gone = Files.remove, []

    def stopping(files, path):
        if "/d=" in path and "partials" in path:
            if len(gone) == 5:
                raise OSError("stopped")
            gone.append(path)
        remove(files, path)

    with monkeypatch.context() as patch:
        patch.setattr(Files, "remove", stopping)
        with pytest.raises(OSError):
            _fold(spark, tmp_path)
    assert _fold(spark, tmp_path) == _rows(rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF))))


def test_closed_hours_emit_once(spark, tmp_path):
    source = demo.raw_lines(spark, SF).select("value").coalesce(1)
    source.write.text(f"{tmp_path}/in/x/y")
    stream = lines.parse_tolerant(intake.line_stream(spark, f"{tmp_path}/in/*/*"), zone="UTC")
    query = (
        hourly.closed_hours(stream).writeStream.outputMode("append").format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = bag(spark.read.parquet(f"{tmp_path}/out"))
    everything = bag(rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF))))
    assert 0 < sum(closed.values()) < sum(everything.values())
    assert not closed - everything


def test_cells_from_a_stream(spark, tmp_path, inbox):
    _drop_in(inbox, "202401011200", "a.txt", 0, 60)
    parsed = lines.parse_tolerant(intake.line_stream(spark, f"{inbox}/*/*"), zone="UTC")
    cells = to_cells(parsed.select("srcport", "hid", "domain"), "srcport", ["hid", "domain"])
    cells.writeStream.foreachBatch(cell_writer(f"{tmp_path}/cells")).option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in read_cells(spark, f"{tmp_path}/cells").collect()}
    assert ("0", "info", "hid", "1001") in got and ("1", "info", "domain", "a.com") in got and len(got) == 6


def test_batch_and_stream_ingest_agree(spark, tmp_path, inbox, lines_of):
    _drop_in(inbox, "202401011200", "a.txt", 0, 60, 8000)
    batch = ingest_rows(spark.read.text(f"{inbox}/*/*"), "202401011200", "b", "UTC").drop("batch")
    assert bag(batch) == bag(_run(spark, tmp_path).drop("batch", *ADDRESS_NUMBERS))


def _cells(spark, *rows):
    return spark.createDataFrame(list(rows), "rowkey string, family string, qualifier string, value string, version bigint")


def test_newest_cells_count(spark, tmp_path):
    path = f"{tmp_path}/cells"
    now = lambda: {(r.rowkey, r.qualifier): r.value for r in read_cells(spark, path).collect()}
    put_cells(_cells(spark, ("a", "i", "x", "1", 5), ("a", "i", "y", "1", 5), ("b", "i", "x", None, 1)), path, "0000000001")
    put_cells(_cells(spark, ("a", "i", "x", "2", 6), ("a", "i", "y", "old", 4), ("c", "i", "x", "3", 1)), path, "0000000002")
    want = {("a", "x"): "2", ("a", "y"): "1", ("b", "x"): None, ("c", "x"): "3"}
    assert now() == want
    put_cells(_cells(spark, ("a", "i", "x", "2", 6), ("a", "i", "y", "old", 4), ("c", "i", "x", "3", 1)), path, "0000000002")  # retried
    assert now() == want
    assert {r.rowkey for r in read_cells(spark, path, "a").collect()} == {"a"}
    before = spark.read.parquet(path).count()
    assert compact_cells(spark, path) == 2 and now() == want
    assert spark.read.parquet(path).count() == len(want) < before
    put_cells(_cells(spark, ("a", "i", "x", "late", 99)), path, "0000000002")  # merged batches are not written again
    assert now() == want
    put_cells(_cells(spark, ("a", "i", "x", "4", 7)).drop("version"), path, "0000000009")  # without versions the batch is the version
    assert now()[("a", "x")] == "4"
    assert compact_cells(spark, path) == 2 and compact_cells(spark, path) == 1


def test_cells_compaction_that_stops(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/cells"
    for b in (1, 2):
        put_cells(_cells(spark, ("a", "i", "x", str(b), b), (f"k{b}", "i", "x", "v", b)), path, f"000000000{b}")
    seen = lambda: bag(read_cells(spark, path))
    want = seen()
    for step in ("write_text", "make_marker", "remove", "move"):
        def stopped(self, *args):
            raise OSError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(Files, step, stopped)
            with pytest.raises(OSError):
                compact_cells(spark, path)
        assert seen() == want
    put_cells(_cells(spark, ("n", "i", "x", "new", 3)), path, "0000000003")
    assert seen() == want + bag(_cells(spark, ("n", "i", "x", "new", 3)).drop("version"))


def test_closed_hours_go_on_after_a_restart(spark, tmp_path):
    """Open hours of the first run are closed by events of the second, with the rows of both."""
    def run(name, *seconds):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "f").write_text("".join(LINE.format(port=0, second=SECOND + s) + "\n" for s in seconds))
        stream = lines.parse_tolerant(intake.line_stream(spark, f"{tmp_path}/in/*"), zone="UTC")
        hourly.start_closed_hours(stream, f"{tmp_path}/hours", f"{tmp_path}/cp").awaitTermination()
        stats = read_hour_stats(spark, f"{tmp_path}/hours", "ipportdomain")
        return {(r.d, r.h): r.times for r in stats.collect()}

    assert run("1", 0, 60, 3700) == {}
    assert run("2", 120, 3 * 3600 + 10) == {("240101", "12"): 3}  # 12 o'clock closes at 14, two hours behind
    assert run("3", 30, 9 * 3600) == {("240101", "12"): 3, ("240101", "13"): 1, ("240101", "15"): 1}  # a late row is dropped


def test_closed_hours_are_few_files(spark, tmp_path):
    """A batch is computed once, and a directory gets one file however many tasks the state has."""
    demo.raw_lines(spark, SF).select("value").repartition(6).write.text(f"{tmp_path}/in/x")
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    source = intake.line_stream(spark, f"{tmp_path}/in/*").select("value").mapInArrow(seen, "value string")
    stream = lines.parse_tolerant(source, zone="UTC")
    hourly.start_closed_hours(stream, f"{tmp_path}/hours", f"{tmp_path}/cp", by=["hid", "d"]).awaitTermination()
    assert evaluated.value == demo.raw_lines(spark, SF).count()
    folders = [files for _, _, files in os.walk(tmp_path / "hours") if any(f.endswith(".orc") for f in files)]
    assert len(folders) > 10 and all(sum(f.endswith(".orc") for f in files) == 1 for files in folders)
    closed = bag(read_hour_stats(spark, f"{tmp_path}/hours", "ipportdomain"))
    everything = bag(rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF))))
    assert sum(closed.values()) > 0.9 * sum(everything.values()) and not closed - everything


def test_partials_are_few_files(spark, tmp_path):
    source = demo.raw_lines(spark, SF).select("value").repartition(6)
    source.write.text(f"{tmp_path}/in/x/y")
    stream = lines.parse_tolerant(intake.line_stream(spark, f"{tmp_path}/in/*/*"), zone="UTC")
    hourly.start_hour_partials(stream, f"{tmp_path}/partials", f"{tmp_path}/checkpoint", ["d"]).awaitTermination()
    files, hours = (spark.read.parquet(f"{tmp_path}/partials").select(c).distinct().count() for c in (F.input_file_name(), F.concat("d", "epoch")))
    assert files == hours


def test_hours_of_a_day_kept_by_day(spark, tmp_path, late_partials):
    """Days that are asked for in part are not folded, and hours read are those asked for."""
    for part in range(3):
        late_partials(part)
    want = rollup.hour_ipportdomain(rollup.hits(demo.access_log(spark, SF)))
    few = hourly.read_hour_partials(spark, f"{tmp_path}/partials", "2024010310", "2024010411")
    inside = F.concat("d", "h").between("24010310", "24010411")
    assert _rows(few) == _rows(want.where(inside))
    hourly.fold_hours(spark, f"{tmp_path}/partials", f"{tmp_path}/hours", "2024010310", "2024010511", by=["hid", "d"])
    assert _rows(read_hour_stats(spark, f"{tmp_path}/hours", "ipportdomain")) == _rows(want.where("d = '240104'"))
    left = hourly.read_hour_partials(spark, f"{tmp_path}/partials")
    assert _rows(left) == _rows(want.where("d <> '240104'"))
