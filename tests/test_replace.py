"""Partitions replaced in one step, whatever stops the write."""

from datetime import datetime

import pytest
from helpers import bag
from pyspark.sql import functions as F

from hitledger.operators import rollup
from hitledger.plans.hour import run_hour_stats
from hitledger.schema import HOUR_TABLES
from hitledger.sinks.log_table import publish
from hitledger.sinks.replace import finish_replacing
from hitledger.sinks.stat_tables import Hours, write_hour_table, write_hour_tsv
from hitledger.sources import demo
from hitledger.sources.tables import read_access_log, read_hour_stats
from hitledger.workspace import Files, stage_dir

DAYS = Hours(datetime(2024, 1, 1), datetime(2024, 1, 2, 23, 59))


def _stats(spark, *rows):
    """illegLog rows (domain, destip, hid, d, h)."""
    return spark.createDataFrame(list(rows), HOUR_TABLES["illegLog"])


OLD = [("a", "1", "1", "240101", "05"), ("b", "1", "1", "240102", "06"), ("c", "1", "2", "240102", "23"), ("out", "1", "1", "240103", "00")]
NEW = [("x", "2", "1", "240101", "05"), ("y", "2", "3", "240101", "00"), ("z", "2", "1", "240102", "07")]


def _table(spark, by):
    root = stage_dir(spark, "replace")
    write_hour_table(_stats(spark, *OLD), f"{root}/illegLog", by=by)
    return root


def _rows(spark, root, *period):
    return sorted(map(tuple, read_hour_stats(spark, root, "illegLog", *period).collect()))


@pytest.mark.parametrize("by", [["hid", "d", "h"], ["hid", "d"], ["d"]])
def test_all_requested_hours_are_replaced(spark, by):
    root = _table(spark, by)
    assert _rows(spark, root) == sorted(OLD)
    write_hour_table(_stats(spark, *NEW), f"{root}/illegLog", DAYS, by)
    assert _rows(spark, root) == sorted([*NEW, OLD[3]])
    assert _rows(spark, root, "20240101") == sorted(NEW[:2])
    write_hour_table(_stats(spark), f"{root}/illegLog", DAYS, by)
    assert _rows(spark, root) == [OLD[3]]
    assert Files(spark, root).levels(f"{root}/illegLog") == by
    assert not Files(spark, root).exists(f"{root}/illegLog/_replace")


@pytest.mark.parametrize("by", [["hid", "d"], ["d"]])
def test_hours_within_a_day_directory(spark, by):
    root = _table(spark, by)
    hour = Hours(datetime(2024, 1, 2, 6), datetime(2024, 1, 2, 6, 59))
    write_hour_table(_stats(spark, ("n", "9", "1", "240102", "06")), f"{root}/illegLog", hour)
    assert _rows(spark, root) == sorted([OLD[0], ("n", "9", "1", "240102", "06"), *OLD[2:]])
    # Without hours asked for, those of the rows are replaced.
    write_hour_table(_stats(spark, ("m", "9", "2", "240102", "23"), ("k", "9", "2", "240102", "22")), f"{root}/illegLog")
    assert _rows(spark, root) == sorted([OLD[0], ("n", "9", "1", "240102", "06"), ("m", "9", "2", "240102", "23"), ("k", "9", "2", "240102", "22"), OLD[3]])


@pytest.mark.parametrize("by", [["hid", "d"], ["d"]])
def test_houses_asked_for(spark, by):
    root = _table(spark, by)
    write_hour_table(_stats(spark, NEW[0]), f"{root}/illegLog", Hours(DAYS.begin, DAYS.end, (1,)))
    assert _rows(spark, root) == sorted([NEW[0], OLD[2], OLD[3]])


def test_levels_do_not_change(spark):
    root = _table(spark, ["hid", "d"])
    with pytest.raises(ValueError, match="partitioned by"):
        write_hour_table(_stats(spark, *NEW), f"{root}/illegLog", DAYS, ["hid", "d", "h"])


class Stop(Exception):
    pass


@pytest.mark.parametrize("by", [["hid", "d", "h"], ["hid", "d"]])
@pytest.mark.parametrize("step", ["write_text", "make_marker", "remove", "move"])
@pytest.mark.parametrize("calls", range(4))
def test_a_stop_shows_old_rows_or_new_ones(spark, monkeypatch, by, step, calls):
    root = _table(spark, by)
    real, left = getattr(Files, step), [calls]

    def stopping(self, *args):
        if not left[0]:
            raise Stop
        left[0] -= 1
        return real(self, *args)

    monkeypatch.setattr(Files, step, stopping)
    try:
        write_hour_table(_stats(spark, *NEW), f"{root}/illegLog", DAYS)
        stopped = False
    except Stop:
        stopped = True
    monkeypatch.setattr(Files, step, real)
    old, new = sorted(OLD), sorted([*NEW, OLD[3]])
    seen = _rows(spark, root)
    assert seen == (old if stopped and step in ("write_text", "make_marker") else new)
    assert _rows(spark, root, "20240102") == [r for r in seen if r[3] == "240102"]
    finish_replacing(spark, f"{root}/illegLog")  # what the next write begins with
    assert _rows(spark, root) == seen
    write_hour_table(_stats(spark, *NEW), f"{root}/illegLog", DAYS)
    assert _rows(spark, root) == new


def test_tsv_rows_come_back(spark):
    for by in (["hid", "d", "h"], ["hid", "d"]):
        root = stage_dir(spark, "replace")
        rows = spark.createDataFrame([("1", "240101", "05", "a.ru", 1, "t", "t", 3, "", "9")], "hid string, d string, h string, domain string, isforeign int, firsttime string, activetime string, times bigint, topdomain string, destip string")
        assert write_hour_tsv(rows, f"{root}/foreigndomain", DAYS, by).first()["row_count"] == 1
        assert bag(read_hour_stats(spark, root, "foreigndomain")) == bag(rows)


@pytest.mark.parametrize("levels", [["d"], ["hid", "d"], ["hid", "d", "h", "m5"]])
def test_hours_of_a_log_of_any_levels(spark, log, levels):
    """A job over part of a day reads the log it finds, and takes no hour away that it was not asked for."""
    root = stage_dir(spark, "levels")
    rows = log.where("d = '240110'").withColumn("batch", F.lit("b1"))
    publish(rows, f"{root}/log", by=levels)
    job = lambda first, last: run_hour_stats(
        spark, f"{root}/log", f"{root}/hour", first, last, demo.SUFFIXES, demo.FOREIGN, by=["hid", "d"])
    job("2024011000", "2024011023")
    want = bag(rollup.hour_ipport(rollup.hits(rows)))
    assert bag(read_hour_stats(spark, f"{root}/hour", "ipport")) == want
    job("2024011010", "2024011012")
    assert bag(read_hour_stats(spark, f"{root}/hour", "ipport")) == want
    few = read_access_log(spark, f"{root}/log", "2024011010", "20240110105959")
    assert few.count() == rows.where("h = '10'").count() > 0
