"""Writers of the statistics tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.schema import DAY_COLUMNS, HOUR_TABLES
from hitledger.sinks.delimited import write_delimited
from hitledger.sinks.replace import replace_partitions
from hitledger.sources.tables import partition_globs, scan_stats
from hitledger.workspace import Files

HOUR_PARTITIONS = ["hid", "d", "h"]
#: Directories that are listed one by one when hours are put into them.
MOST_TOUCHED = 1_000


@dataclass(frozen=True)
class Hours:
    """All hours from ``begin`` to ``end`` of some houses (None: of all)."""

    begin: datetime
    end: datetime
    hids: tuple[int | str, ...] | None = None

    def holds(self) -> Column:
        hour = F.concat("d", "h").between(f"{self.begin:%y%m%d%H}", f"{self.end:%y%m%d%H}") & (F.length("d") == 6)
        return hour & F.col("hid").cast("string").isin([str(h) for h in self.hids]) if self.hids else hour

    def globs(self, by: Sequence[str]) -> list[str]:
        return partition_globs(self.begin, self.end, self.hids, by)

    def cut(self, by: Sequence[str]) -> bool:
        """Whether directories of these levels may hold other rows too."""
        days = "h" not in by and (self.begin.hour, self.end.hour) != (0, 23)
        return days or (self.hids is not None and "hid" not in by)


def table_levels(spark: SparkSession, path: str, by: Sequence[str] | None) -> list[str]:
    """The levels a table has on disk, else those asked for (default: house, day, hour)."""
    found = Files(spark, path).levels(path)
    if by is not None and found and found != list(by):
        raise ValueError(f"{path} is partitioned by {found}, not by {list(by)}")
    return found or list(by or HOUR_PARTITIONS)


def _with_kept(stats: DataFrame, stored: DataFrame, hours: Hours | None, levels: Sequence[str]) -> DataFrame:
    """``stats`` and the stored rows of other hours in directories that will be replaced."""
    if hours is not None:
        kept = stored.where(~F.coalesce(hours.holds(), F.lit(False)))
    else:
        now = stats.select([F.col(c).cast("string").alias(f"_{c}") for c in HOUR_PARTITIONS]).distinct()
        same = {c: F.col(c).cast("string") == F.col(f"_{c}") for c in HOUR_PARTITIONS}
        touched = now.select([f"_{c}" for c in levels]).distinct()
        kept = stored.join(now, list(same.values()), "left_anti").join(touched, [same[c] for c in levels], "left_semi")
    return stats.unionByName(kept.select([F.col(c).cast(t).alias(c) for c, t in stats.dtypes]))


def _touched(stats: DataFrame, levels: Sequence[str]) -> list[str]:
    """The directories that ``stats`` goes to; the whole table if they are many or have odd names."""
    found = stats.select([F.col(c).cast("string") for c in levels]).distinct().take(MOST_TOUCHED + 1)
    if not 0 < len(found) <= MOST_TOUCHED or not all(value and value.isalnum() for row in found for value in row):
        return [""]
    return ["/".join(f"{level}={value}" for level, value in zip(levels, row)) for row in found]


def _replace_hours(stats: DataFrame, path: str, table: str, hours: Hours | None, by: Sequence[str] | None, save):
    spark = stats.sparkSession
    levels = table_levels(spark, path, by)
    if set(levels) < set(HOUR_PARTITIONS) and (hours is None or hours.cut(levels)):
        globs = _touched(stats, levels) if hours is None else hours.globs(levels)
        stats = _with_kept(stats, scan_stats(spark, path, table, globs, levels), hours, levels)
    stale = None if hours is None else hours.globs(levels)
    return replace_partitions(spark, path, lambda folder: save(stats.hint("rebalance", *levels), folder, levels), stale, len(levels))


def write_hour_table(
    stats: DataFrame, path: str, hours: Hours | None = None, by: Sequence[str] | None = None
) -> None:
    """ORC by the levels ``by`` (the table's own, else house, day and hour; fewer for thin logs).

    Replaces all of ``hours``, also those without rows, or the hours that ``stats`` holds, in one step, and no others.
    """
    table = path.rstrip("/").rsplit("/", 1)[1]
    _replace_hours(stats, path, table, hours, by, lambda rows, folder, levels: rows.write.partitionBy(*levels).orc(folder))


def write_hour_tsv(stats: DataFrame, path: str, hours: Hours | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """The same as TSV; returns (path, row_count)."""

    def save(rows: DataFrame, folder: str, levels: Sequence[str]) -> DataFrame:
        return write_delimited(rows.select(HOUR_TABLES["foreigndomain"].names), folder, "\t", partition_by=levels)

    written = _replace_hours(stats, path, "foreigndomain", hours, by, save)
    return written.withColumn("path", F.lit(path))


def write_day_tsv(stats: DataFrame, path: str, table: str, days: Hours | None = None) -> DataFrame:
    """TSV by house and day. ``hid`` is also the first field of every line."""
    fields = [F.col("hid").alias("house"), *DAY_COLUMNS[table][1:]]
    rows = stats.select(*fields, "hid", F.col("day").alias("d")).hint("rebalance", "hid", "d")
    stale = None if days is None else days.globs(["hid", "d"])
    spark = stats.sparkSession
    written = replace_partitions(spark, path, lambda folder: write_delimited(rows, folder, "\t", partition_by=["hid", "d"]), stale, 2)
    return written.withColumn("path", F.lit(path))
