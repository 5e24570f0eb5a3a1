"""Stored relations: the partitioned log, hour and day statistics, file listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitledger.functions.times import days_between, parse_param
from hitledger.operators.search import in_buckets
from hitledger.schema import ACCESS_LOG_TABLE, HOUR_TABLES, LAYOUT_COLUMNS, PARTITION_COLUMNS
from hitledger.sinks.replace import read_partitions
from hitledger.workspace import Files, matching_paths

# Names below a log's root, which scans skip.
HIDDEN, SHOWN, MERGED_BATCHES = "_hidden", "_shown", "_merged"


def _scan(spark: SparkSession, root: str, globs: list[str], schema) -> DataFrame:
    """ORC below ``root``, listing only the directories the globs match."""
    found = matching_paths(spark, [f"{root}/{g}" if g else root for g in globs])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).orc(found)


def scan_stats(spark: SparkSession, path: str, table: str, globs: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """One hour table below the globs, with a write that is under way either shown whole or not at all."""
    schema = HOUR_TABLES[table]

    def scan(root: str, wanted: list[str]) -> DataFrame:
        if table == "foreigndomain":
            return _scan_tsv(spark, root, wanted, schema, levels)
        return _scan(spark, root, wanted, schema).select(schema.names)

    return read_partitions(spark, path, globs, scan, levels)


def _scan_tsv(spark: SparkSession, root: str, globs: list[str], schema: StructType, levels: Sequence[str]) -> DataFrame:
    """TSV columns go by place: directory levels come last."""
    found = matching_paths(spark, [f"{root}/{g}" if g else root for g in globs])
    if not found:
        return spark.createDataFrame([], schema)
    fields = [f for f in schema if f.name not in levels] + [schema[name] for name in levels]
    rows = spark.read.schema(StructType(fields)).option("basePath", root).option("sep", "\t").csv(found)
    # An empty text is written as nothing.
    return rows.fillna("", [f.name for f in schema if f.dataType.simpleString() == "string"]).select(schema.names)


def scan_log(spark: SparkSession, root: str, globs: Sequence[str] = ("",)) -> DataFrame:
    """The log's files as they lie there, whatever merges are under way."""
    return _scan(spark, root, list(globs), ACCESS_LOG_TABLE)


def _merge_states(spark: SparkSession, root: str) -> dict[str, bool]:
    """Merges under way, and whether their result counts already."""
    files = Files(spark, root)
    found = {state: files.glob(f"{root}/_merge/*/{state}") for state in (HIDDEN, SHOWN)}
    return {path.rsplit("/", 2)[1]: state == SHOWN for state, paths in found.items() for path in paths}


def _visible_log(spark: SparkSession, root: str, scan: Callable[[], DataFrame]) -> DataFrame:
    """Every row once: of a merge under way either the planned files or the merged ones."""
    states = None
    while states != (now := _merge_states(spark, root)):  # listed between two equal looks at the marks
        states = now
        log = scan()
    for merge_id, shown in states.items():
        if not shown:
            log = log.where(~F.col("batch").startswith(f"{merge_id}-merge-"))
            continue
        gone = spark.read.parquet(f"{root}/_merge/{merge_id}/plan").select(F.col("file_path").alias("_gone"))
        columns = log.columns
        log = log.withColumn("_file", F.col("_metadata.file_path")).join(gone, F.col("_file") == F.col("_gone"), "left_anti").select(columns)
    return log


def partition_globs(
    begin: datetime | None, end: datetime | None, hids: Sequence[int | str] | None, levels: Sequence[str] = PARTITION_COLUMNS
) -> list[str]:
    """Directories of a table partitioned by ``levels`` that touch [begin, end], and no others.

    Whole days are named by day, whole hours of the days at the edges by hour, and the rest by bucket.
    """
    house = "hid=" + (f"{{{','.join(map(str, hids))}}}" if hids else "*")
    front = f"{house}/" if "hid" in levels else ""
    if begin is None or end is None:
        return [house] if hids and front else [""]
    if begin > end:
        return []
    days = days_between(begin, end)
    if "d" not in levels:
        return [house] if front else [""]
    if "h" not in levels:
        return [f"{front}d={{{','.join(days)}}}"]
    first, last = days[0], days[-1]
    lows = {first: begin.hour * 60 + begin.minute if begin.hour or begin.minute else 0}
    highs = {last: end.hour * 60 + end.minute}
    globs, whole = [], []
    for day in days:
        low, high = lows.get(day, 0), highs.get(day, 24 * 60 - 1)
        if low < 5 and high >= 24 * 60 - 5:
            whole.append(day)
            continue
        hours = []
        for hour in range(low // 60, high // 60 + 1):
            minutes = [m for m in range(0, 60, 5) if low // 5 * 5 <= hour * 60 + m <= high]
            if "m5" in levels and len(minutes) < 12:
                globs.append(f"{front}d={day}/h={hour:02d}/m5={{{','.join(f'{m:02d}' for m in minutes)}}}")
            else:
                hours.append(f"{hour:02d}")
        if hours:
            globs.append(f"{front}d={day}/h={{{','.join(hours)}}}")
    return globs + ([f"{front}d={{{','.join(whole)}}}"] if whole else [])


def log_levels(spark: SparkSession, root: str) -> list[str]:
    """The directory levels a log was published with; those of an empty one are yet to be chosen."""
    found = [name for name in Files(spark, root).levels(root) if name != "batch"]
    return found or list(PARTITION_COLUMNS)


def read_access_log(
    spark: SparkSession,
    root: str,
    begin: str | datetime | None = None,
    end: str | datetime | None = None,
    hids: Sequence[int] | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """The published log, narrowed to the 5-minute buckets that touch [begin, end].

    ``by`` are the directory levels the log was published with (default: those found there). Buckets that do not exist contribute nothing; if none exists the result is
    empty. Rows are not cut at the exact second: that is
    :func:`hitledger.operators.search.in_time_range`.
    """
    begin, end = (None if t is None else parse_param(t) for t in (begin, end))
    if by is None:
        by = log_levels(spark, root)
    globs = partition_globs(begin, end, hids, by)
    log = _visible_log(spark, root, lambda: scan_log(spark, root, globs))
    if begin is not None and end is not None:
        log = log.where(in_buckets(begin, end))
    return log


def read_log_table(
    spark: SparkSession, table: str, root: str, begin: str | datetime | None = None, end: str | datetime | None = None
) -> DataFrame:
    """The published log through its catalog table: directories are pruned by the catalog, none is listed.

    Merges under way show every row once, as in :func:`read_access_log`.
    """
    begin, end = (None if t is None else parse_param(t) for t in (begin, end))

    def scan() -> DataFrame:
        spark.catalog.refreshTable(table)
        return spark.table(table)

    log = _visible_log(spark, root, scan).select(ACCESS_LOG_TABLE.names)
    if begin is not None and end is not None:
        log = log.where(in_buckets(begin, end))
    return log


def read_hour_stats(
    spark: SparkSession,
    root: str,
    table: str,
    begin: str | datetime | None = None,
    end: str | datetime | None = None,
    hids: Sequence[int | str] | None = None,
) -> DataFrame:
    """Hours of one hour table that touch [begin, end]; ``begin`` alone means its day."""
    if begin is not None:
        begin = parse_param(begin)
        if end is None:
            begin, end = begin.replace(hour=0, minute=0), begin.replace(hour=23, minute=59)
        end = parse_param(end)
    path = f"{root}/{table}"
    levels = Files(spark, path).levels(path) or ["hid", "d", "h"]
    stats = scan_stats(spark, path, table, partition_globs(begin, end, hids, levels), levels)
    if begin is None:
        return stats
    return stats.where(
        F.col("d").between(f"{begin:%y%m%d}", f"{end:%y%m%d}")
        & F.concat("d", "h").between(f"{begin:%y%m%d%H}", f"{end:%y%m%d%H}")
    )


def read_day_domains(spark: SparkSession, root: str, day: str | datetime | None = None) -> DataFrame:
    """Day domain statistics back from TSV: (domain, times, topdomain).

    Lines that do not have seven fields (no registrable domain) are left out.
    """
    glob = "hid=*" if day is None else f"hid=*/d={parse_param(day):%y%m%d}"

    def scan(path: str, globs: list[str]) -> DataFrame:
        found, schema = matching_paths(spark, [f"{path}/{g}" for g in globs]), "value string, hid string, d string"
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", path).text(found)

    field = F.split(F.rtrim("value", F.lit("\t")), "\t")
    return (
        read_partitions(spark, f"{root}/domain", [glob], scan, ["hid", "d"])
        .select(field.alias("field")).where(F.size("field") == 7)
        .select(
            F.col("field")[1].alias("domain"),
            F.col("field")[4].try_cast("bigint").alias("times"),
            F.col("field")[6].alias("topdomain"),
        )
    )


def list_input(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(hid, file_size) of raw line files, whose directory names the house (``.../1001/file``; else empty)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths.split(",") if isinstance(paths, str) else list(paths))
    house = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:hid=)?(\d+)/[^/]*$", 1)
    return found.select(house.alias("hid"), F.col("_metadata.file_size").alias("file_size"))


def list_files(spark: SparkSession, root: str, glob: str = "*.orc", within: Sequence[str] = ("",)) -> DataFrame:
    """One row per data file of the published log below the globs ``within``; file contents are not read.

    A partition level the layout does not have is an empty string.
    """
    path = F.col("_metadata.file_path")
    found = matching_paths(spark, [f"{root}/{g}" if g else root for g in within])
    if not found:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*LAYOUT_COLUMNS, "file_path")) + ", file_size bigint")
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(found)
    )
    levels = [F.regexp_extract(path, f"/{name}=([^/]*)/", 1).alias(name) for name in LAYOUT_COLUMNS]
    return listing.select(*levels, path.alias("file_path"), F.col("_metadata.file_size").alias("file_size"))


assert set(LAYOUT_COLUMNS) <= set(ACCESS_LOG_TABLE.names)
