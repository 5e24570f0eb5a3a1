"""Which files to merge into how many: plans over the file listing.

A plan has a row per file to be merged: partition columns, ``file_path``,
``file_size``, ``target`` (which merged file it goes to) and ``outputs`` (over
how many files that target is spread). The listing is a DataFrame with a row per
file, so plans for many partitions are made in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping
from types import MappingProxyType

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.schema import PARTITION_COLUMNS

MB = 1024 * 1024

# Size limits in MB.
SMALL_FILE_MB = 80
MERGED_FILE_MB = 120
COALESCE_BELOW_MB = 50
COALESCE_OUTPUT_MB = 50
REWRITE_OUTPUT_MB = 100
CLASS_LIMITS_MB = {"le25": (0, 25), "le42": (25, 42), "le64": (42, 64)}

_PLAN_COLUMNS = [*PARTITION_COLUMNS, "file_path", "file_size", "target", "outputs"]
_PLAN_SCHEMA = (
    "hid string, d string, h string, m5 string, file_path string, file_size bigint, target string, outputs int"
)


def pack(files: list[tuple[int, str]], limit: int) -> list[list[str]]:
    """Bins of file names, every bin's size below ``limit``.

    Files are placed from the largest down, each into the fullest bin that still
    takes it; equal sizes go by name, descending.
    """
    bins: list[list[str]] = []
    by_size: list[tuple[int, str, int]] = []  # (bin size, newest name, bin number)
    for size, name in sorted(files, reverse=True):
        at = bisect_left(by_size, (limit - size,)) - 1
        if at >= 0:
            filled, _, number = by_size.pop(at)
        else:
            filled, number = 0, len(bins)
            bins.append([])
        bins[number].append(name)
        insort(by_size, (filled + size, name, number))
    return bins


def _pack_group(group: pa.Table) -> pa.Table:
    rows = group.to_pydict()
    bins = pack(list(zip(rows["file_size"], rows["file_path"])), rows["bin_limit"][0])
    target = {name: min(b) for b in bins if len(b) > 1 for name in b}
    targets = pa.array([target.get(name) for name in rows["file_path"]], pa.string())
    planned = group.drop_columns(["bin_limit"]).append_column("target", targets)
    planned = planned.filter(targets.is_valid())
    return planned.append_column("outputs", pa.array([1] * len(planned), pa.int32()))


def _bin_limit(default_mb: float, house_mb: Mapping[str, float]) -> Column:
    limit = F.lit(int(default_mb * MB))
    for house, mb in house_mb.items():
        limit = F.when(F.col("hid") == house, int(mb * MB)).otherwise(limit)
    return limit


def plan_bin_packing(
    listing: DataFrame,
    small_mb: float = SMALL_FILE_MB,
    merged_mb: float = MERGED_FILE_MB,
    house_merged_mb: Mapping[str, float] = MappingProxyType({}),
) -> DataFrame:
    """Merge small files of a partition into files below ``merged_mb`` (or what ``house_merged_mb`` has for the house).

    Packing is sequential, so it runs once per partition, on (name, size) pairs.
    A merged file is named after the first of its files.
    """
    small = listing.where(F.col("file_size") < int(small_mb * MB))
    return (
        small.withColumn("bin_limit", _bin_limit(merged_mb, house_merged_mb))
        .select(*PARTITION_COLUMNS, "file_path", "file_size", "bin_limit")
        .groupBy(*PARTITION_COLUMNS).applyInArrow(_pack_group, _PLAN_SCHEMA)
    )


def size_class(file_size: str = "file_size") -> Column:
    """Class of a file by size; null above the largest class."""
    size = F.col(file_size)
    result = F.lit(None).cast("string")
    for name, (_, high) in sorted(CLASS_LIMITS_MB.items(), key=lambda kv: -kv[1][1]):
        result = F.when(size <= high * MB, name).otherwise(result)
    return result


def class_outputs(listing: DataFrame) -> DataFrame:
    """Per partition and size class: files, bytes and merged files to write (0: leave)."""
    n = F.col("files")
    outputs = (
        F.when(n < 2, 0)
        .when(F.col("size_class") == "le64", F.ceil(n / 2))
        .when((F.col("size_class") == "le42") & (n > 3), F.expr("files div 3 + 1"))
        .otherwise(1)
    )
    counted = (
        listing.withColumn("size_class", size_class()).where(F.col("size_class").isNotNull())
        .groupBy(*PARTITION_COLUMNS, "size_class")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
    )
    return counted.withColumn("outputs", outputs.cast("int"))


def plan_size_classes(listing: DataFrame) -> DataFrame:
    """Merge files of like size."""
    keys = [*PARTITION_COLUMNS, "size_class"]
    outputs = class_outputs(listing).where(F.col("outputs") > 0).select(*keys, "outputs")
    classed = listing.withColumn("size_class", size_class())
    return classed.join(outputs, keys).withColumn("target", F.col("size_class")).select(*_PLAN_COLUMNS)


def partition_count(size_bytes: Column, size_mb: float) -> Column:
    """Output files of about ``size_mb`` for so many bytes."""
    return F.ceil(size_bytes / (size_mb * MB)).cast("int")


def total_outputs(listing: DataFrame, size_mb: float) -> DataFrame:
    """Per partition: files, bytes and output files of about ``size_mb``."""
    totals = listing.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")
    )
    return totals.withColumn("outputs", partition_count(F.col("bytes"), size_mb))


def ingest_parallelism(listing: DataFrame, size_mb: float, older_share: int = 2) -> DataFrame:
    """Per house: write tasks for the current hour, and fewer for the hour before."""
    current = partition_count(F.sum("file_size"), size_mb)
    counts = listing.groupBy("hid").agg(F.sum("file_size").alias("bytes"), current.alias("current_hour"))
    older = F.greatest(F.lit(1), F.expr(f"current_hour div {older_share}")).cast("int")
    return counts.withColumn("previous_hour", older)


def _plan_totals(listing: DataFrame, size_mb: float, min_files: int) -> DataFrame:
    outputs = total_outputs(listing, size_mb).where(F.col("files") >= min_files)
    plan = listing.join(outputs.select(*PARTITION_COLUMNS, "outputs"), PARTITION_COLUMNS)
    return plan.withColumn("target", F.lit("all")).select(*_PLAN_COLUMNS)


def plan_small_files(
    listing: DataFrame, below_mb: float = COALESCE_BELOW_MB, output_mb: float = COALESCE_OUTPUT_MB
) -> DataFrame:
    """Merge all files below a size into files of about ``output_mb``."""
    return _plan_totals(listing.where(F.col("file_size") < int(below_mb * MB)), output_mb, 2)


def plan_rewrite(listing: DataFrame, output_mb: float = REWRITE_OUTPUT_MB) -> DataFrame:
    """Rewrite whole partitions as files of about ``output_mb``."""
    return _plan_totals(listing, output_mb, 1)
