"""Carry out a merge plan on the published log without a reader noticing.

A merge leaves its state under ``<root>/_merge/<id>`` (scans skip names that
start with an underscore) and takes these steps:

1. ``plan``: which files go into which merged file.
2. mark ``_hidden``: readers leave rows with this merge's label out, while the
   merged files are written beside the old ones and counted.
3. mark ``_shown`` instead, one rename: readers now take the merged files and leave the planned ones out.
4. planned files are deleted, then the state.

:func:`hitledger.sources.tables.read_access_log` goes by these marks, so at any
moment it sees every row once. Repeating a merge with the same id resumes it.
What was merged no longer knows its batches; their names are kept under
``<root>/_merged``, and publishing one of them again is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from hitledger.schema import ACCESS_LOG_TABLE, PARTITION_COLUMNS, QUERY_COLUMNS
from hitledger.sinks.log_table import add_partitions, drop_partitions, orc_writer, stored_partitions, stored_rows
from hitledger.sources.tables import HIDDEN, MERGED_BATCHES, SHOWN, list_files, scan_log
from hitledger.workspace import Files, at_once

#: Planned files up to this number (about 100 bytes each) may be broadcast.
BROADCAST_FILES = 500_000


def planned_rows(
    spark: SparkSession,
    root: str,
    plan: DataFrame,
    max_file_bytes: int | None = None,
    only: Column | None = None,
    within: Sequence[str] = ("",),
) -> DataFrame:
    """Rows of the planned files, each with the merged file it belongs to (``batch``).

    Only directories ``within`` are listed, and only planned files matter, so
    larger ones are left out at file listing. Rows of a target are dealt out
    evenly over its output files.
    """
    stored = scan_log(spark, root, within)
    if max_file_bytes is not None:
        stored = stored.where(F.col("_metadata.file_size") <= max_file_bytes)
    if only is not None:
        stored = stored.where(only)
    rows = stored.select(
        *QUERY_COLUMNS, *PARTITION_COLUMNS,
        F.col("_metadata.file_path").alias("file_path"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    place = plan.select("file_path", "target", "outputs")
    label = F.concat(F.lit("merge-"), F.sha2("target", 256).substr(1, 16), F.lit("-"), F.pmod("row_no", "outputs").cast("string"))
    return rows.join(place, "file_path").withColumn("batch", label).drop("file_path", "row_no", "target", "outputs")


def merge_files(
    spark: SparkSession,
    root: str,
    merge_id: str,
    make_plan: Callable[[DataFrame], DataFrame],
    only: Column | None = None,
    by: Sequence[str] = PARTITION_COLUMNS,
    within: Sequence[str] = ("",),
    table: str | None = None,
) -> int:
    """List, plan, write, verify, show, delete; returns how many files were merged away.

    ``within`` (globs below ``root``) are the directories that are listed,
    ``only`` is a further condition on hid/d/h/m5, ``by`` are the directory
    levels the log was published with. ``merge_id`` is a file name. The catalog table ``table`` learns of the
    merged partitions before they count, and forgets planned ones that are gone; its readers go through
    :func:`hitledger.sources.tables.read_log_table`.
    """
    work = f"{root}/_merge/{merge_id}"
    files = Files(spark, root)
    if not files.exists(f"{work}/plan/_SUCCESS"):
        listing = list_files(spark, root, within=within)
        make_plan(listing if only is None else listing.where(only)).write.mode("overwrite").parquet(f"{work}/plan")
    plan = spark.read.parquet(f"{work}/plan")
    largest, n_files = plan.agg(F.max("file_size"), F.count(F.lit(1))).first()
    if not n_files:
        files.remove(work)
        return 0

    if not files.exists(f"{work}/{SHOWN}"):
        files.make_marker(f"{work}/{HIDDEN}")
        _write_merged(spark, root, merge_id, F.broadcast(plan) if n_files <= BROADCAST_FILES else plan, largest, only, by, within)
        batches = plan.select(F.regexp_extract("file_path", "/batch=([^/]*)/", 1).alias("batch")).distinct()
        batches.write.mode("append").parquet(f"{root}/{MERGED_BATCHES}")
        if table is not None:
            add_partitions(spark, table, stored_partitions(spark, root, batch=f"{merge_id}-merge-*"))
        files.move(f"{work}/{HIDDEN}", f"{work}/{SHOWN}")

    planned = _folders(files, root, plan)
    _delete_all(spark, root, plan)
    if table is not None:
        drop_partitions(spark, table, planned - stored_partitions(spark, root))
    files.remove(work)
    return int(n_files)


def _folders(files: Files, root: str, plan: DataFrame) -> set[str]:
    """The partition directories of planned files."""
    rows = plan.select(F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")).distinct().toLocalIterator()
    start = len(files.qualified(root)) + 1
    return {files.qualified(row["folder"])[start:] for row in rows}


def _write_merged(spark, root, merge_id, plan, largest, only, by, within) -> None:
    rows = planned_rows(spark, root, plan, largest, only, within)
    seen = Observation("merged")
    labelled = stored_rows(rows).withColumn("batch", F.concat(F.lit(f"{merge_id}-"), "batch")).repartition(*by, "batch")
    counted = labelled.observe(seen, F.count(F.lit(1)).alias("n"))
    orc_writer(counted, by, "overwrite").option("partitionOverwriteMode", "dynamic").orc(root)
    merged = scan_log(spark, root, within).where(F.col("batch").startswith(f"{merge_id}-merge-"))
    before, after = int(seen.get["n"]), merged.count()
    if before != after:
        raise RuntimeError(f"merge {merge_id}: {before} rows read, {after} written; nothing was swapped")


def _delete_all(spark: SparkSession, root: str, plan: DataFrame) -> None:
    """Directories that hold planned files only go whole, one call each; others file by file."""
    files = Files(spark, root)

    def delete(row: Row) -> None:
        present = {files.qualified(f) for f in files.glob(f"{row['folder']}/[!_.]*")}
        own = {files.qualified(f) for f in row["own"]}
        if present <= own:
            files.remove(row["folder"])
        else:
            for file in own & present:
                files.remove(file)

    folder = F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")
    rows = plan.groupBy(folder).agg(F.collect_list("file_path").alias("own")).toLocalIterator()
    at_once([lambda row=row: delete(row) for row in rows])
