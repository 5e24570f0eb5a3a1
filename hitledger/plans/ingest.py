"""One batch of raw lines into the published log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hitledger.operators.compaction import ingest_parallelism
from hitledger.operators.ingest import ingest_rows, sized
from hitledger.schema import PARTITION_COLUMNS
from hitledger.sinks.log_table import append, drop_partitions, publish, register_batch
from hitledger.sources.lines import parse_tolerant, read_lines
from hitledger.sources.tables import MERGED_BATCHES, list_input
from hitledger.streaming.ledger import REPROCESSED, note
from hitledger.workspace import Files, at_once


def run_ingest(
    spark: SparkSession, input_path: str, root: str, batch_id: str, load_time: str | datetime,
    zone: str | None = None, balance: bool = True, table: str | None = None,
    by: Sequence[str] = PARTITION_COLUMNS, task_mb: float | None = None,
) -> None:
    """Parse, drop late rows, publish. Safe to repeat for the same ``batch_id``.

    With ``task_mb`` each house gets write tasks by the bytes of its input files (one for so many MB in the hour of
    the load time, half as many for earlier hours), else Spark sizes them after the shuffle.

    Rows that the stream took from a minute directory of this name are replaced
    too, and the files read are noted, so that the stream does not bring them later. A batch that was merged with others is refused, since its rows cannot be
    told any more. With ``table``, the partitions written are registered there and replaced ones dropped.
    """
    files = Files(spark, root)
    if files.exists(f"{root}/{MERGED_BATCHES}"):
        merged = spark.read.schema("batch string").parquet(f"{root}/{MERGED_BATCHES}")
        taken = F.col("batch").startswith(f"{batch_id}.") | (F.col("batch") == batch_id)
        if not merged.where(taken).isEmpty():
            raise ValueError(f"batch {batch_id} was merged with others; it cannot be published again")
    # The files as they lie there now: exactly these are read and noted.
    taken = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(input_path.split(",")).select("_metadata.file_path")
    paths = [row.file_path for row in taken.collect()]
    lines = read_lines(spark, [unquote(path) for path in paths]) if paths else spark.createDataFrame([], "value string")
    rows = ingest_rows(lines, load_time, batch_id, zone)
    if task_mb is not None:
        tasks = ingest_parallelism(list_input(spark, input_path), task_mb)
        rows, balance = sized(rows, tasks.where("hid <> ''"), load_time, by=by), False
    publish(rows, root, by, balance=balance)
    levels = "/".join("*=*" for _ in by)
    if paths:
        entries = spark.createDataFrame([(path,) for path in paths], "file_path string")
        note(entries.select(F.lit(batch_id).alias("minute"), "file_path", F.lit(batch_id).alias("batch"), F.lit(REPROCESSED).alias("state")), root)
    streamed = files.glob(f"{root}/{levels}/batch={batch_id}.*")
    at_once([lambda folder=folder: files.remove(folder) for folder in streamed])
    if table is not None:
        start = len(files.qualified(root)) + 1
        drop_partitions(spark, table, [folder[start:] for folder in streamed])
        register_batch(spark, table, root, batch_id)


def run_append(
    spark: SparkSession, input_path: str, root: str, batch_id: str, zone: str | None = None,
    by: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Parse and append: no late rows dropped, nothing replaced."""
    rows = parse_tolerant(read_lines(spark, input_path), zone=zone)
    append(rows.withColumn("batch", F.lit(batch_id)), root, by)
