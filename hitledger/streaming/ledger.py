"""Which files of a minute directory a batch job has read, so that the stream does not read them again.

A stream takes every file once; a batch job over a minute directory replaces all that the stream
took from it and reads whatever lies there, also files the stream has not come to.
The job lists these files in the ledger (``<root>/_ledger``, which scans skip). The stream leaves rows of listed
files out and notes them as ``skipped``; other files of such a directory are late ones: they
are taken, and the directory is noted as ``reopened``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.workspace import Files

LEDGER = "_ledger"
ENTRY = "minute string, file_path string, batch string, state string"
REPROCESSED, SKIPPED, REOPENED = "reprocessed", "skipped", "reopened"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(minute, file_path, batch, state), an entry once however often its batch was retried."""
    path = f"{root}/{LEDGER}"
    if not Files(spark, root).exists(path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(path).distinct()


def note(entries: DataFrame, root: str) -> None:
    entries.selectExpr(*(field.split()[0] for field in ENTRY.split(", "))).write.mode("append").parquet(f"{root}/{LEDGER}")


def without_reprocessed(rows: DataFrame, root: str, number: int) -> DataFrame:
    """Rows (minute, file_path, ...) of one stream batch whose files no batch job has read; skipped files and reopened minutes are noted."""
    spark = rows.sparkSession
    listed = read_ledger(spark, root).where(F.col("state") == REPROCESSED)
    if listed.isEmpty():
        return rows
    read = listed.select("file_path").distinct()
    minutes = listed.select("minute").distinct()
    touched = rows.select("minute", "file_path").distinct().join(minutes, "minute", "left_semi")
    seen = touched.join(read.withColumn("known", F.lit(True)), "file_path", "left")
    state = F.when(F.col("known"), SKIPPED).otherwise(REOPENED).alias("state")
    note(seen.select("minute", "file_path", F.lit(f"{number:010d}").alias("batch"), state), root)
    return rows.join(read, "file_path", "left_anti")
