"""Raw files into the published log, each file exactly once.

The checkpoint remembers which files were taken. Files that turn up later, in a
minute directory already taken, simply form a new batch. A batch that is retried
replaces its own output, because its label ends with the batch number; it begins
with the minute directory, so that a batch job over that directory replaces it.
Files that such a job has read are left out (:mod:`hitledger.streaming.ledger`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitledger.functions.times import instant_in
from hitledger.operators.ingest import drop_late_by
from hitledger.schema import PARTITION_COLUMNS
from hitledger.sinks.log_table import publish
from hitledger.sources.lines import parse_tolerant
from hitledger.streaming.ledger import without_reprocessed


# A file counts however much older it is than the newest one: restored files have old times.
ANY_AGE = "1000000d"


def line_stream(
    spark: SparkSession, glob: str, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """New lines below ``glob`` with the file they came from; taken files move to ``archive`` if given."""
    reader = spark.readStream.format("text").option("maxFileAge", ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(glob).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def minute_of(file_path: str = "file_path") -> Column:
    """The minute directory of a file, empty if there is none."""
    return F.regexp_extract(file_path, r"[/=](\d{12})[^/]*/", 1)


def load_time_of(file_path: str = "file_path", modified: str = "modified", zone: str | None = None) -> Column:
    """Load time of a line: its minute directory (yyyyMMddHHmm), else its file's time in ``zone``, like the lines' own."""
    minute = minute_of(file_path)
    text = F.concat(
        minute.substr(1, 4), F.lit("-"), minute.substr(5, 2), F.lit("-"), minute.substr(7, 2), F.lit(" "),
        minute.substr(9, 2), F.lit(":"), minute.substr(11, 2), F.lit(":00"),
    )
    return F.coalesce(text.try_cast("timestamp_ntz"), instant_in(F.col(modified), zone))


def fit_rows(lines: DataFrame, zone: str | None = None) -> DataFrame:
    """Parsed rows, late ones dropped against their own load time."""
    with_load = lines.select("value", "file_path", load_time_of(zone=zone).alias("load_time"), minute_of().alias("minute"))
    parsed = parse_tolerant(with_load, "file_path", "load_time", "minute", zone=zone)
    return drop_late_by(parsed, F.col("load_time")).drop("load_time")


def start_intake(
    spark: SparkSession,
    glob: str,
    root: str,
    checkpoint: str,
    *,
    name: str = "intake",
    zone: str | None = None,
    max_files: int | None = None,
    by: Sequence[str] = PARTITION_COLUMNS,
    balance: bool = True,
    archive: str | None = None,
) -> StreamingQuery:
    """Take everything that is there, then stop; schedule it as often as needed."""

    def publish_batch(rows: DataFrame, number: int) -> None:
        rows = without_reprocessed(rows, root, number)
        minute = F.when(F.col("minute") != "", F.col("minute")).otherwise(name)
        label = F.concat(minute, F.lit(f".{number:010d}"))
        publish(rows.withColumn("batch", label).drop("minute", "file_path"), root, by, balance)

    rows = fit_rows(line_stream(spark, glob, max_files, archive), zone)
    return (
        rows.writeStream.foreachBatch(publish_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
