"""Cells of a wide-column table in files: the newest value of every (row key, family, qualifier) counts.

Every batch adds a directory of its own, dealt into buckets by row key, and
replaces nothing; a retried batch replaces itself. Readers take the newest
version of each cell. :func:`compact_cells` merges batches into one that holds the newest
versions only, shown in one step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitledger.sinks.replace import read_partitions, replace_partitions
from hitledger.workspace import Files, matching_paths

BUCKETS = 16
KEY = ["rowkey", "family", "qualifier"]
CELLS = "rowkey string, family string, qualifier string, value string, version bigint, batch string, bucket int"
#: The last batch that was merged into others: it and earlier ones are not written again.
MERGED = "_merged_up_to"


def _bucket(rowkey: str = "rowkey"):
    return F.pmod(F.xxhash64(rowkey), F.lit(BUCKETS)).cast("int")


def put_cells(cells: DataFrame, path: str, batch_id: str) -> None:
    """Write one batch of cells; repeating a batch replaces it, unless it was merged with others: then it is left alone.

    Without a column ``version`` the batch number is the version (later batches are newer), with it that column is.
    """
    spark, files = cells.sparkSession, Files(cells.sparkSession, path)
    if files.exists(f"{path}/{MERGED}") and batch_id <= files.read_text(f"{path}/{MERGED}"):
        return
    if "version" not in cells.columns:
        cells = cells.withColumn("version", F.lit(batch_id).cast("bigint"))
    rows = newest(cells.select(*KEY, "value", "version")).withColumn("bucket", _bucket())
    write = lambda folder: rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/batch={batch_id}")
    replace_partitions(spark, path, write, [f"batch={batch_id}"], 1)


def newest(cells: DataFrame) -> DataFrame:
    """One row a cell: the highest version, of equal ones the largest value (null: smallest)."""
    best = F.max(F.struct("version", "value")).alias("best")
    return cells.groupBy(*KEY).agg(best).select(*KEY, "best.value", "best.version")


def _stored(spark: SparkSession, path: str, glob: str) -> DataFrame:
    def scan(root: str, globs: list[str]) -> DataFrame:
        found = matching_paths(spark, [f"{root}/{g}" for g in globs])
        return spark.read.schema(CELLS).option("basePath", root).parquet(*found) if found else spark.createDataFrame([], CELLS)

    return read_partitions(spark, path, [glob], scan, ["batch"])


def read_cells(spark: SparkSession, path: str, rowkey: str | None = None) -> DataFrame:
    """(rowkey, family, qualifier, value) as they are now; of one row key, only its bucket is read."""
    cells = _stored(spark, path, "batch=*")
    if rowkey is not None:
        bucket = spark.range(1).select(_bucket(F.lit(rowkey))).first()[0]
        cells = cells.where((F.col("bucket") == bucket) & (F.col("rowkey") == rowkey))
    return newest(cells).select(*KEY, "value")


def compact_cells(spark: SparkSession, path: str) -> int:
    """All batches merged into the last one, superseded cells left out; returns how many batches there were."""
    files = Files(spark, path)
    batches = sorted(name.split("=", 1)[1] for name in files.folders(path))
    if len(batches) < 2:
        return len(batches)
    rows = newest(_stored(spark, path, "batch=*")).withColumn("bucket", _bucket())

    def write(folder: str) -> None:
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/batch={batches[-1]}")
        files.write_text(f"{path}/{MERGED}", batches[-1])

    replace_partitions(spark, path, write, [f"batch={{{','.join(batches)}}}"], 1)
    return len(batches)


def cell_writer(path: str) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``."""
    return lambda cells, epoch: put_cells(cells, path, f"{epoch:010d}")


def start_cells(cells: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of cells into the table at ``path``, batch by batch."""
    return (
        cells.writeStream.foreachBatch(cell_writer(path)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

