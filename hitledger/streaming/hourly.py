"""Hour statistics kept up to date from a stream, without state or with it.

Measures merge, so no state is needed: each micro-batch stores its own partial
statistics, and reading merges them. Late rows count whenever they arrive, and a
retried batch replaces its own partials.

With state (:func:`start_closed_hours`) open hours are kept in the stream's state
store across batches and restarts, and an hour goes to the hour table once,
when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitledger.functions.times import parse_param
from hitledger.operators import rollup
from hitledger.schema import HOUR_TABLES
from hitledger.sinks.stat_tables import HOUR_PARTITIONS, write_hour_table
from hitledger.sources.tables import partition_globs, read_hour_stats
from hitledger.workspace import Files, at_once, matching_paths, stage_dir

#: Below the partials, where scans skip it: the fold under way, and the mark that it counts.
FOLD, READY = "_fold", "_ready"
PLAN = "folder string, out_root string"
KEYS = ["hid", "d", "h", "destip", "destport", "domain", "proctype"]

PARTIALS = (
    "hid int, destip string, destport string, domain string, proctype string, firsttime timestamp_ntz,"
    " activetime timestamp_ntz, times bigint, d string, h string, epoch bigint"
)


def start_hour_partials(log: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("d", "h")) -> StreamingQuery:
    """Partial ``ipportdomain`` statistics of every micro-batch of a log stream, by hour (a thin stream: by day)."""

    def write_partials(rows: DataFrame, number: int) -> None:
        partials = rollup.merge(rollup.hits(rows), KEYS).withColumn("epoch", F.lit(number))
        # Hours are brought together first: one file an hour and batch, not one a task.
        (
            partials.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by, "epoch").parquet(path)
        )

    return (
        log.writeStream.foreachBatch(write_partials).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_hour_partials(
    spark: SparkSession, path: str, begin: str | datetime | None = None, end: str | datetime | None = None
) -> DataFrame:
    """``ipportdomain`` hour statistics so far: the same rows a batch job would give.

    With ``begin`` and ``end`` only the hours that touch them are listed and read.
    """
    globs, inside = [""], F.lit(True)
    if begin is not None and end is not None:
        begin, end = parse_param(begin), parse_param(end)
        globs = partition_globs(begin, end, None, _levels(spark, path))
        inside = F.concat("d", "h").between(f"{begin:%y%m%d%H}", f"{end:%y%m%d%H}")
    found = matching_paths(spark, [f"{path}/{glob}" if glob else path for glob in globs])
    if not found:
        return rollup.hour_ipportdomain(spark.createDataFrame([], PARTIALS))
    partials = spark.read.schema(PARTIALS).option("basePath", path).parquet(*found)
    return rollup.hour_ipportdomain(partials.where(inside).drop("epoch"))


def _levels(spark: SparkSession, path: str) -> list[str]:
    """The levels of the partials above ``epoch``."""
    return [name for name in Files(spark, path).levels(path) if name != "epoch"] or ["d", "h"]


def _finish_fold(spark: SparkSession, path: str) -> None:
    """Carries out the fold that is staged below ``path``, if any; an unfinished stage goes. Repeating it changes nothing."""
    files, fold = Files(spark, path), f"{path}/{FOLD}"
    if files.exists(f"{fold}/{READY}"):
        plan = spark.read.schema(PLAN).parquet(f"{fold}/plan").collect()
        write_hour_table(spark.read.parquet(f"{fold}/stats"), f"{plan[0].out_root}/ipportdomain", by=files.read_text(f"{fold}/by").split(","))
        at_once([lambda f=f: files.remove(f"{path}/{f.folder}") for f in plan])
        files.remove(f"{fold}/{READY}")  # before the tables it speaks for
    files.remove(fold)


def fold_hours(
    spark: SparkSession, path: str, out_root: str, begin: str | datetime, end: str | datetime,
    by: Sequence[str] = HOUR_PARTITIONS,
) -> None:
    """Partials of closed hours: merged into what the hour table (of levels ``by``) holds, and out of the partials.

    Partials that were kept by day are folded by whole days between ``begin`` and ``end``. Only hours that have
    partials are replaced, so folding again or after late rows keeps
    what was folded before. The merged hours are staged and marked before anything is
    replaced or deleted; a fold that stopped is finished by the next call, with the
    ``out_root`` it began with. No batch of the stream and no other fold may be under way.
    """
    begin, end = parse_param(begin), parse_param(end)
    _finish_fold(spark, path)
    files, fold, levels = Files(spark, path), f"{path}/{FOLD}", _levels(spark, path)
    if "h" not in levels:
        begin = begin if begin.hour == 0 else begin.replace(hour=0) + timedelta(days=1)
        end = end if end.hour == 23 else end.replace(hour=23, minute=59) - timedelta(days=1)
    globs = partition_globs(begin, end, None, levels)
    found = [folder for glob in globs for folder in files.glob(f"{path}/{glob}{'/*=*' * (len(levels) + 1 - glob.count('='))}")]
    if not found:
        return
    start = len(files.qualified(path)) + 1
    plan = spark.createDataFrame([(folder[start:], out_root) for folder in found], PLAN)
    plan.write.parquet(f"{fold}/plan")
    files.write_text(f"{fold}/by", ",".join(by))
    new = read_hour_partials(spark, path, begin, end)
    old = read_hour_stats(spark, out_root, "ipportdomain", begin, end).alias("o").join(
        new.select(HOUR_PARTITIONS).distinct().alias("n"), F.expr(" and ".join(f"o.{c} <=> n.{c}" for c in HOUR_PARTITIONS)), "left_semi"
    )
    both = rollup.stored(old.select(new.columns).unionByName(new))
    rollup.hour_ipportdomain(both).write.parquet(f"{fold}/stats")
    files.make_marker(f"{fold}/{READY}")
    _finish_fold(spark, path)


def closed_hours(log: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Event-time variant for ``append`` mode: an hour is emitted once, when closed.

    Rows more than ``delay`` behind the newest event are dropped by the watermark,
    which is a different rule than lateness against load time; the newest hours
    stay open until later events arrive.
    """
    timed = log.withColumn("ts", F.col("acctime").try_cast("timestamp")).withWatermark("ts", delay)
    instant = F.col("acctime").try_cast("timestamp_ntz")
    stats = timed.groupBy(F.window("ts", "1 hour"), *KEYS).agg(
        F.min(instant).alias("firsttime"), F.max(instant).alias("activetime"),
        F.count(F.lit(1)).alias("times"),
    )
    return rollup.rendered(stats, [*KEYS, *rollup.MEASURES])


def start_closed_hours(
    log: DataFrame, out_root: str, checkpoint: str, delay: str = "2 hours", by: Sequence[str] = HOUR_PARTITIONS
) -> StreamingQuery:
    """Hours of a log stream into the ``ipportdomain`` hour table, each when it is closed.

    All of an hour is emitted by one batch, so a batch that is retried replaces the hours it wrote. Open hours stay in
    the state store below ``checkpoint``; a restart with the same checkpoint goes on with them.
    ``spark.sql.streaming.stateStore.providerClass`` chooses where a large state is held.
    """

    spark, stages = log.sparkSession, stage_dir(log.sparkSession, "closed-hours")

    def write_closed(rows: DataFrame, number: int) -> None:
        # Staged once: the table's writer goes over the hours more than once, and each time the batch would be parsed and
        # its state computed anew. Read in the caller's session, where rows are rebalanced; a stream's own session does not.
        staged = f"{stages}/{number}"
        rows.select(HOUR_TABLES["ipportdomain"].names).write.mode("overwrite").parquet(staged)
        write_hour_table(spark.read.schema(rows.select(HOUR_TABLES["ipportdomain"].names).schema).parquet(staged), f"{out_root}/ipportdomain", by=by)
        Files(spark, stages).remove(staged)

    return (
        closed_hours(log, delay).writeStream.outputMode("append").foreachBatch(write_closed)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
