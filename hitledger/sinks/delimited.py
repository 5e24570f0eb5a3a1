"""Delimited text results, with their row counts taken on the way."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hitledger.sinks.replace import read_partitions, replace_partitions
from hitledger.workspace import matching_paths


def write_delimited(
    rows: DataFrame, path: str, sep: str = ",", files: int | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite ``path``; returns one row (path, row_count), counted during the write.

    Rows are counted in the writing stage, after any shuffle: there a task that
    has to be run again is still counted once.
    """
    seen = Observation("written")
    if files is not None:
        rows = rows.repartition(files)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("row_count"))
    writer = counted.write.mode("overwrite").option("sep", sep).option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.csv(path)
    row_count = int(seen.get["row_count"])
    return rows.sparkSession.createDataFrame([(path, row_count)], "path string, row_count bigint")


def house_lines(houses: DataFrame) -> DataFrame:
    """``houseid,housename`` as one text column."""
    return houses.select(F.concat_ws(",", "houseid", "housename").alias("value"))


def write_houses(houses: DataFrame, path: str) -> None:
    house_lines(houses).write.mode("overwrite").text(path)


def answer_lines(answers: DataFrame) -> DataFrame:
    fields = ["batchID", "domain", "curSec", "times"]
    shown = [F.coalesce(F.col(f).cast("string"), F.lit("null")) for f in fields]
    return answers.select(F.concat_ws("\t", *shown).alias("value"))


def append_answers(answers: DataFrame, path: str, question: str | None = None) -> None:
    """Add domain-count answers to a result log: tab-separated, CRLF line ends.

    The lines of a ``question`` (any text) replace those it left before; without one lines are added.
    """
    name = uuid.uuid4().hex if question is None else re.sub("[^0-9A-Za-z]", lambda c: f"_{ord(c[0]):x}_", question)
    write = lambda folder: answer_lines(answers).write.option("lineSep", "\r\n").text(f"{folder}/question={name}")
    replace_partitions(answers.sparkSession, path, write, [f"question={name}"], 1)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a result log as ``value``."""

    def scan(root: str, globs: list[str]) -> DataFrame:
        found, schema = matching_paths(spark, [f"{root}/{g}" for g in globs]), "value string, question string"
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", root).option("lineSep", "\r\n").text(found)

    return read_partitions(spark, path, ["question=*"], scan, ["question"]).select("value")
