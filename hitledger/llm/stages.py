"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.workspace import Files, stage_dir


class Stages:
    """Named Parquet tables of one run below ``spark.checkpoint.dir``.

    A table that is written and read back cuts lineage: executors that are lost
    later cost a re-read, not the work before it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = stage_dir(spark, name)
        self._made = 0

    def folder(self, name: str) -> str:
        self._made += 1
        return f"{self.root}/{self._made:03d}-{name}"

    def write(self, frame: DataFrame, name: str, **options: str) -> DataFrame:
        path = self.folder(name)
        frame.write.options(**options).parquet(path)
        table = self.spark.read.schema(frame.schema).parquet(path)
        table.stage_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that nothing reads any more."""
        for table in tables:
            Files(self.spark, self.root).remove(table.stage_path)


def fits(frame: DataFrame, rows: int) -> bool:
    """Whether ``frame`` has at most so many rows: the check before a broadcast."""
    return frame.limit(rows + 1).count() <= rows


def maybe_broadcast(frame: DataFrame, rows: int) -> DataFrame:
    """``frame``, marked for broadcast if it was counted to be within ``rows``; else Spark joins by shuffle."""
    return F.broadcast(frame) if fits(frame, rows) else frame


def _aside(rows: DataFrame, names: tuple[str, ...]) -> dict[str, str]:
    """Other names for columns that are called like one of ``names``, in any case."""
    own, taken = {n.lower() for n in names}, {c.lower() for c in rows.columns}
    found: dict[str, str] = {}
    for column in rows.columns:
        if column.lower() in own:
            other = f"{column}__own"
            while other.lower() in taken:
                other += "_"
            taken.add(other.lower())
            found[column] = other
    return found


def adds(*results: str, hidden: tuple[str, ...] = ()) -> Callable:
    """For an operator on rows that adds ``results``: a caller's column of such a name gives way to the result's.

    ``hidden`` are names the operator uses on the way; a caller's column called like one keeps its name and values.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(rows: DataFrame, *args, **options) -> DataFrame:
            rows = rows.drop(*_aside(rows, results))
            aside = _aside(rows, hidden)
            found = operator(rows.withColumnsRenamed(aside), *args, **options)
            return found.withColumnsRenamed({new: old for old, new in aside.items()})

        return run

    return wrap


def keeps(*names: str) -> Callable:
    """For an operator that returns the caller's columns: those called like ``names``, which it uses on the way, keep name and values."""

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(rows: DataFrame, *args, **options) -> DataFrame:
            aside = _aside(rows, names)
            found = operator(rows.withColumnsRenamed(aside), *args, **options)
            return found.withColumnsRenamed({new: old for old, new in aside.items()})

        return run

    return wrap
