"""Dimension files: suffixes, foreign suffixes, house IPs, houses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists

# Longest suffix list that becomes plan literals instead of a join side.
MAX_LITERALS = 2_000


def _three_fields(spark: SparkSession, path: str, sep: str) -> DataFrame:
    field = F.split(F.rtrim("value", F.lit(sep)), sep)
    return spark.read.text(path).select(field.alias("f")).where(F.size("f") == 3)


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """TSV of three fields -> (kind, value); kind is ``in``, ``area`` or ``country``."""
    f = F.col("f")
    return _three_fields(spark, path, "\t").select(f[0].alias("kind"), f[1].alias("value"))


def as_suffix_lists(suffixes: DataFrame, limit: int = MAX_LITERALS) -> SuffixLists | DataFrame:
    """Literals if the list is short enough, else the list itself, to be joined."""
    rows = suffixes.where(F.col("kind").isin("in", "area", "country")).distinct().take(limit + 1)
    if len(rows) > limit:
        return suffixes
    return SuffixLists.of(rows)


def read_foreign_suffixes(
    spark: SparkSession, path: str | None, limit: int = MAX_LITERALS
) -> list[str] | DataFrame:
    """``suffix-name-x`` lines -> suffixes, to be joined if there are many. No file: none."""
    if not path:
        return []
    suffixes = _three_fields(spark, path, "-").select(F.col("f")[0].alias("suffix")).distinct()
    rows = suffixes.take(limit + 1)
    if len(rows) > limit:
        return suffixes
    return sorted(r["suffix"] for r in rows)


def read_house_ips(spark: SparkSession, path: str) -> DataFrame:
    """One address per line -> (hip)."""
    return spark.read.text(path).select(F.col("value").alias("hip"))


def read_houses(spark: SparkSession, path: str) -> DataFrame:
    """``houseid,housename`` lines -> (houseid, housename)."""
    return spark.read.csv(path, schema="houseid string, housename string")


def read_houses_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The same list from the operator's database."""
    query = f"select houseid, housename from {table}"
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
