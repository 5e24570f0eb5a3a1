"""Which 5-minute partitions should exist, and which do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.schema import PARTITION_COLUMNS

BUCKETS_PER_DAY = 24 * 12


def expected_partitions(house_days: DataFrame) -> DataFrame:
    """Every (hid, d) becomes its 288 five-minute partitions; no join involved."""
    slot = F.explode(F.sequence(F.lit(0), F.lit(BUCKETS_PER_DAY - 1)))
    two_digits = lambda n: F.lpad(n.cast("string"), 2, "0")
    slots = house_days.select(F.col("hid").cast("string").alias("hid"), "d", slot.alias("slot"))
    return slots.select(
        "hid", "d",
        two_digits(F.expr("slot div 12")).alias("h"),
        two_digits(F.col("slot") % 12 * 5).alias("m5"),
    )


def expected_for_day(houses: DataFrame, day: str) -> DataFrame:
    """Partitions of all houses (``houseid``) for one day (yyyyMMdd)."""
    return expected_partitions(houses.select(F.col("houseid").alias("hid"), F.lit(day[2:8]).alias("d")))


def partition_paths(partitions: DataFrame) -> DataFrame:
    parts = [F.concat(F.lit(f"/{name}="), name) for name in PARTITION_COLUMNS]
    return partitions.select(F.concat(*parts).alias("path"))


def present_partitions(rows: DataFrame) -> DataFrame:
    """Distinct partitions of log rows or of a file listing."""
    return rows.select(F.col("hid").cast("string").alias("hid"), *PARTITION_COLUMNS[1:]).distinct()


def missing_partitions(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present, PARTITION_COLUMNS, "left_anti")
