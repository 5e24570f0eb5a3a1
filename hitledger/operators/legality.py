"""Access to addresses a house has registered ("legal") and to all others.

House IP lists are semi- and anti-joined without a hint: Spark broadcasts a list
that is small enough, and then filters log rows before the aggregation; a longer
list is shuffled and meets the aggregated rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists, add_top_domain, is_well_formed
from hitledger.operators.rollup import hour_domain, hour_domainip, hour_ipport


def flag_legal(log: DataFrame, house_ips: DataFrame, suffixes: SuffixLists | DataFrame | None = None) -> DataFrame:
    """Log rows with ``iflegal`` (1/0) and, given suffixes, ``topdomain``.

    Repeated addresses in the list do not multiply rows.
    """
    known = house_ips.select("hip").distinct()
    flagged = (
        log.join(known, F.col("destip") == F.col("hip"), "left")
        .withColumn("iflegal", F.col("hip").isNotNull().cast("int")).drop("hip")
    )
    return flagged if suffixes is None else add_top_domain(flagged, suffixes)


def legal_only(rows: DataFrame, house_ips: DataFrame) -> DataFrame:
    return rows.join(house_ips, rows["destip"] == house_ips["hip"], "left_semi")


def illegal_only(rows: DataFrame, house_ips: DataFrame) -> DataFrame:
    return rows.join(house_ips, rows["destip"] == house_ips["hip"], "left_anti")


def hour_illegal(log: DataFrame, house_ips: DataFrame) -> DataFrame:
    """Distinct (domain, destip) of well-formed domains on unregistered addresses."""
    keys = [F.col("hid").cast("string").alias("hid"), "d", "h", "domain", "destip"]
    seen = log.where(is_well_formed()).select(*keys).distinct()
    return illegal_only(seen, house_ips)


def legal_hour_ipport(hit_rows: DataFrame, house_ips: DataFrame) -> DataFrame:
    return legal_only(hour_ipport(hit_rows), house_ips)


def legal_hour_domainip(
    hit_rows: DataFrame, house_ips: DataFrame, suffixes: SuffixLists | DataFrame
) -> DataFrame:
    return legal_only(hour_domainip(hit_rows, suffixes), house_ips)


def legal_hour_domain(domainip: DataFrame, suffixes: SuffixLists | DataFrame) -> DataFrame:
    """Per domain, from legal ``domainip`` rows; no foreign flag in this variant."""
    return hour_domain(domainip, suffixes, foreign=None)
