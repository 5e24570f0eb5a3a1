"""Hourly statistics of any number of houses and hours in one pass.

The tree is staged through its own output tables: the wide log is aggregated
once, and each smaller table is computed from the stored rows of its parent.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists
from hitledger.functions.times import parse_param
from hitledger.operators import legality, rollup
from hitledger.sinks.stat_tables import HOUR_PARTITIONS, Hours, write_hour_table, write_hour_tsv
from hitledger.sources.tables import read_access_log, read_hour_stats
from hitledger.workspace import Files, stage_dir


def _hours(begin: str | datetime, end: str | datetime, hids: Sequence[int] | None) -> Hours:
    begin = parse_param(begin).replace(minute=0, second=0)
    end = parse_param(end).replace(minute=0, second=0) + timedelta(minutes=59, seconds=59)
    return Hours(begin, end, tuple(hids) if hids else None)


def run_hour_stats(
    spark: SparkSession,
    log_root: str,
    out_root: str,
    begin: str | datetime,
    end: str | datetime,
    suffixes: SuffixLists | DataFrame,
    foreign: Iterable[str] | DataFrame = (),
    hids: Sequence[int] | None = None,
    by: Sequence[str] = HOUR_PARTITIONS,
) -> None:
    """``ipportdomain`` -> ``ipport`` and ``domainip`` -> ``domain`` / ``foreigndomain``.

    All hours from ``begin`` to ``end`` are replaced, those without rows by nothing. The log may have any
    directory levels; ``by`` are those of the hour tables (house and day for a thin log).
    """
    hours = _hours(begin, end, hids)
    log = read_access_log(spark, log_root, hours.begin, hours.end, hids).where(hours.holds())
    read = lambda table: rollup.stored(read_hour_stats(spark, out_root, table, hours.begin, hours.end, hids))
    write_hour_table(rollup.hour_ipportdomain(rollup.hits(log)), f"{out_root}/ipportdomain", hours, by)
    base = read("ipportdomain")
    write_hour_table(rollup.hour_ipport(base), f"{out_root}/ipport", hours, by)
    write_hour_table(rollup.hour_domainip(base, suffixes), f"{out_root}/domainip", hours, by)
    # Staged, so that both halves of the split come from one aggregation.
    stage = stage_dir(spark, "hour-domains")
    domains = rollup.domain_of_domainip(read("domainip"), foreign)
    domains.write.parquet(stage)
    domestic, abroad = rollup.split_foreign(spark.read.schema(domains.schema).parquet(stage))
    write_hour_table(domestic, f"{out_root}/domain", hours, by)
    write_hour_tsv(abroad, f"{out_root}/foreigndomain", hours, by)
    Files(spark, stage).remove(stage)


def run_legal_hour_stats(
    spark: SparkSession,
    log_root: str,
    out_root: str,
    begin: str | datetime,
    end: str | datetime,
    suffixes: SuffixLists | DataFrame,
    house_ips: DataFrame,
    hids: Sequence[int] | None = None,
    by: Sequence[str] = HOUR_PARTITIONS,
) -> None:
    """The variant with house IPs: illegal accesses, and statistics of legal ones.

    The log is read once, into a staged table per IP, port and domain.
    """
    hours = _hours(begin, end, hids)
    log = read_access_log(spark, log_root, hours.begin, hours.end, hids).where(hours.holds())
    stage = stage_dir(spark, "legal-hours")
    staged = rollup.merge(rollup.hits(log), [*rollup.PERIOD, "destip", "destport", "domain", "proctype"])
    staged.write.parquet(stage)
    base = spark.read.schema(staged.schema).parquet(stage)
    write_hour_table(legality.hour_illegal(base, house_ips), f"{out_root}/illegLog", hours, by)
    write_hour_table(legality.legal_hour_ipport(base, house_ips), f"{out_root}/ipport", hours, by)
    write_hour_table(legality.legal_hour_domainip(base, house_ips, suffixes), f"{out_root}/domainip", hours, by)
    Files(spark, stage).remove(stage)
    per_ip = rollup.stored(read_hour_stats(spark, out_root, "domainip", hours.begin, hours.end, hids))
    domains = rollup.domain_of_domainip(per_ip, None).withColumn("isforeign", F.lit(0))
    write_hour_table(domains, f"{out_root}/domain", hours, by)
