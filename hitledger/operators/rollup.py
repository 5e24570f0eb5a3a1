"""The statistics tree.

Every statistic is (first time, last time, hits) over some key. These measures
merge: a statistic can be built from log rows, from a finer statistic, or from
the same statistic of shorter periods, with one function.

Times are aggregated as ``timestamp_ntz``: a minimum over text would make Spark
sort the whole input instead of hashing it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists, add_foreign, add_top_domain, is_well_formed
from hitledger.functions.times import as_instant

PERIOD = ["hid", "d", "h"]
MEASURES = ["firsttime", "activetime", "times"]

_IPPORTDOMAIN = ["destip", "destport", "domain", "proctype"]
_IPPORT = ["destip", "destport", "proctype"]
_DOMAINIP = ["domain", "destip"]


def hits(log: DataFrame) -> DataFrame:
    """Log rows as statistics of one hit each."""
    instant = as_instant("acctime")
    return log.withColumns({"firsttime": instant, "activetime": instant, "times": F.lit(1).cast("bigint")})


def stored(stats: DataFrame) -> DataFrame:
    """Statistics read back from a table."""
    return stats.withColumns({name: as_instant(name) for name in ("firsttime", "activetime")})


def merge(stats: DataFrame, keys: Sequence[str], **extra: Column) -> DataFrame:
    return stats.groupBy(*keys).agg(
        F.min("firsttime").alias("firsttime"),
        F.max("activetime").alias("activetime"),
        F.sum("times").alias("times"),
        *[column.alias(name) for name, column in extra.items()],
    )


def rendered(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Times as text again. Hours and days of unreadable times ("0", "-1") show that mark."""
    # Years of more than four digits get no sign.
    text = {name: F.ltrim(F.col(name).cast("string"), F.lit("+")) for name in ("firsttime", "activetime")}
    mark = next((name for name in ("d", "day") if name in stats.columns), None)
    if mark:
        text = {name: F.coalesce(column, mark) for name, column in text.items()}
    if "hid" in columns:
        text["hid"] = F.col("hid").cast("string")
    return stats.withColumns(text).select(*columns)


def _ordered(*names: str) -> list[str]:
    return [*PERIOD, *names]


# ---- hour level -----------------------------------------------------------


def hour_ipportdomain(stats: DataFrame) -> DataFrame:
    return rendered(merge(stats, [*PERIOD, *_IPPORTDOMAIN]), _ordered(*_IPPORTDOMAIN, *MEASURES))


def hour_ipport(stats: DataFrame) -> DataFrame:
    return rendered(merge(stats, [*PERIOD, *_IPPORT]), _ordered(*_IPPORT, *MEASURES))


def _domainip(stats: DataFrame) -> DataFrame:
    # Protocol stays a key in the first step, so the wide step hashes; only its
    # result meets the maximum over text.
    clean = stats.where(is_well_formed())
    per_protocol = merge(clean, [*PERIOD, *_DOMAINIP, "proctype"])
    return merge(per_protocol, [*PERIOD, *_DOMAINIP], proctype=F.max("proctype"))


def hour_domainip(stats: DataFrame, suffixes: SuffixLists | DataFrame) -> DataFrame:
    """Well-formed domains only; the registrable domain is derived per result row."""
    with_top = add_top_domain(_domainip(stats), suffixes)
    return rendered(with_top, _ordered("domain", "topdomain", "destip", *MEASURES, "proctype"))


def hour_domain(
    domainip: DataFrame, suffixes: SuffixLists | DataFrame, foreign: Iterable[str] | DataFrame | None = ()
) -> DataFrame:
    """Per domain, from well-formed rows of log hits or of ``domainip``.

    ``topdomain`` follows from the domain, so it is derived, not aggregated.
    ``foreign=None`` leaves the foreign flag out.
    """
    per_ip = merge(domainip.where(is_well_formed()), [*PERIOD, *_DOMAINIP])
    stats = add_top_domain(merge(per_ip, [*PERIOD, "domain"], destip=F.max("destip")), suffixes)
    return _flagged(stats, foreign)


def domain_of_domainip(domainip: DataFrame, foreign: Iterable[str] | DataFrame | None = ()) -> DataFrame:
    """The same from stored ``domainip`` rows: unique by address already, with their registrable domain."""
    return _flagged(merge(domainip, [*PERIOD, "domain", "topdomain"], destip=F.max("destip")), foreign)


def _flagged(stats: DataFrame, foreign: Iterable[str] | DataFrame | None) -> DataFrame:
    flag = []
    if foreign is not None:
        stats, flag = add_foreign(stats, foreign), ["isforeign"]
    return rendered(stats, _ordered("domain", *flag, *MEASURES, "topdomain", "destip"))


def split_foreign(domains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(domestic, foreign) rows."""
    return domains.where(F.col("isforeign") == 0), domains.where(F.col("isforeign") == 1)


# ---- day level: final merge of hour rows ----------------------------------


def _day(stats: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    merged = merge(stored(stats), ["hid", "day", *keys])
    return rendered(merged, ["hid", "day", *columns])


def _with_day(hour_stats: DataFrame) -> DataFrame:
    return hour_stats.withColumnRenamed("d", "day").drop("h")


def day_ipportdomain(hour_stats: DataFrame) -> DataFrame:
    return _day(_with_day(hour_stats), _IPPORTDOMAIN, [*_IPPORTDOMAIN, *MEASURES])


def day_ipport(hour_stats: DataFrame) -> DataFrame:
    return _day(_with_day(hour_stats), _IPPORT, [*_IPPORT, *MEASURES])


def _day_in_two_steps(stats: DataFrame, keys: Sequence[str], last: str, columns: Sequence[str]) -> DataFrame:
    """With the maximum of text ``last``: hashed by it first, so that only merged rows are sorted."""
    by_last = merge(stored(stats), ["hid", "day", *keys, last])
    merged = merge(by_last, ["hid", "day", *keys], **{last: F.max(last)})
    return rendered(merged, ["hid", "day", *columns])


def day_domainip(hour_stats: DataFrame) -> DataFrame:
    keys = ["domain", "topdomain", "destip"]
    return _day_in_two_steps(_with_day(hour_stats), keys, "proctype", [*keys, *MEASURES, "proctype"])


def _registrable(hour_domains: DataFrame, drop_no_topdomain: bool) -> DataFrame:
    return hour_domains.where(F.col("topdomain") != "") if drop_no_topdomain else hour_domains


def day_domain(hour_domains: DataFrame, drop_no_topdomain: bool = True) -> DataFrame:
    rows = _with_day(_registrable(hour_domains, drop_no_topdomain))
    # The registrable domain follows from the domain, so as a key it splits nothing.
    return _day_in_two_steps(rows, ["domain", "topdomain"], "destip", ["domain", *MEASURES, "destip", "topdomain"])


def day_topdomain(hour_domains: DataFrame, drop_no_topdomain: bool = True) -> DataFrame:
    rows = _with_day(_registrable(hour_domains, drop_no_topdomain))
    return _day(rows, ["topdomain", "destip"], ["topdomain", "destip", *MEASURES])


def day_illegal(hour_illegal: DataFrame) -> DataFrame:
    return _with_day(hour_illegal).select("hid", "day", "domain", "destip").distinct()
