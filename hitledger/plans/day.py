"""Day statistics: the final merge of hour tables, as TSV."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from hitledger.operators import rollup
from hitledger.sinks.stat_tables import Hours, write_day_tsv
from hitledger.functions.times import parse_param
from hitledger.sources.tables import read_hour_stats

# Day table -> (hour table it merges, merge).
MERGES = {
    "ipportdomain": ("ipportdomain", rollup.day_ipportdomain),
    "ipport": ("ipport", rollup.day_ipport),
    "domainip": ("domainip", rollup.day_domainip),
    "domain": ("domain", rollup.day_domain),
    "topdomain": ("domain", rollup.day_topdomain),
}
# The variant with house IPs keeps domains without a registrable part.
LEGAL_MERGES = {
    "ipport": ("ipport", rollup.day_ipport),
    "domain": ("domain", lambda rows: rollup.day_domain(rows, drop_no_topdomain=False)),
    "topdomain": ("domain", lambda rows: rollup.day_topdomain(rows, drop_no_topdomain=False)),
    "illegLog": ("illegLog", rollup.day_illegal),
}


def run_day_stats(
    spark: SparkSession,
    hour_root: str,
    out_root: str,
    day: str | datetime,
    hids: Sequence[int] | None = None,
    merges: dict = MERGES,
    last_day: str | datetime | None = None,
) -> dict[str, DataFrame]:
    """Replace the day (up to ``last_day``: all days) in every day table; returns their (path, row_count) rows."""
    begin = parse_param(day).replace(hour=0, minute=0, second=0)
    end = parse_param(last_day or day).replace(hour=23, minute=59, second=59)
    days = Hours(begin, end, tuple(hids) if hids else None)
    written = {}
    for table, (source, merge) in merges.items():
        stats = merge(read_hour_stats(spark, hour_root, source, begin, end, hids))
        written[table] = write_day_tsv(stats, f"{out_root}/{table}", table, days)
    return written
