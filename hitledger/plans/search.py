"""Search jobs: stored log and raw lines, CSV results with counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from hitledger.functions.times import clip_lookback, parse_param
from hitledger.operators.search import search, search_lines
from hitledger.sinks.delimited import write_delimited
from hitledger.sources.lines import parse_strict, read_lines
from hitledger.sources.tables import read_access_log


def run_search(
    spark: SparkSession,
    log_root: str,
    out_path: str,
    begin: str | datetime,
    end: str | datetime,
    *,
    hids: Sequence[int] | None = None,
    max_lookback_hours: int | None = None,
    files: int | None = None,
    **filters,
) -> DataFrame:
    """Search the stored log, whatever its directory levels; returns (path, row_count)."""
    end = parse_param(end)
    begin = clip_lookback(parse_param(begin), end, max_lookback_hours)
    log = read_access_log(spark, log_root, begin, end, hids)
    return write_delimited(search(log, begin, end, **filters), out_path, files=files)


def _unix(moment: datetime, zone: str | None) -> int:
    return int(moment.replace(tzinfo=ZoneInfo(zone) if zone else timezone.utc).timestamp())


def run_line_search(
    spark: SparkSession,
    input_paths: str | Sequence[str],
    out_path: str,
    begin: str | datetime,
    end: str | datetime,
    *,
    zone: str | None = None,
    files: int | None = None,
    **filters,
) -> DataFrame:
    """Search raw lines with the same filters; returns (path, row_count)."""
    zone = zone or spark.conf.get("spark.sql.session.timeZone")
    strict = parse_strict(read_lines(spark, input_paths))
    hits = search_lines(strict, _unix(parse_param(begin), zone), _unix(parse_param(end), zone), **filters)
    return write_delimited(hits, out_path, files=files)
