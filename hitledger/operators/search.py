"""Log search: optional predicates, all as native columns so that they push down."""

from __future__ import annotations

import base64
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions.net import ip_to_long, ip_to_long_sql, ip_value
from hitledger.functions.times import bucket_key, bucket_of, clip_lookback, parse_param, text_of
from hitledger.functions.urls import decode, encode_literal
from hitledger.schema import ADDRESS_NUMBERS, QUERY_COLUMNS

# What callers send to say "no such predicate".
NO_FILTER = ("NI", "#", "")

URL_EXACT, URL_ENCODED, URL_ENCODED_PREFIX, URL_PREFIX = "exact", "encoded", "encoded_prefix", "prefix"


def in_time_range(begin: datetime, end: datetime) -> Column:
    return F.col("acctime").between(text_of(begin), text_of(end))


def in_buckets(begin: datetime, end: datetime) -> Column:
    """5-minute partitions touching [begin, end].

    The day bound alone repeats part of the bucket bound: a catalog can prune by
    a plain column comparison but not by a concatenation.
    """
    key = F.concat("d", "h", "m5")
    return F.col("d").between(bucket_of(begin)["d"], bucket_of(end)["d"]) & key.between(
        bucket_key(begin), bucket_key(end)
    )


def _given(value: str | None) -> bool:
    return value is not None and value not in NO_FILTER


def _url_predicate(url: str, mode: str) -> Column:
    if mode == URL_EXACT:
        return F.col("url") == encode_literal(url)
    if mode == URL_ENCODED:
        return F.col("url") == url
    if mode == URL_ENCODED_PREFIX:
        # Prefix of the stored base64: a prefix of the URL only if its length is a multiple of 3.
        return F.col("url").startswith(encode_literal(url))
    if mode == URL_PREFIX:
        # Whole groups of three bytes are encoded on their own: that much is asked of the stored text, and pushed down.
        whole = url.encode()[: len(url.encode()) // 3 * 3]
        return F.col("url").startswith(base64.b64encode(whole).decode()) & decode(F.col("url")).startswith(url)
    raise ValueError(f"unknown url mode {mode!r}")


def predicates(
    *,
    url: str | None = None,
    url_mode: str = URL_EXACT,
    domain: str | None = None,
    srcport: str | None = None,
    destport: str | None = None,
    proctype: str | None = None,
    srcip_begin: str | None = None,
    srcip_end: str | None = None,
    destip_begin: str | None = None,
    destip_end: str | None = None,
    hid: str | int | None = None,
    numbers: bool = False,
) -> Column:
    """Conjunction of the predicates that were given.

    An address that cannot be read counts as 0, so it passes a range that has
    only an upper bound. ``numbers``: rows have addresses as numbers (``srcnum``, ``destnum``), and
    ranges are asked of them, so that they push down.
    """
    terms: list[Column] = []
    equal = {"hid": None if hid is None else str(hid), "domain": domain, "srcport": srcport,
             "destport": destport, "proctype": proctype}
    terms += [F.col(name) == value for name, value in equal.items() if _given(value)]
    if _given(url):
        terms.append(_url_predicate(url, url_mode))
    for name, low, high in (("srcip", srcip_begin, srcip_end), ("destip", destip_begin, destip_end)):
        if numbers:
            number = F.col(next(n for n, ip in ADDRESS_NUMBERS.items() if ip == name))
            terms += [number >= F.lit(ip_value(low))] if _given(low) else []
            terms += [number <= F.lit(ip_value(high))] if _given(high) else []
        elif _given(low) and _given(high):
            # "between" converts the address once for both bounds.
            terms.append(F.expr(f"{ip_to_long_sql(name)} between {ip_value(low)} and {ip_value(high)}"))
        elif _given(low):
            terms.append(ip_to_long(name) >= ip_value(low))
        elif _given(high):
            terms.append(ip_to_long(name) <= ip_value(high))
    return reduce(and_, terms, F.lit(True))


def search(
    log: DataFrame,
    begin: str | datetime,
    end: str | datetime,
    *,
    max_lookback_hours: int | None = None,
    **filters,
) -> DataFrame:
    """Rows of the published log in [begin, end] that match every given filter."""
    end = parse_param(end)
    begin = clip_lookback(parse_param(begin), end, max_lookback_hours)
    filters = {"numbers": set(ADDRESS_NUMBERS) <= set(log.columns), **filters}
    matches = in_buckets(begin, end) & in_time_range(begin, end) & predicates(**filters)
    return log.where(matches).select("hid", *QUERY_COLUMNS)


def search_lines(strict: DataFrame, begin_second: int, end_second: int, **filters) -> DataFrame:
    """The same filters over strictly parsed raw lines.

    ``acctime`` is still unix seconds there, compared as a number; what is none matches nothing.
    """
    second = F.when(F.col("acctime").rlike(r"^[+-]?\d+\z"), F.col("acctime").try_cast("bigint"))
    in_range = second.between(begin_second, end_second)
    return strict.where(in_range & predicates(**filters))


def search_both(log_hits: DataFrame, line_hits: DataFrame) -> DataFrame:
    """Hits of the stored log and of raw lines in one result, told apart by ``source``."""
    stored = log_hits.withColumn("hid", F.col("hid").cast("string")).withColumn("source", F.lit("orc"))
    return stored.unionByName(line_hits.withColumn("source", F.lit("text")))
