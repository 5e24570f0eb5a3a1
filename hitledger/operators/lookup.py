"""How often was this domain seen: from statistics, from raw lines, from both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists, add_top_domain


def _answer(rows: DataFrame, times: Column, batch_id: str, domain: str, asked_at: str) -> DataFrame:
    return rows.agg(times.cast("bigint").alias("times")).select(
        F.lit(batch_id).alias("batchID"), F.lit(domain).alias("domain"),
        F.lit(asked_at).alias("curSec"), "times",
    )


def count_in_stats(
    domain_stats: DataFrame, domain: str, *, batch_id: str, asked_at: str, by_top_domain: bool = False
) -> DataFrame:
    """Hits of a domain over all houses of hour or day statistics; null if unseen."""
    key = "topdomain" if by_top_domain else "domain"
    rows = domain_stats.where(F.col(key) == domain)
    return _answer(rows, F.sum(F.col("times").cast("bigint")), batch_id, domain, asked_at)


def count_in_lines(
    domains: DataFrame,
    domain: str,
    *,
    batch_id: str,
    asked_at: str,
    suffixes: SuffixLists | DataFrame | None = None,
) -> DataFrame:
    """Hits among raw lines; with ``suffixes``, ``domain`` is a registrable domain."""
    key = "domain"
    if suffixes is not None:
        domains, key = add_top_domain(domains, suffixes), "topdomain"
    return _answer(domains.where(F.col(key) == domain), F.count(F.lit(1)), batch_id, domain, asked_at)


def count_so_far(stats_answer: DataFrame, lines_answer: DataFrame | None) -> DataFrame:
    """Statistics answer, plus the raw-line answer where fresh lines are to be counted."""
    answer = stats_answer.withColumn("source", F.lit("stats"))
    if lines_answer is None:
        return answer
    return answer.unionByName(lines_answer.withColumn("source", F.lit("lines")))


def count_domain(
    domain_stats: DataFrame,
    fresh_domains: DataFrame,
    domain: str,
    *,
    batch_id: str,
    asked_at: str,
    query_day: str,
    suffixes: SuffixLists | DataFrame | None = None,
    count_fresh: bool = True,
) -> DataFrame:
    """Both answers for today, the statistics alone for another day."""
    named = {"batch_id": batch_id, "asked_at": asked_at}
    stats = count_in_stats(domain_stats, domain, by_top_domain=suffixes is not None, **named)
    is_today = query_day == asked_at[:10].replace("-", "")
    lines = None
    if is_today and count_fresh:
        lines = count_in_lines(fresh_domains, domain, suffixes=suffixes, **named)
    return count_so_far(stats, lines)
