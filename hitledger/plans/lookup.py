"""Domain counts for an operator's question, appended to a result log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from hitledger.functions.domains import SuffixLists
from hitledger.functions.times import text_of
from hitledger.operators.lookup import count_domain
from hitledger.sinks.delimited import append_answers
from hitledger.sources.lines import N_FIELDS, domains_of, read_lines
from hitledger.sources.tables import read_day_domains, read_hour_stats
from hitledger.workspace import matching_paths


def fresh_globs(root: str, now: datetime) -> list[str]:
    """Finished minute directories of the previous and the current hour, across midnight too."""
    return [f"{root}/{moment:%Y%m%d%H}*done" for moment in (now - timedelta(hours=1), now)]


def run_domain_count(
    spark: SparkSession,
    stats_root: str,
    lines_root: str,
    result_log: str,
    domain: str,
    *,
    now: datetime,
    query_day: str | None = None,
    batch_id: str | None = None,
    granularity: str = "hour",
    suffixes: SuffixLists | DataFrame | None = None,
    count_fresh: bool = True,
    n_fields: int = N_FIELDS,
) -> DataFrame:
    """Count ``domain`` (with ``suffixes``: registrable domain) in ``hour`` or ``day``
    statistics and, for today, in the raw lines of the last two hours.

    A question repeated with the same ``batch_id`` replaces its lines in the result log."""
    query_day = query_day or f"{now:%Y%m%d}"
    read = {"hour": lambda: read_hour_stats(spark, stats_root, "domain", query_day),
            "day": lambda: read_day_domains(spark, stats_root, query_day)}
    globs = matching_paths(spark, [f"{g}/*" for g in fresh_globs(lines_root, now)])
    lines = read_lines(spark, globs) if globs else spark.createDataFrame([], "value string")
    asked_at = text_of(now)
    answer = count_domain(
        read[granularity](), domains_of(lines, n_fields), domain, batch_id=batch_id or asked_at,
        asked_at=asked_at, query_day=query_day, suffixes=suffixes, count_fresh=count_fresh,
    )
    # One or two rows: counted once, then both logged and returned.
    answer = spark.createDataFrame(answer.collect(), answer.schema)
    append_answers(answer, result_log, batch_id)
    return answer
