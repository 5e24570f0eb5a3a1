"""The expressions as SQL functions of the session, for queries written in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession

from hitledger.functions.domains import SuffixLists, foreign_sql, top_domain_sql
from hitledger.functions.net import ip_to_long_sql


#: Longest list that a function body holds.
MAX_NAMES = 20_000


def _bounded(rows: DataFrame, limit: int, join: str) -> list[Row]:
    found = rows.distinct().take(limit + 1)
    if len(found) > limit:
        raise ValueError(f"a list of more than {limit} rows does not fit into a SQL function; use {join}, which joins it")
    return found


def register_sql_functions(
    spark: SparkSession, suffixes: SuffixLists | DataFrame | None = None, foreign: Iterable[str] | DataFrame = (),
    limit: int = MAX_NAMES,
) -> None:
    """``ip2long(ip)``, ``foreignDomain(domain)`` and, given suffixes, ``topDomain(domain)``.

    Bodies are inlined by the analyzer, so a query using them keeps its codegen.
    A function body cannot join, so lists that come as DataFrames become literals here; lists of more than
    ``limit`` rows are refused: :func:`add_top_domain` and :func:`add_foreign` join those.
    """
    if isinstance(suffixes, DataFrame):
        suffixes = SuffixLists.of(_bounded(suffixes, limit, "add_top_domain"))
    if isinstance(foreign, DataFrame):
        foreign = [row["suffix"] for row in _bounded(foreign, limit, "add_foreign")]
    bodies = {
        "ip2long(ip string) returns bigint": ip_to_long_sql("ip"),
        "foreignDomain(domain string) returns int": foreign_sql("domain", foreign),
    }
    if suffixes is not None:
        bodies["topDomain(domain string) returns string"] = top_domain_sql("domain", suffixes)
    for signature, body in bodies.items():
        spark.sql(f"create or replace temporary function {signature} return {body}")
