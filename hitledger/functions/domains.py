"""Registrable-domain and foreign-suffix expressions.

Each expression is written once, as SQL text over a column expression, so the
same text serves ``F.expr`` in the jobs and the session-level SQL functions in
:mod:`hitledger.functions.sql_names`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from hitledger.functions.text import sql_literal

MALFORMED = "-1"
#: Copies of a long suffix list that candidates are dealt over.
SALT = 16


@dataclass(frozen=True)
class SuffixLists:
    """Suffixes small enough to be literals in the plan."""

    generic: tuple[str, ...]  # "in" rows: com, net, ...
    area: tuple[str, ...]     # "area" rows: js.cn, ...
    country: tuple[str, ...]  # "country" rows: cn, ...

    @classmethod
    def of(cls, rows: Iterable[Row]) -> SuffixLists:
        """From rows (kind, value)."""
        found = {(row["kind"], row["value"]) for row in rows}
        return cls(*(tuple(sorted(v for k, v in found if k == kind)) for kind in ("in", "area", "country")))


def _in_list(expr: str, values: Iterable[str]) -> str:
    values = sorted(set(values))
    return f"{expr} in ({', '.join(map(sql_literal, values))})" if values else "false"


def _labels(domain: str) -> dict[str, str]:
    """Trailing dots do not count as labels; ``n`` is the number of labels - 1."""
    name = f"rtrim('.', {domain})"
    return {
        "name": name,
        "n": f"length({name}) - length(replace({name}, '.', ''))",
        "l1": f"substring_index({name}, '.', -1)",
        "l2": f"substring_index(substring_index({name}, '.', -2), '.', 1)",
        "last2": f"substring_index({name}, '.', -2)",
        "last3": f"substring_index({name}, '.', -3)",
    }


def well_formed_sql(domain: str) -> str:
    return rf"{domain} rlike r'^[\x00-\x20]*[\w\-:.]+[\x00-\x20]*\z'"


def _top_domain_sql(domain: str, generic: str, country: str, second_level: str) -> str:
    p = _labels(domain)
    # A missing third label reads "-1", so com.cn gives -1.com.cn.
    three = f"if({p['n']} > 1, {p['last3']}, concat('-1.', {p['last2']}))"
    return (
        f"case when not coalesce({well_formed_sql(domain)}, false) then '{MALFORMED}'"
        f" when {p['n']} < 1 then ''"
        f" when {generic} then {p['last2']}"
        f" when {country} then if({second_level}, {three}, {p['last2']})"
        f" else '' end"
    )


def top_domain_sql(domain: str, suffixes: SuffixLists) -> str:
    p = _labels(domain)
    return _top_domain_sql(
        domain,
        _in_list(p["l1"], suffixes.generic),
        _in_list(p["l1"], suffixes.country),
        f"({_in_list(p['l2'], suffixes.generic)} or {_in_list(p['last2'], suffixes.area)})",
    )


def _last_label_sql(domain: str) -> str:
    return rf"regexp_extract({domain}, r'^.*\.(\w+)(?::\d+)?\z', 1)"


def foreign_sql(domain: str, suffixes: Iterable[str]) -> str:
    return f"if({_in_list(_last_label_sql(domain), [s for s in suffixes if s])}, 1, 0)"


def is_well_formed(domain: str = "domain") -> Column:
    return F.coalesce(F.expr(well_formed_sql(domain)), F.lit(False))


def top_domain(domain: str, suffixes: SuffixLists) -> Column:
    """Registrable domain; ``''`` where there is none, ``'-1'`` if malformed."""
    return F.expr(top_domain_sql(domain, suffixes))


def is_foreign(domain: str, suffixes: Iterable[str]) -> Column:
    """1 where the last label (before an optional port) is a listed suffix."""
    return F.expr(foreign_sql(domain, suffixes))


def add_foreign(
    df: DataFrame, suffixes: Iterable[str] | DataFrame, domain: str = "domain", out: str = "isforeign"
) -> DataFrame:
    """Add the foreign flag; a long suffix list comes as a DataFrame ``(suffix)`` and is joined."""
    if not isinstance(suffixes, DataFrame):
        return df.withColumn(out, is_foreign(domain, suffixes))
    keys = suffixes.where(F.col("suffix") != "").select(F.col("suffix").alias("_foreign")).distinct()
    joined = df.join(keys, F.expr(_last_label_sql(domain)) == F.col("_foreign"), "left")
    return joined.withColumn(out, F.col("_foreign").isNotNull().cast("int")).drop("_foreign")


def add_top_domain(
    df: DataFrame, suffixes: SuffixLists | DataFrame, domain: str = "domain", out: str = "topdomain"
) -> DataFrame:
    """Add the registrable domain.

    ``suffixes`` is either :class:`SuffixLists` (literals, no join) or, for a
    list too long for that, a DataFrame ``(kind, value)``: then the distinct two-label ends of all
    domains meet it in one join, and their flags come back by another.
    """
    if isinstance(suffixes, SuffixLists):
        return df.withColumn(out, top_domain(domain, suffixes))
    p = _labels(domain)
    joined = df.withColumn("_last2", F.expr(p["last2"]))
    flags = _suffix_flags(joined.select("_last2").distinct(), suffixes)
    expr = _top_domain_sql(domain, "_in1", "_cc1", "(_in2 or _ar2)")
    return joined.join(flags, "_last2", "left").withColumn(out, F.expr(expr)).select(*df.columns, out)


def _suffix_flags(ends: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Which suffixes hold of distinct two-label ends (``_last2``), by one join of all candidates.

    Half of all ends may share a label such as "com", so candidates are dealt over SALT copies of the list.
    """
    p = _labels("_last2")
    candidates = {"_in1": ("in", p["l1"]), "_cc1": ("country", p["l1"]), "_in2": ("in", p["l2"]), "_ar2": ("area", p["last2"])}
    each = F.explode(F.array(*[
        F.struct(F.lit(flag).alias("flag"), F.lit(kind).alias("kind"), F.expr(part).alias("value")) for flag, (kind, part) in candidates.items()
    ])).alias("c")
    asked = ends.where("_last2 is not null").select("_last2", F.pmod(F.xxhash64("_last2"), F.lit(SALT)).cast("int").alias("salt"), each).select("_last2", "salt", "c.*")
    listed = suffixes.select("kind", "value").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    found = asked.join(listed, ["kind", "value", "salt"], "left_semi")
    has = [F.max(F.col("flag") == flag).alias(flag) for flag in candidates]
    hits = found.groupBy("_last2").agg(*has)
    return ends.join(hits, "_last2", "left").select("_last2", *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in candidates])
