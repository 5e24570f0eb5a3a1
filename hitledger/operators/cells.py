"""Rows as cells of a wide-column table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAMILY = "info"


def to_cells(
    rows: DataFrame, rowkey: str, qualifiers: Sequence[str], family: str = FAMILY, version: str | None = None
) -> DataFrame:
    """(rowkey, family, qualifier, value), one row per qualifier; ``version`` names a column that tells newer values."""
    ids = [F.col(rowkey).cast("string").alias("rowkey")]
    if version is not None:
        ids.append(F.col(version).cast("bigint").alias("version"))
    text = rows.select(*ids, *[F.col(q).cast("string").alias(q) for q in qualifiers])
    cells = text.unpivot([c for c in ("rowkey", "version") if c in text.columns], list(qualifiers), "qualifier", "value")
    shown = ["rowkey", F.lit(family).alias("family"), "qualifier", "value"]
    return cells.select(*shown, *(["version"] if version is not None else []))
