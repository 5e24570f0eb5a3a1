"""Raw log lines: ``|``-separated text, one request per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.text import to_number, trim_blanks
from hitledger.functions.times import UNREADABLE, day_of, epoch_number, five_minutes_of, hour_of, number_text
from hitledger.schema import ACCESS_LOG, RAW_FIELDS

N_FIELDS = len(RAW_FIELDS)
REJECT = "-1"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text files as a ``value`` column; ``paths`` may hold globs or a comma list."""
    if isinstance(paths, str):
        paths = paths.split(",")
    return spark.read.text(list(paths))


def parse_tolerant(lines: DataFrame, *keep: str, zone: str | None = None) -> DataFrame:
    """Every line becomes an ``access_log`` row.

    A line with fewer than ten fields becomes a reject row: ``hid`` -1, the line
    itself in ``srcip``, ``"-1"`` elsewhere. An unreadable house id is 0, an
    unreadable time ``"0"`` in all four time columns. Columns named in ``keep``
    are carried along.

    """
    # The last of at most ten fields keeps any further pipes.
    split = lines.select(*keep, "value", F.split("value", r"\|", N_FIELDS).alias("field"))

    def pick(name: str) -> Column:
        return F.get("field", F.lit(RAW_FIELDS.index(name)))

    timed = split.withColumns({
        "complete": F.size("field") == N_FIELDS,
        "number": epoch_number(pick("acctime")),
    })
    # A generated row is computed once. Without it the optimizer copies split and
    # conversion into a later filter and into every column that uses them.
    once = F.explode(F.array(F.struct("value", "field", "complete", "number")))
    timed = timed.select(*keep, once.alias("line")).select(*keep, "line.*", number_text(F.col("line.number"), zone).alias("second"))

    complete = F.col("complete")
    house = F.coalesce(to_number(pick("hid"), "int"), F.lit(0))
    fields = [F.when(complete, house).otherwise(F.lit(-1)).alias("hid")]
    for name in RAW_FIELDS[1:-1]:
        text = trim_blanks(pick(name)) if name == "domain" else pick(name)
        spare = F.col("value") if name == "srcip" else F.lit(REJECT)
        fields.append(F.when(complete, text).otherwise(spare).alias(name))
    second = F.col("second")
    times = {"acctime": second, "d": day_of(second), "h": hour_of(second), "m5": five_minutes_of(second)}
    fields += [
        F.when(complete, F.coalesce(text, F.lit(UNREADABLE))).otherwise(F.lit(REJECT)).alias(name)
        for name, text in times.items()
    ]
    return timed.select(*keep, *fields)


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines the tolerant parser could not split."""
    return parsed.where((F.col("hid") == -1) & (F.col("d") == REJECT)).select(F.col("srcip").alias("line"))


def split_exact(lines: DataFrame, n_fields: int) -> DataFrame:
    """Lines with exactly ``n_fields`` fields, as an array column ``field``.

    Empty fields at the end of a line do not count.
    """
    field = F.split(F.rtrim("value", F.lit("|")), r"\|")
    return lines.select(field.alias("field")).where(F.size("field") == n_fields)


def parse_strict(lines: DataFrame) -> DataFrame:
    """Well-shaped lines only, all ten fields as they are (``acctime`` in unix seconds)."""
    field = F.col("field")
    return split_exact(lines, N_FIELDS).select(
        *[field[i].alias(name) for i, name in enumerate(RAW_FIELDS)]
    )


def domains_of(lines: DataFrame, n_fields: int = N_FIELDS) -> DataFrame:
    """Only the domain of lines with exactly ``n_fields`` fields."""
    return split_exact(lines, n_fields).select(
        F.col("field")[RAW_FIELDS.index("domain")].alias("domain")
    )


assert [*RAW_FIELDS, "d", "h", "m5"] == ACCESS_LOG.names
