"""Small string helpers shared by the expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the log format counts as blanks (U+0000 to U+0020).
BLANKS = "".join(map(chr, range(0x21)))


def trim_blanks(col: Column) -> Column:
    """Trim control characters and spaces, not only spaces as ``trim`` does."""
    return F.trim(col, F.lit(BLANKS))


def sql_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_number(col: Column, sql_type: str) -> Column:
    """Signed digits only -> number, anything else (blanks included) -> null."""
    return F.when(col.rlike(r"^[+-]?\d+\z"), col.try_cast(sql_type))
