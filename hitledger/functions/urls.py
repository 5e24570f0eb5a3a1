"""URLs are stored as base64 text."""

import base64

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_literal(url: str) -> str:
    return base64.b64encode(url.encode()).decode()


def encode(url: Column) -> Column:
    # base64() breaks lines every 76 characters.
    return F.translate(F.base64(F.encode(url, "UTF-8")), "\r\n", "")


def decode(url: Column) -> Column:
    """Readable URL; null where the stored text is not base64."""
    return F.try_to_binary(url, F.lit("base64")).cast("string")
