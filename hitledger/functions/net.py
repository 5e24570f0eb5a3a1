"""IPv4 text as a number, for range predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"[+-]?\d+"
_QUAD = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def ip_to_long_sql(ip: str) -> str:
    """Four dotted integers -> number; anything else -> 0.

    Octets are not limited to 0-255, so ``300.0.0.1`` has a value of its own.
    """
    octets = [
        f"try_cast(substring_index({ip}, '.', 1) as bigint)",
        f"try_cast(substring_index(substring_index({ip}, '.', 2), '.', -1) as bigint)",
        f"try_cast(substring_index(substring_index({ip}, '.', -2), '.', 1) as bigint)",
        f"try_cast(substring_index({ip}, '.', -1) as bigint)",
    ]
    shifted = [f"shiftleft({o}, {s})" if s else o for o, s in zip(octets, (24, 16, 8, 0))]
    total = shifted[0]
    for part in shifted[1:]:
        total = f"try_add({total}, {part})"
    return f"coalesce(if({ip} rlike r'{_QUAD}', {total}, 0L), 0L)"


def ip_to_long(ip: str) -> Column:
    return F.expr(ip_to_long_sql(ip))


def ip_value(ip: str | None) -> int:
    """The same value for a query parameter."""
    if ip is None or not re.fullmatch(rf"(?:{_OCTET}\.){{3}}{_OCTET}", ip):
        return 0
    a, b, c, d = map(int, ip.split("."))
    value = (a << 24) + (b << 16) + (c << 8) + d
    return value if -(2**63) <= value < 2**63 else 0
