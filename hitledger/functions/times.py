"""Access time and its 5-minute bucket.

Time is text ``yyyy-MM-dd HH:mm:ss``: it sorts like the time it stands for, and
``d`` (yyMMdd), ``h`` (HH), ``m5`` (minute floored to 5) are cut out of it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "%Y-%m-%d %H:%M:%S"
UNREADABLE = "0"
_SECONDS = r"^[+-]?\d+\z"
# Seconds of 400 years, after which the calendar repeats, and the seconds of years 1 to 9999.
_CYCLE = 12_622_780_800
_PLAIN_YEARS = (-62_135_510_400, 253_402_214_400)


def epoch_number(seconds: Column) -> Column:
    """Unix seconds (text) as a number; null if unreadable."""
    return F.when(seconds.rlike(_SECONDS), seconds.try_cast("bigint"))


def _local(number: Column, zone: str | None) -> Column:
    """The time of plain seconds, as ``timestamp_ntz`` or (session zone) ``timestamp``."""
    if zone is None:
        return F.timestamp_seconds(number)
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=number)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def number_text(number: Column, zone: str | None = None) -> Column:
    """Unix seconds as time text in ``zone`` (default: the session's).

    ``number`` is used several times: let it be a column, not an expression. Any 64-bit number has a
    time. Years of more than four digits are written in full; a time so far off that its text
    has no digit where the minute is cut out is null.
    """
    plain = F.from_unixtime(number) if zone is None else _local(number, zone).cast("string")
    # Other times: that of the same moment of the calendar's first cycle, and its year moved by whole cycles.
    rest = F.pmod(number, F.lit(_CYCLE))
    cycles = F.call_function("div", number, F.lit(_CYCLE)) - (number % _CYCLE < 0).cast("int")
    year = F.year(_local(rest, zone)) + cycles * 400
    shown = F.greatest(year, 1 - year)  # years before the first count backwards
    tail = (F.from_unixtime(rest) if zone is None else _local(rest, zone).cast("string")).substr(5, 15)
    # Years of 6, 9 or 12 digits move a mark to the place of the minute.
    cut = F.length(shown.cast("string")) % 3 != 0
    far = F.when(cut, F.concat(F.format_string("%04d", shown), tail))
    return F.when(number.between(*_PLAIN_YEARS), plain).otherwise(far)


def epoch_text(seconds: Column, zone: str | None = None) -> Column:
    """Unix seconds (text) -> time text; null if unreadable."""
    return number_text(epoch_number(seconds), zone)


def instant_in(moment: Column, zone: str | None = None) -> Column:
    """A timestamp as ``timestamp_ntz`` in ``zone`` (default: the session's)."""
    if zone is None:
        return moment.cast("timestamp_ntz")
    return _local(F.unix_seconds(moment), zone)


def day_of(acctime: Column) -> Column:
    return F.replace(acctime.substr(3, 8), F.lit("-"), F.lit(""))


def hour_of(acctime: Column) -> Column:
    return acctime.substr(12, 2)


def five_minutes_of(acctime: Column) -> Column:
    return F.concat(acctime.substr(15, 1), F.when(acctime.substr(16, 1) < "5", "0").otherwise("5"))


def as_instant(time_text: str) -> Column:
    """Time text as a fixed-width value, so min/max can be hash-aggregated."""
    return F.col(time_text).try_cast("timestamp_ntz")


def parse_param(value: str | datetime) -> datetime:
    """A job's time argument: datetime, time text, or yyyyMMdd[HH[mm[ss]]] digits."""
    if isinstance(value, datetime):
        return value
    if value.isdigit():
        return datetime.strptime(value, "%Y%m%d%H%M%S"[: len(value) - 2])
    return datetime.strptime(value, TEXT_FORMAT)


def text_of(moment: datetime) -> str:
    return moment.strftime(TEXT_FORMAT)


def bucket_of(moment: datetime) -> dict[str, str]:
    return {
        "d": moment.strftime("%y%m%d"),
        "h": moment.strftime("%H"),
        "m5": f"{moment.minute - moment.minute % 5:02d}",
    }


def bucket_key(moment: datetime) -> str:
    return "".join(bucket_of(moment).values())


def days_between(begin: datetime, end: datetime) -> list[str]:
    n = (end.date() - begin.date()).days
    return [(begin + timedelta(days=i)).strftime("%y%m%d") for i in range(n + 1)]


def clip_lookback(begin: datetime, end: datetime, hours: int | None) -> datetime:
    """Begin of a window that reaches back at most ``hours`` from its end."""
    return begin if hours is None else max(begin, end - timedelta(hours=hours))
